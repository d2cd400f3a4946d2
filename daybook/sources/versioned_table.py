"""Append-only tables of versions, laid out by key (SRC-01, AGG-13).

Every append deals its rows into a fixed number of buckets by a hash of the key
and sorts them by key and version, newest first, so a run of new files lies
beside the older ones of its bucket. The latest version per key is then found
bucket by bucket: no row moves, the runs of a bucket are merged by one sort
(none when it has a single run). ``compact`` merges the runs of all buckets
into one and leaves the older versions out.

The layout is kept in ``_layout.json`` beside the files, so any session can
register the folder again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.sources.snapshot import _fs

LAYOUT = "_layout.json"


@dataclass(frozen=True)
class Layout:
    keys: tuple[str, ...]
    version: str
    buckets: int
    schema: str


def _read(spark: SparkSession, path: str) -> Layout:
    fs, p = _fs(spark, f"{path}/{LAYOUT}")
    stream = fs.open(p)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    found = json.loads(text)
    return Layout(tuple(found["keys"]), found["version"], found["buckets"], found["schema"])


def _register(spark: SparkSession, path: str, layout: Layout) -> str:
    """The folder as a bucketed table of this session's catalog."""
    name = "versions_" + hashlib.md5(path.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        keys = ", ".join(f"`{k}`" for k in layout.keys)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({layout.schema}) USING parquet CLUSTERED BY ({keys}) "
                  f"SORTED BY ({keys}) INTO {layout.buckets} BUCKETS LOCATION '{path}'")
    return name


def create(spark: SparkSession, path: str, schema: str, keys: Sequence[str], version: str, buckets: int) -> None:
    """An empty table of versions. ``buckets`` should be such that one holds a
    few hundred megabytes; a key is never split over buckets."""
    fs, p = _fs(spark, f"{path}/{LAYOUT}")
    if fs.exists(p):
        raise FileExistsError(path)
    stream = fs.create(p, False)
    stream.write(bytearray(json.dumps({"keys": list(keys), "version": version, "buckets": buckets, "schema": schema}).encode()))
    stream.close()


def append(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Add a run of versions. Rows are dealt by key once, here, so that each
    bucket gets one file of the run."""
    layout = _read(spark, path)
    name = _register(spark, path, layout)
    columns = spark.table(name).columns
    dealt = rows.select(*columns).repartition(layout.buckets, *layout.keys)
    dealt.write.insertInto(name)
    spark.catalog.refreshTable(name)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions, known to Spark as dealt by key."""
    return spark.table(_register(spark, path, _read(spark, path)))


def latest(spark: SparkSession, path: str) -> DataFrame:
    """One row per key: that of the greatest version (nulls lowest), of equal
    versions that of the greatest other columns, in their order. Null keys are
    a key. No exchange: the buckets are read as they lie."""
    layout = _read(spark, path)
    rows = read_versions(spark, path)
    rest = [c for c in rows.columns if c not in layout.keys and c != layout.version]
    order = [F.col(c).desc_nulls_last() for c in [layout.version, *rest]]
    place = F.row_number().over(Window.partitionBy(*layout.keys).orderBy(*order))
    return rows.withColumn("__place", place).filter("__place = 1").drop("__place")


def compact(spark: SparkSession, path: str, into: str) -> None:
    """A copy of the table in ``into`` with one run and the latest versions
    only; the caller puts it in place (``tables.publish``)."""
    layout = _read(spark, path)
    create(spark, into, layout.schema, layout.keys, layout.version, layout.buckets)
    name = _register(spark, into, layout)
    latest(spark, path).write.insertInto(name)  # already dealt by key
    spark.catalog.refreshTable(name)
