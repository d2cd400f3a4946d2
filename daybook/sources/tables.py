"""Warehouse table I/O (SRC-01, SNK-01, SNK-03/04, SNK-10, SNK-13..15).

Tables are append-only Parquet folders under ``cfg.table_path(layer, name)``;
reads apply latest-version-per-key when the table declares a version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.operators.versioned import latest_by_version
from daybook.schemas import TABLES, TableSpec


def spec(name: str) -> TableSpec:
    return TABLES[name]


def path_of(cfg: Cfg, name: str) -> str:
    s = spec(name)
    return cfg.table_path(s.layer, s.name)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_raw(spark: SparkSession, cfg: Cfg, name: str) -> DataFrame:
    """All stored rows (no dedup), read with the declared schema: no schema
    inference or footer merging job, and columns added to the schema later
    read as NULL from older files. A missing table reads as empty. A set
    ``cfg.extra["reads"]`` notes the name."""
    s = spec(name)
    cfg.extra.get("reads", set()).add(name)
    p = path_of(cfg, name)
    if not _exists(spark, p):
        return spark.createDataFrame([], s.schema)
    return spark.read.schema(s.schema).parquet(p)


def read_table(spark: SparkSession, cfg: Cfg, name: str) -> DataFrame:
    """Latest version per key (``FINAL``) for versioned tables (AGG-13)."""
    s = spec(name)
    df = read_raw(spark, cfg, name)
    if s.version and s.keys:
        df = latest_by_version(df, list(s.keys), s.version)
    return df


def append(df: DataFrame, cfg: Cfg, name: str, ingested_at=None, skip_empty: bool = True) -> None:
    """Column-aligned append; the version column defaults to ``as_of``
    (SNK-01). An empty input writes nothing (``skip_empty``; pass False
    when the frame carries an ``observe`` whose counts must come from the
    write itself)."""
    s = spec(name)
    out = df
    if s.version and s.version not in df.columns:
        out = out.withColumn(s.version, F.lit(ingested_at or cfg.as_of).cast("timestamp"))
    for f in s.schema.fields:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    out = out.select(*[F.col(f.name).cast(f.dataType) for f in s.schema.fields])
    if skip_empty and out.isEmpty():
        return
    out.write.mode("append").parquet(path_of(cfg, name))


def overwrite_guarded(df: DataFrame, cfg: Cfg, name: str, allow_empty: bool = True) -> None:
    """Full rebuild (SNK-03). With ``allow_empty=False`` an empty result
    raises before anything is replaced (SNK-04 fail-safe).

    The new rows are written to a staging folder; the old table is moved
    aside, the staging folder moved in, and only then is the old copy
    deleted. A run that dies in between leaves either the old table or its
    ``__old`` copy, which the next run restores before doing anything."""
    s = spec(name)
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in s.schema.fields])
    publish(out, path_of(cfg, name), allow_empty)


def publish(out: DataFrame, target: str, allow_empty: bool = True) -> None:
    """Replace the Parquet folder ``target`` by ``out``, as described above."""
    spark = out.sparkSession
    jvm = spark.sparkContext._jvm
    target = target.rstrip("/")
    tp, sp, bp = (jvm.org.apache.hadoop.fs.Path(x) for x in (target, target + "__staging", target + "__old"))
    fs = tp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def move(a, b) -> None:                     # rename reports failure by returning false
        if not fs.rename(a, b):
            raise OSError(f"could not rename {a} to {b}")

    if not fs.exists(tp) and fs.exists(bp):
        move(bp, tp)                            # recover an interrupted swap
    if not allow_empty and out.isEmpty():
        raise ValueError(f"refusing to replace {target} with an empty result")
    out.write.mode("overwrite").parquet(target + "__staging")
    if fs.exists(bp):
        fs.delete(bp, True)
    had = fs.exists(tp)
    if had:
        move(tp, bp)
    try:
        move(sp, tp)
    except Exception:
        if had:
            move(bp, tp)
        raise
    fs.delete(bp, True)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose models as temp views (SNK-14) so users can query them in SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def to_json_lines(df: DataFrame, path: str) -> None:
    """Result rows as newline-delimited JSON (SNK-15)."""
    df.write.mode("overwrite").json(path)


def compact(spark: SparkSession, cfg: Cfg, name: str, files: int | None = None) -> None:
    """Rewrite a versioned table as its latest version per key, clustered by
    the key (OPT-11, OPT-14): later reads skip row groups by min/max
    statistics and the dedup aggregate has one row per key to combine."""
    s = spec(name)
    df = read_table(spark, cfg, name)
    if s.keys:
        df = (df.repartition(files, *s.keys) if files else df.repartition(*s.keys)).sortWithinPartitions(*s.keys)
    overwrite_guarded(df, cfg, name)
