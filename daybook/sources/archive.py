"""Archive inputs (SRC-26..28): multi-file selection, zip expansion and
tolerant JSON reads."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def read_many(spark: SparkSession, root: str, glob: str, schema: StructType, multiline: bool = True) -> DataFrame:
    """Every file under ``root`` (recursively) whose name matches ``glob``,
    read in parallel with an explicit schema (SRC-26)."""
    return (spark.read.schema(schema).option("multiLine", multiline).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).json(root))


def _members(suffix: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One frame per member."""
    def frame(*row: str | None) -> pd.DataFrame:
        return pd.DataFrame([row], columns=["archive", "member", "text"])

    for b in batches:
        for path, content in zip(b["path"], b["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.endswith(suffix):
                            yield frame(path, name, z.read(name).decode("utf-8", errors="replace"))
            except zipfile.BadZipFile:
                yield frame(path, "", None)


def expand_zips(spark: SparkSession, root: str, member_suffix: str = ".json") -> DataFrame:
    """(archive, member, text) for every ``*.json`` member of every zip under
    ``root`` (SRC-27). The archives are dealt to tasks by path and each is
    expanded inside one task by ``mapInPandas``, which holds one member's text
    at a time — the only per-file Python in the ingest path; the JSON text is
    then parsed by Spark (``from_json``)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.zip").load(root).select("path", "content"))
    dealt = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return dealt.mapInPandas(lambda it: _members(member_suffix, it), "archive string, member string, text string")


def parse_json_array(texts: DataFrame, element_schema: StructType, text_col: str = "text") -> DataFrame:
    """Top-level JSON array text → one row per element; texts that are not
    an array of objects yield no element rows and are reported in
    ``bad_texts`` (SRC-28)."""
    arr = F.from_json(F.col(text_col), f"array<{element_schema.simpleString()}>")
    return texts.select("*", F.explode_outer(arr).alias("e")).filter(F.col("e").isNotNull()).select("e.*")


def bad_texts(texts: DataFrame, element_schema: StructType, text_col: str = "text") -> DataFrame:
    arr = F.from_json(F.col(text_col), f"array<{element_schema.simpleString()}>")
    return texts.filter(arr.isNull())


def tolerant_read(spark: SparkSession, path, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad files) of a folder of JSON-array export files (SRC-28).

    Each file is one task (a multi-line JSON document is not splittable in
    any reader): its text is parsed with ``from_json`` into an array of
    ``schema``. A file whose top level is not an array, or that does not
    parse, is kept in ``bad`` with its path and text instead of failing the
    job or disappearing; entries that are not objects parse to NULL and
    are dropped."""
    texts = (spark.read.option("wholetext", True).text(path)
             .select(F.col("_metadata.file_path").alias("_file"), F.col("value")))
    is_array = F.ltrim(F.col("value")).startswith("[")
    parsed = texts.withColumn("_rows", F.when(is_array, F.from_json("value", ArrayType(schema))))
    good = (parsed.filter(F.col("_rows").isNotNull()).select(F.explode("_rows").alias("r"))
            .filter(F.col("r").isNotNull()).select("r.*"))
    bad = parsed.filter(F.col("_rows").isNull()).select("_file", F.col("value").alias("_corrupt_record"))
    return good, bad
