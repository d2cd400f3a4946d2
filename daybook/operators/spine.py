"""Dense spines and densifying joins (SRC-29, SRC-30, JON-07, JON-08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def int_spine(spark: SparkSession, name: str, n: int, start: int = 0) -> DataFrame:
    """``start .. start+n-1`` as a one-column DataFrame (``numbers(n)``)."""
    return spark.range(start, start + n, numPartitions=1).select(F.col("id").cast("long").alias(name))


def date_spine(bounds: DataFrame, lo: str, hi: str, name: str = "date") -> DataFrame:
    """Every date from ``lo`` to ``hi`` of a one-row ``bounds`` frame.

    The spine has one row per calendar day, so it is bounded by the span of
    the data, not by its volume."""
    return bounds.select(F.explode(F.sequence(F.to_date(lo), F.to_date(hi))).alias(name))


def densify(spine: DataFrame, counts: DataFrame, keys: Sequence[str],
            fill: dict[str, object]) -> DataFrame:
    """Left join ``counts`` onto ``spine`` and replace misses by ``fill``.

    The spine is small and of fixed size (24 hours, 7 days, 168 slots or the
    days of a window); the counts side is already aggregated, so the join is
    between two small relations whatever the input volume."""
    out = spine.join(counts, list(keys), "left")
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out
