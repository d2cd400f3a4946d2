"""Incremental distinct counts (AGG-27): partial states that merge.

The design the survey describes keeps per-day aggregate *states* and merges
them at read time. Spark's HLL sketches are such states: ``daily_states``
writes one sketch per (group, day), ``merge_states`` unions any range of
them, and the estimate is read at the end — no re-scan of raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_states(df: DataFrame, group: Sequence[str], day: str, value: str, lg_k: int = 12) -> DataFrame:
    return df.groupBy(*group, day).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"),
                                       F.count(F.lit(1)).alias("rows"))


def merge_states(states: DataFrame, group: Sequence[str]) -> DataFrame:
    return states.groupBy(*group).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"),
                                      F.sum("rows").alias("rows"))
