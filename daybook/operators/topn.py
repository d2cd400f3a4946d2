"""Sorts, top-k and ranking (SRT-*, WIN-01, WIN-02)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """``ORDER BY … LIMIT n`` — planned as TakeOrderedAndProject: each
    partition keeps its own top n, only n rows per partition reach the driver."""
    return df.orderBy(*order).limit(n)


def rank_rows(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``row_number() OVER (ORDER BY …)`` — only for already-small inputs
    (use after ``top_n``): an unpartitioned window runs in one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top ``n`` rows per group (``QUALIFY row_number() <= n``).

    Catalyst plans a WindowGroupLimit below the shuffle, so each partition
    ships at most n rows per group — a hot group does not move its full
    volume."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w).cast("long"))
            .filter(F.col(rank_col) <= n))


def top_n_plus_other(counts: DataFrame, name: str, value: str, n: int,
                     other: str = "Other") -> DataFrame:
    """Keep the n largest slices and fold the rest into ``other`` (SRT-07).

    ``counts`` holds one row per slice. The n winners come from a distributed
    top-k (ties broken by name) and are broadcast back — at most n rows, so
    the broadcast is bounded by the parameter, not by the data."""
    winners = (counts.orderBy(F.col(value).desc(), F.col(name)).limit(n)
               .select(F.col(name), F.lit(True).alias("__top")))
    labelled = counts.join(F.broadcast(winners), name, "left").withColumn(
        name, F.when(F.col("__top"), F.col(name)).otherwise(F.lit(other)))
    return labelled.groupBy(name).agg(F.sum(value).alias(value))
