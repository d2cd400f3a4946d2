"""Expressions shared by several models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place_weight(activity_type: str = "activity_type") -> Column:
    """Weighted place score: 3 × directions + views + searches (AGG-16)."""
    t = F.col(activity_type)
    return (F.count_if(t == "directions") * 3 + F.count_if(t == "view_place")
            + F.count_if(t == "search")).cast("long")


def distinct_counts(df, **columns):
    """One row: for each name how many different values (not null) its column
    has. All values of a row become rows of their own, are made distinct
    together and counted by name: one exchange, whatever the number of counts.
    Meant for pre-aggregated tables, where few rows remain to be multiplied."""
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), c.cast("string").alias("v")) for i, c in enumerate(columns.values())])
    flat = df.select(F.explode(pairs).alias("x")).select("x.k", "x.v").filter("v IS NOT NULL").distinct()
    return flat.agg(*[F.count_if(F.col("k") == i).alias(name) for i, name in enumerate(columns)])


def mean_degrees(column: str):
    """The mean of coordinates, from a sum of whole micro-degrees: the same in
    whatever order and partitions rows are added."""
    micro = micro_degrees(column)
    return degrees_of(F.sum(micro), F.count(micro))


def micro_degrees(column: str) -> Column:
    return F.round(F.col(column) * 1_000_000).cast("long")


def degrees_of(total: Column, count: Column) -> Column:
    """The mean in degrees from a sum of micro-degrees and its count."""
    return total.cast("double") / count / 1_000_000
