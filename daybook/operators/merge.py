"""Lambda (batch + speed) splice and scalar attachment (STM-07, STM-08,
FLT-09, JON-06, PRJ-12)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.joins import band_anti_join

COLD_START = dt.datetime(2000, 1, 1)  # fixed value: history before this means "no history"


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (a global aggregate or a top-1)
    to every row, as one scalar subquery.

    The subquery is part of the plan: nothing runs while the plan is built,
    it runs once, and no join is needed. More than one row is an error when it
    runs. An empty ``one_row`` gives an empty result, like a cross join with
    an empty relation. The row is unpacked by a generator: a filter on it would
    copy the whole subquery, and nested copies multiply in the driver."""
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("__one")).scalar()
    out = df.select("*", F.explode(F.array_compact(F.array(packed))).alias("__one"))
    for c in one_row.columns:
        out = out.withColumn(c, F.col("__one").getField(c))
    return out.drop("__one")


def lambda_merge(history: DataFrame, stream: DataFrame, keys: Sequence[str], ts: str,
                 window_s: int, raw_history: DataFrame | None = None,
                 cold_start: dt.datetime = COLD_START) -> DataFrame:
    """history(ts <= T) ∪ stream(ts > T), T = max(ts) of the raw history.

    A stream row is dropped when the raw history has a row with the same
    ``keys`` within ±``window_s`` seconds (the boundary race). Only history
    rows in [T - window, T] can collide with a stream row newer than T, so
    just those are read for the anti-join. An empty (or pre-``cold_start``)
    history disables the stream branch.

    T is one scalar subquery (a global max, answerable from Parquet
    footers): it runs with the plan, once, and its value reaches the filters of
    the scans, so the boundary read touches only the row groups of the last
    ``window_s`` seconds."""
    raw = raw_history if raw_history is not None else history
    t_type = raw.schema[ts].dataType
    T = raw.agg(F.max(ts).alias("t")).scalar()
    h = history.filter(F.col(ts) <= T)
    s = stream.filter((F.col(ts) > T) & (T > F.lit(cold_start).cast(t_type)))
    boundary = raw.select(*keys, ts).filter(F.col(ts) >= T - F.make_dt_interval(secs=F.lit(window_s)))
    s = band_anti_join(s, boundary, keys, ts, ts, window_s)
    return h.unionByName(s.select(*history.columns))
