"""Gaps and islands over a daily series (WIN-06, WIN-07, AGG-24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.geo import haversine_km


def island_runs(days: DataFrame, entity: Sequence[str], day: str, gap_days: int,
                run_col: str = "run_id") -> DataFrame:
    """Number the runs of a daily series per entity: a gap of more than
    ``gap_days + 1`` calendar days between consecutive rows starts a new run.

    ``days`` must hold at most one row per (entity, day) — a daily
    aggregate — so each window partition is bounded by the calendar span of
    one entity, not by its event volume."""
    w = (Window.partitionBy(*entity) if entity else Window.partitionBy()).orderBy(F.col(day))
    prev = F.lag(F.col(day)).over(w)
    starts = F.when(prev.isNull() | (F.datediff(F.col(day), prev) > gap_days + 1), 1).otherwise(0)
    return (days.withColumn("__start", starts)
            .withColumn(run_col, F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
            .drop("__start"))


def run_mode(rows: DataFrame, run_keys: Sequence[str], value: str, day: str,
             out: str = "mode") -> DataFrame:
    """Most frequent non-empty ``value`` per run; ties go to the value seen
    first (earliest ``day``), then the smallest value (AGG-24).

    First a map-side combinable (run, value) count; the ranking window then
    only sees one row per distinct value of a run."""
    per = (rows.filter(F.col(value).isNotNull() & (F.col(value) != ""))
           .groupBy(*run_keys, value)
           .agg(F.count(F.lit(1)).alias("__n"), F.min(day).alias("__first")))
    w = Window.partitionBy(*run_keys).orderBy(F.col("__n").desc(), F.col("__first"), F.col(value))
    return (per.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
            .select(*run_keys, F.col(value).alias(out)))


def run_path_km(points: DataFrame, run_keys: Sequence[str], day: str, lat: str, lng: str,
                home_lat: str, home_lng: str, out: str = "km") -> DataFrame:
    """Great-circle path length per run: home → each daily point in order →
    home. Points with lat or lng equal to 0 are skipped (WIN-07).

    ``points`` holds one row per (run, day) with the home coordinates as
    columns; consecutive legs come from ``lag`` within the run."""
    p = points.filter((F.col(lat) != 0) & (F.col(lng) != 0))
    w = Window.partitionBy(*run_keys).orderBy(F.col(day))
    leg = haversine_km(F.lag(lat).over(w), F.lag(lng).over(w), F.col(lat), F.col(lng))
    p = p.withColumn("__leg", F.coalesce(leg, F.lit(0.0)))
    agg = p.groupBy(*run_keys).agg(
        F.sum("__leg").alias("__inner"),
        F.min_by(F.struct(lat, lng, home_lat, home_lng), F.col(day)).alias("__first"),
        F.max_by(F.struct(lat, lng, home_lat, home_lng), F.col(day)).alias("__last"))
    first_leg = haversine_km(F.col(f"__first.{home_lat}"), F.col(f"__first.{home_lng}"),
                             F.col(f"__first.{lat}"), F.col(f"__first.{lng}"))
    last_leg = haversine_km(F.col(f"__last.{lat}"), F.col(f"__last.{lng}"),
                            F.col(f"__last.{home_lat}"), F.col(f"__last.{home_lng}"))
    return agg.select(*run_keys, (first_leg + F.col("__inner") + last_leg).alias(out))
