"""Freshness monitor and health report (PIP-14, PIP-15, SET-04, SNK-12)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.timefn import age_label

# fixed values: status → severity rank of the health report
STATUS_RANK = {"healthy": 0, "degraded": 1, "stale": 2, "down": 3}


def freshness(sources: dict[str, tuple[DataFrame, str, int]], as_of: dt.datetime,
              window_days: int = 30) -> DataFrame:
    """One row per source from ``{name: (table, time column, budget_s)}``.

    Each source is one global aggregate (max time, recent rows, total
    rows); the rows are unioned, so the job scans each table once and the
    result has one row per source whatever the volume."""
    rows = []
    for name, (df, col, budget) in sources.items():
        t = df.schema[col].dataType
        a = F.lit(as_of).cast(t)
        lo = F.timestamp_add("DAY", F.lit(-window_days), a)
        rows.append(df.agg(
            F.lit(name).alias("source"), F.max(col).alias("last_ts"),
            F.count_if((F.col(col) <= a) & (F.col(col) >= lo)).alias("rows_30d"),
            F.count(F.lit(1)).alias("rows_total"), F.lit(int(budget)).cast("long").alias("budget_s")))
    u = reduce(DataFrame.unionByName, rows)
    as_us = F.unix_micros(F.lit(as_of).cast("timestamp"))
    age = F.floor((as_us - F.unix_micros(F.col("last_ts").cast("timestamp"))) / 1_000_000).cast("long")
    u = u.withColumn("age_s", age)
    status = (F.when(F.col("last_ts").isNull(), "down")
              .when(F.col("age_s") <= F.col("budget_s"), "healthy").otherwise("stale"))
    u = u.withColumn("status", status)
    rank = F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv])
    return u.select(
        "source", "last_ts", "age_s", "budget_s",
        ((F.col("rows_total") > 0) & (F.col("age_s") > F.col("budget_s"))).cast("int").alias("breach"),
        "status", "rows_30d", age_label(F.col("age_s")).alias("last_seen"),
        F.max(F.element_at(rank, F.col("status"))).over(Window.partitionBy()).cast("int").alias("worst_rank"))


def breaches_to_alerts(report: DataFrame, as_of: dt.datetime, kind: str = "freshness") -> DataFrame:
    """Alert rows (raised_at, kind, account_email, message) for breaches (SNK-12)."""
    return report.filter("breach = 1").select(
        F.lit(as_of).cast("timestamp").alias("raised_at"), F.lit(kind).alias("kind"),
        F.lit("").alias("account_email"),
        F.concat(F.col("source"), F.lit(" stale: last event "), F.col("age_s").cast("string"),
                 F.lit(" s ago (budget "), F.col("budget_s").cast("string"), F.lit(" s)")).alias("message"))
