"""Health report (PIP-15), table inventory (SRC-31), storage stats
(SRC-32) and the age-threshold report (PIP-23)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.jobs.freshness import STATUS_RANK, freshness
from daybook.schemas import TABLES
from daybook.sources.tables import path_of, read_raw, read_table

# fixed values: freshness limits (seconds) per channel of the health page
HEALTH_LIMITS = {"spotify": 86400, "youtube": 86400 * 2, "maps": 86400 * 3, "calendar": 86400 * 2}
# fixed values: freshness budgets (seconds) of the monitor
MONITOR_BUDGETS = {"spotify_stream": 300, "spotify_history": 86400, "youtube": 172800, "maps": 172800,
                   "calendar": 172800}


def table_inventory(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Registered tables with layer, keys, version and path (SRC-31)."""
    rows = [(t.layer, t.name, ",".join(t.keys), t.version or "", path_of(cfg, t.name)) for t in TABLES.values()]
    return spark.createDataFrame(rows, "layer string, table_name string, keys string, version string, path string")


def storage_stats(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Rows and bytes per layer (SRC-32). Per table: rows grouped by data
    file (one row per file: its size and row count), then summed per layer —
    the grouping is by file, so it is tiny whatever the table size."""
    from functools import reduce
    parts = [read_raw(spark, cfg, t.name).groupBy(F.col("_metadata.file_path").alias("f"),
                                                  F.col("_metadata.file_size").alias("b"))
             .agg(F.count(F.lit(1)).alias("n")).select(F.lit(t.layer).alias("layer"), "n", "b")
             for t in TABLES.values() if _has_files(spark, cfg, t.name)]
    if not parts:
        return spark.createDataFrame([], "layer string, rows long, bytes long")
    return reduce(DataFrame.unionByName, parts).groupBy("layer").agg(
        F.sum("n").cast("long").alias("rows"), F.sum("b").cast("long").alias("bytes"))


def _has_files(spark, cfg, name) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path_of(cfg, name))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def health_report(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Per channel: last event, age, 30-day rows, status (healthy / stale /
    down), humanised age; plus the worst status and open alerts of the last
    7 days as columns. Calendar freshness uses ``_ingested_at`` here."""
    srcs = {
        "spotify": (read_table(spark, cfg, "spotify_plays_raw"), "played_at", HEALTH_LIMITS["spotify"]),
        "youtube": (read_table(spark, cfg, "youtube_watch_history"), "watched_at", HEALTH_LIMITS["youtube"]),
        "maps": (read_table(spark, cfg, "maps_activity"), "event_ts", HEALTH_LIMITS["maps"]),
        "calendar": (read_raw(spark, cfg, "calendar_events"), "_ingested_at", HEALTH_LIMITS["calendar"]),
    }
    f = freshness(srcs, cfg.as_of)
    alerts = read_raw(spark, cfg, "alerts").filter(
        F.col("raised_at") >= F.lit(cfg.as_of - dt.timedelta(days=7)).cast("timestamp")).agg(
        F.count(F.lit(1)).alias("open_alerts_7d"))
    from daybook.operators.merge import attach_scalar
    names = F.create_map(*[F.lit(x) for kv in ((v, k) for k, v in STATUS_RANK.items()) for x in kv])
    return attach_scalar(f, alerts).select(
        F.col("source").alias("channel"), "status", "last_ts", "age_s", F.col("last_seen").alias("last_batch_ago"),
        F.col("rows_30d").alias("events_per_month"), F.element_at(names, F.col("worst_rank")).alias("worst_status"),
        "open_alerts_7d")


def monitor(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Freshness monitor (PIP-14): breaches become alert rows (SNK-12).
    Calendar uses max(started_at) here (the two definitions differ in the
    reference; both are kept)."""
    from daybook.jobs.freshness import breaches_to_alerts
    srcs = {
        "spotify_stream": (read_table(spark, cfg, "spotify_player_current"), "captured_at",
                           MONITOR_BUDGETS["spotify_stream"]),
        "spotify_history": (read_table(spark, cfg, "spotify_plays_raw"), "played_at",
                            MONITOR_BUDGETS["spotify_history"]),
        "youtube": (read_table(spark, cfg, "youtube_watch_history"), "watched_at", MONITOR_BUDGETS["youtube"]),
        "maps": (read_table(spark, cfg, "maps_activity"), "event_ts", MONITOR_BUDGETS["maps"]),
        "calendar": (read_table(spark, cfg, "calendar_events"), "started_at", MONITOR_BUDGETS["calendar"]),
    }
    return breaches_to_alerts(freshness(srcs, cfg.as_of), cfg.as_of)


def age_report(dated: DataFrame, date_col: str, as_of: dt.datetime, days: int, kind: str = "age") -> DataFrame:
    """Records older than ``days`` at ``as_of`` become alert rows (PIP-23,
    re-aimed from token issue dates to any dated table)."""
    age = F.datediff(F.lit(as_of.date()), F.to_date(date_col))
    return dated.filter(age >= days).select(
        F.lit(as_of).cast("timestamp").alias("raised_at"), F.lit(kind).alias("kind"), F.lit("").alias("account_email"),
        F.concat(F.lit("record dated "), F.to_date(date_col).cast("string"), F.lit(" is "), age.cast("string"),
                 F.lit(" days old")).alias("message"))


def worst(report: DataFrame) -> DataFrame:
    w = Window.partitionBy()
    return report.withColumn("worst", F.max("worst_rank").over(w))
