"""Calendar push-notification bookkeeping (SNK-10, SNK-16, STM-11, STM-12,
JON-19, JON-20) as version appends read latest-per-key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.sources.tables import append, read_table


def notification_rows(webhooks: DataFrame, channels: DataFrame) -> DataFrame:
    """Webhook deliveries → notification rows (SNK-16): handshake ('sync')
    deliveries skipped; the calendar is looked up by channel (JON-19), an
    unknown channel is kept with calendar_id ''."""
    ch = channels.select("channel_id", "calendar_id").dropDuplicates(["channel_id"])
    w = webhooks.filter(F.col("state") != "sync")
    return w.join(ch, "channel_id", "left").select(
        "channel_id", F.col("message_number").cast("long"), F.col("received_at").cast("timestamp"),
        F.coalesce("resource_id", F.lit("")).alias("resource_id"),
        F.coalesce("calendar_id", F.lit("")).alias("calendar_id"), F.lit(None).cast("timestamp").alias("processed_at"))


def drain_plan(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Unprocessed notifications grouped per calendar with the max message
    number and the freshest channel metadata (STM-11, JON-20)."""
    n = read_table(spark, cfg, "calendar_sync_notifications").filter(F.col("processed_at").isNull())
    g = n.groupBy("calendar_id").agg(F.max("message_number").alias("max_message"),
                                     F.count(F.lit(1)).alias("pending"))
    chans = read_table(spark, cfg, "calendar_channels")
    fresh = chans.groupBy("calendar_id").agg(F.max_by("calendar_name", "_updated_at").alias("calendar_name"))
    return g.join(fresh, "calendar_id", "left").withColumn("calendar_name", F.coalesce("calendar_name", F.lit("")))


def mark_processed(spark: SparkSession, cfg: Cfg, plan: DataFrame) -> None:
    """In-place update as a version append (SNK-10): every pending
    notification up to the drained max gets a newer row with processed_at."""
    n = read_table(spark, cfg, "calendar_sync_notifications").filter(F.col("processed_at").isNull())
    done = n.join(plan.select("calendar_id", "max_message"), "calendar_id") \
        .filter(F.col("message_number") <= F.col("max_message")).drop("max_message", "_ingested_at")
    append(done.withColumn("processed_at", F.lit(cfg.as_of).cast("timestamp")), cfg, "calendar_sync_notifications",
           ingested_at=cfg.as_of)


def sync_cursors(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Freshest non-empty sync token per calendar (STM-12,
    ``argMaxIf(token, updated_at, token != '')``)."""
    c = read_table(spark, cfg, "calendar_channels")
    return c.groupBy("calendar_id").agg(
        F.max_by(F.when(F.col("sync_token") != "", F.col("sync_token")),
                 F.when(F.col("sync_token") != "", F.col("_updated_at"))).alias("sync_token"))
