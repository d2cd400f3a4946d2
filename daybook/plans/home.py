"""Home page models and the live/overview jobs (gold_home_*, PIP-16, PIP-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.categories import kind_label
from daybook.functions.numeric import round_half
from daybook.functions.text import join_nonblank
from daybook.functions.timefn import iso_utc
from daybook.operators.merge import attach_scalar
from daybook.operators.topn import top_n, top_n_per_group
from daybook.plans.base import floor_date, floor_ts, now, today


def gold_home_overview_stats(spark: SparkSession, cfg: Cfg, plays: DataFrame, watches: DataFrame,
                             searches: DataFrame, enriched: DataFrame, maps_kpis: DataFrame) -> DataFrame:
    p = plays.filter(F.col("played_at") >= floor_ts(cfg))
    w = watches.filter(F.col("watched_date") >= floor_date(cfg))
    a = p.agg(F.countDistinct("track_id").alias("songsStreamed"),
              F.countDistinct(F.when(F.col("primary_artist_id") != "", F.col("primary_artist_id"))).alias("artistsListened"),
              round_half(F.coalesce(F.sum("duration_ms"), F.lit(0)) / 3600000.0, 1).alias("spotifyHours"))
    b = w.agg(F.count(F.lit(1)).alias("videosWatched"),
              F.countDistinct(F.when(F.col("channel_id") != "", F.col("channel_id"))).alias("youtubeChannels"),
              round_half(F.coalesce(F.sum("duration_seconds"), F.lit(0)) / 3600.0, 1).alias("youtubeHours"))
    c = searches.filter(F.col("searched_date") >= floor_date(cfg)).agg(F.count(F.lit(1)).alias("__yt"))
    d = enriched.filter((F.col("is_private") == 0) & (F.col("event_date") >= floor_date(cfg))).agg(
        F.count_if(F.col("activity_type") == "search").alias("__maps"))
    one = attach_scalar(attach_scalar(attach_scalar(attach_scalar(a, b), c), d),
                        maps_kpis.select(F.col("cities_visited").alias("citiesVisited")))
    return one.select("songsStreamed", "artistsListened", "videosWatched", "youtubeChannels",
                      (F.col("__yt") + F.col("__maps")).alias("searchQueries"), "citiesVisited", "spotifyHours",
                      "youtubeHours")


def gold_home_daily_data_generation(spark: SparkSession, cfg: Cfg, unified: DataFrame) -> DataFrame:
    u = unified.filter((F.col("event_ts") >= F.date_sub(today(cfg), 90).cast("timestamp"))
                       & (F.col("event_ts") <= now(cfg)))
    src = F.col("source")
    return u.groupBy(F.to_date("event_ts").alias("date")).agg(
        F.count_if(src == "spotify").alias("spotify"), F.count_if(src == "youtube").alias("youtube"),
        F.count_if(src == "calendar").alias("google"), F.count_if(src == "maps").alias("maps")).orderBy("date")


def gold_home_recent_events(spark: SparkSession, cfg: Cfg, unified: DataFrame) -> DataFrame:
    """≤ 10 newest per source (per-group limit before the shuffle)."""
    t = top_n_per_group(unified, ["source"], [F.col("event_ts").desc(), F.col("event_id")], 10, "recency_rank")
    sub = (F.when(F.col("source") == "spotify", F.col("subtitle")).when(F.col("source") == "maps", F.col("kind"))
           .otherwise(F.lit("")))
    return t.select("source", "recency_rank", "title", sub.alias("subtitle"), iso_utc("event_ts").alias("time"),
                    "image_url", F.col("kind").alias("activity_type"), "is_from_ads").orderBy("source", "recency_rank")


def live_timeline(spark: SparkSession, cfg: Cfg, unified: DataFrame, limit: int = 60) -> DataFrame:
    """Last 30 days, newest ``limit`` events, action label, joined text,
    blank rows dropped, and the minutes the list spans (PIP-16)."""
    w = unified.filter((F.col("event_ts") <= now(cfg))
                       & (F.col("event_ts") >= F.timestamp_add("DAY", F.lit(-30), now(cfg))))
    top = top_n(w, limit, [F.col("event_ts").desc(), F.col("event_id").desc()])
    lab = top.select("*", join_nonblank("title", "subtitle").alias("value"), kind_label("kind").alias("label"))
    oldest = F.min("event_ts").over(Window.partitionBy())  # over ≤ limit rows
    span = (F.unix_micros(now(cfg)) - F.unix_micros(oldest)) / 60000000.0
    return lab.filter(F.col("value") != "").select(
        iso_utc("event_ts").alias("time"), F.col("source").alias("channel"), "label", "value",
        F.greatest(F.lit(1), F.floor(span + 0.5)).cast("long").alias("window_minutes"))


def overview_series(spark: SparkSession, cfg: Cfg, daily_generation: DataFrame, days: int = 30) -> DataFrame:
    """Last ``days`` rows of the daily generation ascending, with per-source
    totals and the mean per day as columns (PIP-17, SRT-05, AGG-25)."""
    last = top_n(daily_generation, days, [F.col("date").desc()]).withColumn(
        "total", F.col("spotify") + F.col("youtube") + F.col("google") + F.col("maps"))
    allw = Window.partitionBy()  # over ≤ days rows
    return last.select("*", F.sum("total").over(allw).alias("sum_total"),
                       F.round(F.sum("total").over(allw) / F.count(F.lit(1)).over(allw)).alias("avg_per_day")
                       ).orderBy("date")
