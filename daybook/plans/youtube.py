"""YouTube models: silver watches/searches, gold KPIs, channels,
categories, daily breakdown, hourly histogram, recent videos (§2.K)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.categories import category_name
from daybook.functions.numeric import finite_or_zero, pct, round_half, safe_div
from daybook.functions.timefn import DAY_NAMES, iso_dow, iso_utc, readable_delta
from daybook.operators.spine import densify, int_spine
from daybook.operators.topn import top_n
from daybook.plans.base import floor_date, s, today
from daybook.plans.common import distinct_counts
from daybook.sources.tables import read_table


def silver_youtube_watches(spark: SparkSession, cfg: Cfg) -> DataFrame:
    w = read_table(spark, cfg, "youtube_watch_history")
    v = read_table(spark, cfg, "youtube_videos").select(
        "video_id", F.col("video_title").alias("v_title"), F.col("channel_id").alias("v_channel"),
        F.col("duration_seconds").alias("v_dur"), F.col("category_id").alias("v_cat"))
    j = w.join(v.hint("merge"), "video_id", "left")
    j = j.withColumn("channel_key", F.when(s("v_channel") != "", F.col("v_channel")).otherwise(s("channel_id")))
    ch = read_table(spark, cfg, "youtube_channels").select(F.col("channel_id").alias("channel_key"),
                                                          F.col("channel_title").alias("ch_title"))
    j = j.join(ch.hint("merge"), "channel_key", "left")
    return j.select(
        "watched_at", "video_id",
        F.when(s("v_title") != "", F.col("v_title")).otherwise(s("video_title")).alias("video_title"),
        s("video_url").alias("video_url"), F.col("channel_key").alias("channel_id"),
        F.when(s("ch_title") != "", F.col("ch_title")).otherwise(s("channel_title")).alias("channel_title"),
        s("activity_type").alias("activity_type"), F.coalesce("is_from_ads", F.lit(False)).alias("is_from_ads"),
        F.coalesce("v_dur", F.lit(0)).cast("long").alias("duration_seconds"), s("v_cat").alias("category_id"),
        F.to_date("watched_at").alias("watched_date"), F.hour("watched_at").alias("watched_hour"))


def silver_youtube_searches(spark: SparkSession, cfg: Cfg) -> DataFrame:
    q = read_table(spark, cfg, "youtube_search_history")
    return q.select("searched_at", "query", F.to_date("searched_at").alias("searched_date"))


def _watches(spark, cfg, watches=None):
    w = watches if watches is not None else silver_youtube_watches(spark, cfg)
    return w.filter(F.col("watched_date") >= floor_date(cfg))


def gold_youtube_kpis_with_watch_time_dashboard(spark: SparkSession, cfg: Cfg, watches=None,
                                                searches=None) -> DataFrame:
    """One KPI row (AGG-14): watches are summed once by (channel, video,
    category, date); totals and the distinct counts are aggregates over that
    table, joined as scalars. No watch row is expanded."""
    from daybook.operators.merge import attach_scalar
    w = _watches(spark, cfg, watches)
    sr = (searches if searches is not None else silver_youtube_searches(spark, cfg)) \
        .filter(F.col("searched_date") >= floor_date(cfg))
    d = F.col("duration_seconds")
    per = w.groupBy("channel_id", "video_id", "category_id", "watched_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_from_ads").alias("ads"), F.sum(d).alias("secs"),
        F.sum(F.when(d > 0, d)).alias("pos"), F.count_if(d > 0).alias("enriched"))
    a = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("ads"), F.lit(0)).alias("ads"), F.sum("secs").alias("secs"),
                F.try_divide(F.sum("pos").cast("double"), F.sum("enriched")).alias("avg_pos"),
                F.coalesce(F.sum("enriched"), F.lit(0)).alias("enriched"),
                F.min("watched_date").alias("first"), F.max("watched_date").alias("last"))
    a = attach_scalar(a, distinct_counts(
        per, unique_channels=F.nullif(F.col("channel_id"), F.lit("")), unique_videos=F.col("video_id"),
        unique_categories=F.nullif(F.col("category_id"), F.lit("")), days=F.col("watched_date")))
    b = sr.agg(F.count(F.lit(1)).alias("total_searches"))
    k = attach_scalar(a, b)
    avg_s = finite_or_zero(round_half(F.col("avg_pos"), 0))
    return k.select(
        F.col("n").alias("videos_watched"), "total_searches", F.col("ads").alias("total_ads_watched"),
        round_half(safe_div(F.col("ads"), F.col("n")) * 100.0, 1).alias("ads_percentage"),
        F.coalesce("secs", F.lit(0)).alias("total_watch_time_seconds"),
        readable_delta(F.coalesce("secs", F.lit(0))).alias("total_watch_time_formatted"),
        avg_s.alias("avg_watch_time_seconds"), readable_delta(avg_s).alias("avg_watch_time_formatted"),
        "unique_channels", "unique_videos", "unique_categories",
        round_half(safe_div(F.col("n"), F.col("days")), 1).alias("avg_activities_per_day"),
        round_half(safe_div(F.col("n"), F.col("days")), 1).alias("avg_watched_per_day"),
        round_half(safe_div(F.col("enriched"), F.col("n")) * 100.0, 1).alias("enrichment_percentage"),
        F.coalesce(F.col("first").cast("string"), F.lit("1970-01-01")).alias("first_activity_date"),
        F.coalesce(F.col("last").cast("string"), F.lit("1970-01-01")).alias("last_activity_date"))


def gold_youtube_top_channels_dashboard(spark: SparkSession, cfg: Cfg, watches=None) -> DataFrame:
    w = _watches(spark, cfg, watches).filter(F.col("channel_id") != "")
    r = w.groupBy("channel_id").agg(
        F.max_by("channel_title", "watched_at").alias("channel_title"), F.count(F.lit(1)).alias("watch_count"),
        F.sum("duration_seconds").alias("total_watch_time_seconds"),
        F.countDistinct("video_id").alias("unique_videos_watched"),
        F.mode(F.when(F.col("category_id") != "", F.col("category_id")), deterministic=True).alias("top_cat"))
    top = top_n(r, 10, [F.col("total_watch_time_seconds").desc(), F.col("watch_count").desc(), F.col("channel_id")])
    return top.select("channel_id", "channel_title", "watch_count", "total_watch_time_seconds",
                      readable_delta("total_watch_time_seconds").alias("total_watch_time_formatted"),
                      category_name(F.coalesce("top_cat", F.lit(""))).alias("primary_category"),
                      "unique_videos_watched")


def gold_youtube_category_breakdown_dashboard(spark: SparkSession, cfg: Cfg, watches=None) -> DataFrame:
    """Category label per watch (unknown id → Other, two ids share
    'Comedy'), totals and shares per label."""
    m = _watches(spark, cfg, watches).filter(F.col("category_id") != "").select(
        category_name("category_id").alias("category_name"), "duration_seconds", "channel_id")
    g = m.groupBy("category_name").agg(F.count(F.lit(1)).alias("watch_count"),
                                       F.sum("duration_seconds").alias("total_watch_time_seconds"),
                                       F.countDistinct("channel_id").alias("unique_channels"))
    tot = Window.partitionBy()  # over the per-category rows only (bounded by the label map)
    return g.select("category_name", "watch_count", "total_watch_time_seconds",
                    readable_delta("total_watch_time_seconds").alias("total_watch_time_formatted"),
                    pct(F.col("watch_count"), F.sum("watch_count").over(tot)).alias("watch_percentage"),
                    pct(F.col("total_watch_time_seconds"), F.sum("total_watch_time_seconds").over(tot))
                    .alias("time_percentage"),
                    "unique_channels").orderBy(F.col("watch_count").desc())


def gold_youtube_daily_watch_time_breakdown_dashboard(spark: SparkSession, cfg: Cfg, watches=None,
                                                      searches=None) -> DataFrame:
    lo, hi = F.date_sub(today(cfg), 29), today(cfg)
    w = (watches if watches is not None else silver_youtube_watches(spark, cfg)) \
        .filter(F.col("watched_date").between(lo, hi))
    sr = (searches if searches is not None else silver_youtube_searches(spark, cfg)) \
        .filter(F.col("searched_date").between(lo, hi))
    ads = F.col("is_from_ads")
    wd = w.groupBy(F.col("watched_date").alias("date")).agg(
        F.count_if(~ads).alias("watched_count"), F.count_if(ads).alias("ads_count"),
        F.sum(F.when(~ads, F.col("duration_seconds"))).alias("watched_seconds"),
        F.sum(F.when(ads, F.col("duration_seconds"))).alias("ads_seconds"))
    sd = sr.groupBy(F.col("searched_date").alias("date")).agg(F.count(F.lit(1)).alias("searches_count"))
    days = wd.select("date").union(sd.select("date")).distinct()
    j = days.join(wd, "date", "left").join(sd, "date", "left")
    ws, as_ = F.coalesce("watched_seconds", F.lit(0)), F.coalesce("ads_seconds", F.lit(0))
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return j.select(
        "date", round_half(ws / 3600.0, 2).alias("watched_hours"), F.lit(0.0).alias("searches_hours"),
        F.lit(0.0).alias("visits_hours"), round_half(as_ / 3600.0, 2).alias("ads_hours"),
        F.lit(0.0).alias("other_hours"),
        round_half(F.coalesce(F.col("watched_seconds") + F.col("ads_seconds"), F.lit(0)) / 3600.0, 2).alias("total_hours"),
        F.coalesce("watched_count", F.lit(0)).cast("long").alias("watched_count"),
        F.coalesce("searches_count", F.lit(0)).cast("long").alias("searches_count"),
        F.lit(0).cast("long").alias("visits_count"), F.coalesce("ads_count", F.lit(0)).cast("long").alias("ads_count"),
        F.get(names, iso_dow("date") - 1).alias("day_name"), (iso_dow("date") >= 6).cast("int").alias("is_weekend")
    ).orderBy("date")


def gold_youtube_hourly_activity_dashboard(spark: SparkSession, cfg: Cfg, watches=None) -> DataFrame:
    c = _watches(spark, cfg, watches).groupBy(F.col("watched_hour").cast("long").alias("h")).agg(
        F.count(F.lit(1)).alias("activities"))
    d = densify(int_spine(spark, "h", 24), c, ["h"], {"activities": 0})
    return d.orderBy("h").select(F.col("h").cast("string").alias("hour"), F.col("activities").cast("long"))


def gold_youtube_recent_videos_dashboard(spark: SparkSession, cfg: Cfg, watches=None) -> DataFrame:
    w = watches if watches is not None else silver_youtube_watches(spark, cfg)
    t = top_n(w, 10, [F.col("watched_at").desc()])
    return t.select(F.col("video_title").alias("title"), iso_utc("watched_at").alias("time"),
                    F.col("is_from_ads").cast("int").alias("is_from_ads"))
