"""Page bundles (PIP-18): several gold models shaped for one consumer,
returned as a dict of lazy DataFrames (the serving layer is not built).
Also the reshaping helpers of the consumers (ARR-08, PRJ-11, PRJ-13,
AGG-26, AGG-28, SRT-07, STR-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.text import truncate_ellipsis
from daybook.operators.topn import top_n, top_n_plus_other
from daybook.plans import calendar, home, maps, spotify, unified, youtube


def current_track_shaped(current: DataFrame) -> DataFrame:
    """Artists zipped from parallel id/name arrays into objects (missing
    name → ''), image urls into objects; an empty table yields one
    ``no_track`` row (ARR-08, PRJ-13)."""
    shaped = current.select(
        F.lit(True).alias("has_track"), "track_id", "track_name", "is_playing", "progress_ms", "track_duration_ms",
        F.transform(F.arrays_zip("artists_ids", "artists_names"),
                    lambda x: F.struct(x["artists_ids"].alias("id"),
                                       F.coalesce(x["artists_names"], F.lit("")).alias("name"))).alias("artists"),
        F.transform("album_images", lambda u: F.struct(u.alias("url"))).alias("images"))
    placeholder = shaped.sparkSession.createDataFrame([(False,)], "has_track boolean")
    for f in shaped.schema.fields[1:]:
        placeholder = placeholder.withColumn(f.name, F.lit(None).cast(f.dataType))
    # one row always: the real row if present, else the placeholder
    both = shaped.unionByName(placeholder)
    return both.withColumn("__rn", F.row_number().over(Window.orderBy(F.col("has_track").desc()))).filter("__rn = 1").drop("__rn")


def spotify_bundle(spark: SparkSession, cfg: Cfg) -> dict[str, DataFrame]:
    plays = spotify.silver_spotify_plays_merged(spark, cfg)
    return {"kpis": spotify.gold_spotify_kpis_dashboard(spark, cfg, plays),
            "top_artists": spotify.gold_spotify_top_artists(spark, cfg, plays),
            "genres": spotify.gold_spotify_genres(spark, cfg, plays),
            "daily": spotify.gold_spotify_daily_listening(spark, cfg, plays),
            "recent": top_n(spotify.gold_spotify_recent_tracks(spark, cfg, plays), 10, [F.col("played_at").desc()]),
            "current": current_track_shaped(spotify.gold_spotify_current_track(spark, cfg))}


def spotify_summary_bundle(spark: SparkSession, cfg: Cfg, plays: DataFrame | None = None) -> dict[str, DataFrame]:
    """The short form of the music numbers: labelled counts as text in a fixed
    order, and the hours. A warehouse without plays gives zeros."""
    one = spotify.gold_spotify_kpis_summary(spark, cfg, plays)
    text = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    stats = one.select(F.posexplode(F.array(
        F.struct(F.lit("Artists").alias("label"), text("artists").alias("value")),
        F.struct(F.lit("Songs").alias("label"), text("songs").alias("value"))))).select("pos", "col.label", "col.value")
    return {"stats": stats, "total_hours": one.select(F.coalesce("total_hours", F.lit("0 hrs")).alias("total_hours"))}


def overview_bundle(spark: SparkSession, cfg: Cfg, models: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Numbers of the home page (counts as text, hours as numbers) and the last
    30 days of data per source in ascending order, with their sum and mean.
    ``models``: built models to read (``registry.build_all``, or what
    ``run_daily`` wrote); without them both are built here."""
    from daybook.plans.registry import MODELS
    known = models or {}
    get = lambda name: known[name] if name in known else MODELS[name](spark, cfg)
    counts = ("songsStreamed", "artistsListened", "videosWatched", "youtubeChannels", "searchQueries", "citiesVisited")
    summary = get("gold_home_overview_stats").select(
        *[F.coalesce(F.col(c).cast("long"), F.lit(0)).cast("string").alias(c) for c in counts],
        *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("spotifyHours", "youtubeHours")])
    series = home.overview_series(spark, cfg, get("gold_home_daily_data_generation")).withColumnRenamed("google", "calendar")
    totals = series.agg(F.coalesce(F.max("sum_total"), F.lit(0)).cast("long").cast("string").alias("totalEvents"),
                        F.coalesce(F.max("avg_per_day"), F.lit(0)).cast("long").cast("string").alias("avgPerDay"))
    return {"summary": summary, "daily": series.select("date", "spotify", "youtube", "calendar", "maps"), "totals": totals}


def home_bundle(spark: SparkSession, cfg: Cfg, models: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Everything of the home page: the overview, the newest events of each
    source, the live timeline and the track that plays."""
    known = models or {}
    uni = known["silver_events_unified"] if "silver_events_unified" in known else unified.silver_events_unified(spark, cfg)
    given = {"gold_home_daily_data_generation": home.gold_home_daily_data_generation(spark, cfg, uni),
             "gold_home_recent_events": home.gold_home_recent_events(spark, cfg, uni)} | known
    current = given.get("gold_spotify_current_track")
    return {**overview_bundle(spark, cfg, given),
            **{f"recent_{k}": v for k, v in recent_by_source(given["gold_home_recent_events"]).items()},
            "timeline": home.live_timeline(spark, cfg, uni),
            "current": current_track_shaped(current if current is not None else spotify.gold_spotify_current_track(spark, cfg))}


def youtube_bundle(spark: SparkSession, cfg: Cfg) -> dict[str, DataFrame]:
    w = youtube.silver_youtube_watches(spark, cfg)
    s = youtube.silver_youtube_searches(spark, cfg)
    channels = youtube.gold_youtube_top_channels_dashboard(spark, cfg, w)
    pie = top_n_plus_other(channels.select(F.col("channel_title").alias("name"),
                                           F.col("watch_count").alias("value")), "name", "value", 5)
    share = pie.withColumn("share", F.col("value") / F.sum("value").over(Window.partitionBy()))  # AGG-28
    recent = youtube.gold_youtube_recent_videos_dashboard(spark, cfg, w).withColumn(
        "title", truncate_ellipsis(F.col("title"), 50))
    return {"kpis": youtube.gold_youtube_kpis_with_watch_time_dashboard(spark, cfg, w, s),
            "channels": channels.withColumn("channel_title", truncate_ellipsis(F.col("channel_title"), 80)),
            "channel_pie": share,
            "categories": youtube.gold_youtube_category_breakdown_dashboard(spark, cfg, w),
            "daily": youtube.gold_youtube_daily_watch_time_breakdown_dashboard(spark, cfg, w, s),
            "hourly": youtube.gold_youtube_hourly_activity_dashboard(spark, cfg, w),
            "recent": recent}


def travel_bundle(spark: SparkSession, cfg: Cfg) -> dict[str, DataFrame]:
    e = maps.silver_maps_activity_enriched(spark, cfg)
    daily = maps.gold_maps_daily_activity_dashboard(spark, cfg, e)
    totals = daily.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                         for c in ("directions", "searches", "explorations", "other")])
    distribution = totals.select(F.expr(
        "stack(4, 'directions', directions, 'searches', searches, 'explorations', explorations, 'other', other)"
        " AS (name, value)")).filter("value > 0")                        # AGG-26, FLT-14
    return {"kpis": maps.gold_maps_kpis_dashboard(spark, cfg, e),
            "locations": maps.gold_maps_locations_dashboard(spark, cfg, e).filter("lat != 0 AND lng != 0"),
            "destinations": maps.gold_maps_destinations_dashboard(spark, cfg, e),
            "hourly": maps.gold_maps_hourly_activity_dashboard(spark, cfg, e),
            "daily": daily, "distribution": distribution,
            "recent": maps.gold_maps_recent_activities(spark, cfg, e),
            "trips": top_n(maps.gold_maps_trips(spark, cfg), 100, [F.col("start").desc()])}


def calendar_bundle(spark: SparkSession, cfg: Cfg) -> dict[str, DataFrame]:
    ev = calendar.silver_calendar_events(spark, cfg)
    return {name: getattr(calendar, f"gold_calendar_{name}")(spark, cfg, ev)
            for name in ("kpis", "busy_hours", "categories", "weekday_breakdown", "daily_events", "week_grid",
                         "upcoming_events")}


def recent_by_source(recent_events: DataFrame) -> dict[str, DataFrame]:
    """Per-source reshaping of the home feed (PRJ-11, SRT-09)."""
    r = recent_events.orderBy("source", "recency_rank")
    return {
        "spotify": r.filter("source = 'spotify'").select(F.col("title").alias("track"),
                                                         F.col("subtitle").alias("artist"), "time", "image_url"),
        "youtube": r.filter("source = 'youtube'").select("title", "time", "is_from_ads"),
        "maps": r.filter("source = 'maps'").select(F.col("title").alias("location"),
                                                   F.col("subtitle").alias("kind"), "time"),
        "calendar": r.filter("source = 'calendar'").select("title", "time"),
    }
