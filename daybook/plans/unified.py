"""Unified cross-source event feed (silver_events_unified and branches)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.text import first_nonblank, stable_id

UNIFIED_COLUMNS = ["event_ts", "source", "kind", "title", "subtitle", "image_url", "is_from_ads", "metadata",
                   "event_id"]


def _finish(df: DataFrame, source: str, *keys: str) -> DataFrame:
    """Typed constant columns and the stable id (UID-01: a hash of the
    logical event and its natural key instead of a random UUID, so the same
    meeting in two calendars is two events)."""
    return df.withColumn("source", F.lit(source)).withColumn(
        "event_id", stable_id(F.col("source"), F.col("kind"), F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                              F.col("title"), *keys)).select(*UNIFIED_COLUMNS)


def _meta(*pairs) -> F.Column:
    return F.to_json(F.create_map(*[x for k, v in pairs for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))]))


def events_spotify_plays(plays: DataFrame) -> DataFrame:
    p = plays.filter(F.col("track_id") != "")
    return _finish(p.select(
        F.col("played_at").alias("event_ts"), F.lit("play").alias("kind"), F.col("track_name").alias("title"),
        F.col("primary_artist_name").alias("subtitle"), F.col("album_art_url").alias("image_url"),
        F.lit(0).alias("is_from_ads"),
        _meta(("context_type", F.col("context_type")), ("duration_ms", F.col("duration_ms")),
              ("genres", F.to_json("genres"))).alias("metadata"), F.col("track_id").alias("__k0")), "spotify", "__k0")


def events_spotify_liked(saved: DataFrame) -> DataFrame:
    p = saved.filter(F.col("track_id") != "")
    return _finish(p.select(
        F.col("added_at").alias("event_ts"), F.lit("liked").alias("kind"), F.col("track_name").alias("title"),
        F.col("primary_artist_name").alias("subtitle"), F.col("album_art_url").alias("image_url"),
        F.lit(0).alias("is_from_ads"), _meta(("source", F.lit("spotify_liked"))).alias("metadata")), "spotify")


def events_maps_visits(enriched: DataFrame) -> DataFrame:
    t = F.col("activity_type")
    kind = (F.when(t == "search", "maps_search").when(t == "directions", "maps_directions")
            .when(t == "view_place", "maps_view").otherwise("maps_other"))
    p = enriched.filter(F.col("is_private") == 0)
    return _finish(p.select(
        F.col("event_ts"), kind.alias("kind"), first_nonblank("place_name", "query", F.lit("Maps activity")).alias("title"),
        F.col("primary_type").alias("subtitle"), F.lit("").alias("image_url"), F.lit(0).alias("is_from_ads"),
        _meta(("neighborhood", F.col("neighborhood")), ("locality", F.col("locality")), ("country", F.col("country")),
              ("primary_type", F.col("primary_type")), ("activity_type", t)).alias("metadata")), "maps")


def events_youtube_watches(watches: DataFrame) -> DataFrame:
    p = watches.filter(F.col("video_id") != "")
    return _finish(p.select(
        F.col("watched_at").alias("event_ts"), F.lit("watch").alias("kind"), F.col("video_title").alias("title"),
        F.col("channel_title").alias("subtitle"), F.lit("").alias("image_url"),
        F.col("is_from_ads").cast("int").alias("is_from_ads"),
        _meta(("category_id", F.col("category_id")), ("duration_seconds", F.col("duration_seconds"))).alias("metadata"),
        F.col("video_id").alias("__k0"), F.col("channel_id").alias("__k1")), "youtube", "__k0", "__k1")


def events_calendar(events: DataFrame) -> DataFrame:
    return _finish(events.select(
        F.col("started_at").alias("event_ts"), F.lit("meeting").alias("kind"), F.col("title"),
        F.col("category").alias("subtitle"), F.lit("").alias("image_url"), F.lit(0).alias("is_from_ads"),
        _meta(("duration_minutes", F.col("duration_minutes")), ("location", F.col("location")),
              ("attendee_count", F.col("attendee_count"))).alias("metadata"),
        F.col("calendar_id").alias("__k0"), F.col("event_id").alias("__k1")), "calendar", "__k0", "__k1")


def silver_events_unified(spark: SparkSession, cfg: Cfg, parts: dict[str, DataFrame] | None = None) -> DataFrame:
    """Bag union of the five per-source branches (SET-01)."""
    if parts is None:
        from daybook.plans import calendar, maps, spotify, youtube
        parts = {
            "plays": events_spotify_plays(spotify.silver_spotify_plays_merged(spark, cfg)),
            "liked": events_spotify_liked(spotify.silver_spotify_saved(spark, cfg)),
            "maps": events_maps_visits(maps.silver_maps_activity_enriched(spark, cfg)),
            "youtube": events_youtube_watches(youtube.silver_youtube_watches(spark, cfg)),
            "calendar": events_calendar(calendar.silver_calendar_events(spark, cfg)),
        }
    return reduce(DataFrame.unionByName, parts.values())
