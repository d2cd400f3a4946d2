"""Spotify models: silver plays / speed layer / merge / saved, gold KPIs,
rankings and series (§2.K)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.numeric import fmt_num, round_half, safe_div
from daybook.functions.timefn import iso_utc
from daybook.operators.merge import lambda_merge
from daybook.operators.segments import dwell_segments
from daybook.operators.topn import rank_rows, top_n
from daybook.plans.base import first_or_empty, floor_ts, not_empty, now, s, today
from daybook.schemas import PLAY_COLUMNS
from daybook.sources.tables import read_raw, read_table


def enrich_plays(plays: DataFrame, tracks: DataFrame, artists: DataFrame,
                 duration_col: str = "duration_ms") -> DataFrame:
    """Catalog value preferred, payload fallback (PRJ-05); the artist join
    key is computed from the payload's first artist, else the catalog
    track's first artist (JON-02). Catalogs grow with the data, and their
    compressed size says little about the rows in memory: they are shuffled,
    never collected and broadcast by the driver."""
    t = tracks.select("track_id", F.col("track_name").alias("t_name"), F.col("duration_ms").alias("t_dur"),
                      F.col("album_name").alias("t_album"), F.col("album_images").alias("t_images"),
                      F.col("artists_ids").alias("t_artists"))
    j = plays.join(t.hint("merge"), "track_id", "left")
    j = j.withColumn("primary_artist_id", F.when(not_empty("artists_ids"), first_or_empty("artists_ids"))
                     .otherwise(first_or_empty("t_artists")))
    a = artists.select(F.col("artist_id").alias("primary_artist_id"), F.col("artist_name").alias("a_name"),
                       F.col("genres").alias("a_genres"))
    j = j.join(a.hint("merge"), "primary_artist_id", "left")
    return j.select(
        "played_at", "track_id",
        F.when(s("t_name") != "", F.col("t_name")).otherwise(s("track_name")).alias("track_name"),
        F.when(F.coalesce("t_dur", F.lit(0)) > 0, F.col("t_dur"))
         .otherwise(F.coalesce(F.col(duration_col).cast("long"), F.lit(0))).cast("long").alias("duration_ms"),
        "primary_artist_id",
        F.when(s("a_name") != "", F.col("a_name")).otherwise(first_or_empty("artists_names")).alias("primary_artist_name"),
        F.coalesce("a_genres", F.array().cast("array<string>")).alias("genres"),
        F.when(s("t_album") != "", F.col("t_album")).otherwise(s("album_name")).alias("album_name"),
        F.when(not_empty("t_images"), first_or_empty("t_images")).otherwise(first_or_empty("album_images"))
         .alias("album_art_url"),
        s("context_type").alias("context_type"), s("context_uri").alias("context_uri"))


def silver_spotify_plays(spark: SparkSession, cfg: Cfg) -> DataFrame:
    plays = read_table(spark, cfg, "spotify_plays_raw")
    return enrich_plays(plays, read_table(spark, cfg, "spotify_tracks"), read_table(spark, cfg, "spotify_artists"))


def silver_spotify_plays_stream(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Speed layer: transitions → plays by dwell (STM-05/06/10), enriched
    like history. played_at is the segment END (same convention as the
    history feed)."""
    cur = read_table(spark, cfg, "spotify_player_current").select(
        "captured_at", "track_id", "track_name", "track_duration_ms", "artists_ids", "artists_names",
        "album_name", "album_images", "context_type", "context_uri")
    entity = list(cfg.extra.get("stream_entity", []))
    seg = dwell_segments(cur, entity, "captured_at", "track_id", "track_duration_ms", cfg.as_of,
                         dwell_s=cfg.dwell_seconds, lookback_days=cfg.stream_lookback_days,
                         chunk=F.date_trunc("hour", F.col("captured_at")))
    return enrich_plays(seg, read_table(spark, cfg, "spotify_tracks"), read_table(spark, cfg, "spotify_artists"),
                        duration_col="track_duration_ms")


def silver_spotify_plays_merged(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """History ≤ T ∪ stream > T without same-track rows within the dedup
    window of the boundary; off when history is empty (STM-07/08, FLT-09)."""
    raw = read_raw(spark, cfg, "spotify_plays_raw")
    return lambda_merge(silver_spotify_plays(spark, cfg), silver_spotify_plays_stream(spark, cfg),
                        ["track_id"], "played_at", cfg.dedup_window_seconds, raw_history=raw).select(*PLAY_COLUMNS)


def silver_spotify_saved(spark: SparkSession, cfg: Cfg) -> DataFrame:
    saved = read_table(spark, cfg, "spotify_saved_tracks")
    t = read_table(spark, cfg, "spotify_tracks").select(
        "track_id", F.col("track_name").alias("t_name"), F.col("album_images").alias("t_images"),
        first_or_empty("artists_ids").alias("artist_key"))
    a = read_table(spark, cfg, "spotify_artists").select(F.col("artist_id").alias("artist_key"),
                                                         F.col("artist_name").alias("a_name"))
    j = saved.join(t.hint("merge"), "track_id", "left").join(a.hint("merge"), "artist_key", "left")
    return j.select("added_at", "track_id", s("t_name").alias("track_name"),
                    s("a_name").alias("primary_artist_name"), first_or_empty("t_images").alias("album_art_url"))


# ---------------------------------------------------------------- gold
def _plays(spark, cfg, plays: DataFrame | None = None) -> DataFrame:
    return plays if plays is not None else silver_spotify_plays_merged(spark, cfg)


def gold_spotify_current_track(spark: SparkSession, cfg: Cfg) -> DataFrame:
    cur = read_table(spark, cfg, "spotify_player_current")
    last = top_n(cur, 1, [F.col("captured_at").desc(), F.col("track_id"), F.col("device_id")])
    return last.select(
        "captured_at", "track_id", "track_name", "track_uri", "album_id", "album_name", "album_uri", "album_images",
        first_or_empty("artists_ids").alias("artist_id"), first_or_empty("artists_names").alias("artist_name"),
        F.concat(F.lit("spotify:artist:"), first_or_empty("artists_ids")).alias("artist_uri"),
        "artists_ids", "artists_names", "is_playing", "progress_ms", "track_duration_ms", "device_id",
        "device_name", "device_type", "device_volume_percent", "context_type", "context_uri")


def gold_spotify_recent_tracks(spark: SparkSession, cfg: Cfg, plays: DataFrame | None = None) -> DataFrame:
    """50 newest plays; the top-k runs on the raw timestamp, formatting after (SRT-04)."""
    p = top_n(_plays(spark, cfg, plays), 50, [F.col("played_at").desc(), F.col("track_id"), F.col("track_name"),
                                             F.col("primary_artist_name")])
    return p.select(F.col("track_name").alias("track"), F.col("primary_artist_name").alias("artist"),
                    iso_utc("played_at").alias("played_at"), F.col("album_art_url").alias("album_art"))


def gold_spotify_kpis_summary(spark: SparkSession, cfg: Cfg, plays: DataFrame | None = None) -> DataFrame:
    p = _plays(spark, cfg, plays).filter(F.col("played_at") >= floor_ts(cfg))
    return p.agg(F.countDistinct("primary_artist_id").alias("artists"), F.countDistinct("track_id").alias("songs"),
                 F.concat(fmt_num(F.coalesce(F.sum("duration_ms"), F.lit(0)) / 3600000.0), F.lit(" hrs"))
                 .alias("total_hours"))


def gold_spotify_kpis_dashboard(spark: SparkSession, cfg: Cfg, plays: DataFrame | None = None) -> DataFrame:
    p = _plays(spark, cfg, plays).filter(F.col("played_at") >= floor_ts(cfg))
    st = p.agg(F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("total_ms"), F.countDistinct("track_id").alias("songs"),
               F.countDistinct("primary_artist_id").alias("artists"),
               F.countDistinct(F.to_date("played_at")).alias("active_days"))
    hrs = F.col("total_ms") / 3600000.0
    return st.select(F.concat(fmt_num(hrs), F.lit(" hrs")).alias("total_time"),
                     F.col("songs").cast("string").alias("songs_streamed"),
                     F.col("artists").cast("string").alias("unique_artists"),
                     F.concat(fmt_num(safe_div(hrs, F.col("active_days"))), F.lit(" hrs")).alias("avg_daily"))


def gold_spotify_top_artists(spark: SparkSession, cfg: Cfg, plays: DataFrame | None = None) -> DataFrame:
    """Top 15 artists since the floor with a dense weekly play-count trend."""
    p = _plays(spark, cfg, plays).filter((F.col("primary_artist_id") != "") & (F.col("played_at") >= floor_ts(cfg)))
    a = p.groupBy("primary_artist_id").agg(
        F.max_by("primary_artist_name", F.struct("played_at", "primary_artist_name")).alias("name"),
        F.max_by("genres", F.struct("played_at", "genres")).alias("genres"),
        F.count(F.lit(1)).alias("plays"), round_half(F.sum("duration_ms") / 3600000.0, 1).alias("hours"))
    top = top_n(a, 15, [F.col("plays").desc(), F.col("name"), F.col("primary_artist_id")])
    n_weeks = (cfg.as_of.date() - cfg.kpi_start_date).days // 7 + 1
    week = F.floor(F.datediff(F.to_date("played_at"), F.lit(cfg.kpi_start_date)) / 7).cast("int")
    wk = (p.join(F.broadcast(top.select("primary_artist_id")), "primary_artist_id", "left_semi")
          .groupBy("primary_artist_id", week.alias("w")).agg(F.count(F.lit(1)).alias("c")))
    trend = wk.groupBy("primary_artist_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "c"))).alias("m"))
    trend = trend.select("primary_artist_id", F.transform(
        F.sequence(F.lit(0), F.lit(max(n_weeks, 1) - 1)),
        lambda w: F.coalesce(F.try_element_at(F.col("m"), w), F.lit(0)).cast("long")).alias("trend"))
    ranked = rank_rows(top, [F.col("plays").desc(), F.col("name"), F.col("primary_artist_id")])
    return ranked.join(trend, "primary_artist_id", "left").select(
        "rank", "name", "plays", "hours", first_or_empty("genres").alias("genre"), "trend").orderBy("rank")


def gold_spotify_genres(spark: SparkSession, cfg: Cfg, plays: DataFrame | None = None) -> DataFrame:
    p = _plays(spark, cfg, plays).filter(F.col("played_at") >= floor_ts(cfg))
    g = p.select(F.explode("genres").alias("name")).filter("name != ''")
    return top_n(g.groupBy("name").agg(F.count(F.lit(1)).alias("value")), 20, [F.col("value").desc(), F.col("name")])


def gold_spotify_daily_listening(spark: SparkSession, cfg: Cfg, plays: DataFrame | None = None) -> DataFrame:
    """Hours per day over the last 30 days up to as_of (the 7.2 slice)."""
    lo = F.date_sub(today(cfg), 29).cast("timestamp")
    p = _plays(spark, cfg, plays).filter((F.col("played_at") >= lo) & (F.col("played_at") <= now(cfg)))
    return p.groupBy(F.to_date("played_at").alias("date")).agg(
        round_half(F.sum("duration_ms") / 3600000.0, 1).alias("hours")).orderBy("date")
