"""Stand-in bronze tables built from the driver tables, so every silver and
gold model runs end to end on data that grows with the driver's scale.

The mapping only renames and retypes driver rows into the bronze schemas
(``events`` → plays, stream captures, saves, watches, searches, map activity,
calendar entries; ``part`` → track and video catalogs; ``customer`` →
artists, channels and private places; ``supplier`` ⋈ ``nation`` ⋈ ``region``
→ place catalog). None of the models' work happens here. The tables are
written once per (driver folder, checkpoint folder) under
``spark.checkpoint.dir``; models then read them like any warehouse. Inside
``only(names)`` the tables named are written, otherwise all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.text import text_key
from daybook.schemas import TABLES
from daybook.session import ensure_checkpoint_dir
from daybook.sources.driver import read

AS_OF = dt.datetime(2024, 1, 31)
KPI_START = dt.date(2024, 1, 1)
_BUILT: dict[tuple[str, str], tuple[Cfg, set[str]]] = {}   # with the tables written so far
_ONLY: ContextVar[frozenset[str] | None] = ContextVar("standin_only", default=None)


@contextmanager
def only(names: Iterable[str]) -> Iterator[None]:
    """``standin_warehouse`` called inside writes these tables (and what the
    trip job reads, if ``maps_trips`` is one), each whole."""
    token = _ONLY.set(frozenset(names))
    try:
        yield
    finally:
        _ONLY.reset(token)


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


def _ts() -> F.Column:
    return F.col("ts").cast("timestamp")


def _arr(*cols) -> F.Column:
    return F.array(*cols).cast("array<string>")


def _frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    ev = read(spark, d, "events")
    part, cust = read(spark, d, "part"), read(spark, d, "customer")
    sup, nat, reg = read(spark, d, "supplier"), read(spark, d, "nation"), read(spark, d, "region")
    tid = F.concat(F.lit("t"), _k().cast("string"))
    dur = F.round(F.col("value") * 1000).cast("long")
    artist = F.concat(F.lit("a"), F.col("user_id").cast("string"))
    # the history pull lags the stream: history ends two days before the data
    plays = ev.filter("event_type = 'view' AND ts < timestamp_ntz'2024-01-29 00:00:00'").select(
        _ts().alias("played_at"), tid.alias("track_id"), F.concat(F.lit("spotify:track:t"), _k().cast("string")).alias("track_uri"),
        F.concat(F.lit("Track "), _k().cast("string")).alias("track_name"), _arr(artist).alias("artists_ids"),
        _arr(F.concat(F.lit("User "), F.col("user_id").cast("string"))).alias("artists_names"),
        F.lit("").alias("album_name"), _arr().alias("album_images"), dur.alias("duration_ms"),
        F.col("event_type").alias("context_type"), F.lit("").alias("context_uri"))
    current = ev.filter("event_type = 'click'").select(
        _ts().alias("captured_at"), tid.alias("track_id"), F.concat(F.lit("Track "), _k().cast("string")).alias("track_name"),
        F.lit("").alias("track_uri"), dur.cast("int").alias("track_duration_ms"), F.lit(0).alias("progress_ms"),
        F.lit(True).alias("is_playing"), F.lit("").alias("album_id"), F.lit("").alias("album_name"),
        F.lit("").alias("album_uri"), _arr().alias("album_images"), _arr(artist).alias("artists_ids"),
        _arr(F.concat(F.lit("User "), F.col("user_id").cast("string"))).alias("artists_names"),
        F.col("user_id").cast("string").alias("device_id"), F.lit("").alias("device_name"), F.lit("").alias("device_type"),
        F.lit(0).alias("device_volume_percent"), F.lit("").alias("context_type"), F.lit("").alias("context_uri"))
    tracks = part.filter("p_size > 5").select(
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("track_id"), F.col("p_name").alias("track_name"),
        F.lit("").alias("track_uri"), (F.col("p_size") * 10007).cast("long").alias("duration_ms"),
        F.lit(False).alias("explicit"), F.col("p_size").alias("popularity"), F.lit("").alias("isrc"),
        F.lit("").alias("album_id"), F.col("p_brand").alias("album_name"), F.lit("").alias("album_uri"),
        _arr(F.col("p_type")).alias("album_images"), F.lit(None).cast("date").alias("album_release_date"),
        _arr().alias("artists_ids"))
    artists = cust.select(
        F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("artist_id"), F.col("c_name").alias("artist_name"),
        F.lit("").alias("artist_uri"), _arr(F.lower("c_mktsegment")).alias("genres"), F.lit(0).alias("popularity"),
        F.col("c_acctbal").cast("long").alias("followers"), F.lit("").alias("image_url"))
    saved = ev.filter("event_type = 'purchase'").select(_ts().alias("added_at"), tid.alias("track_id"),
                                                        F.lit("").alias("track_uri"))
    place = F.concat(F.lit("place "), _k().cast("string"))
    atype = (F.when(F.col("value") < 50, "directions").when(F.col("value") < 150, "search").otherwise("view_place"))
    maps = ev.filter("event_type IN ('signup', 'error')").select(
        _ts().alias("event_ts"), atype.alias("activity_type"),
        F.when(atype == "search", place).otherwise(F.lit("")).alias("query"),
        F.when(atype == "view_place", place).otherwise(F.lit("")).alias("place_name"), F.lit("").alias("place_id"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"), F.lit("").alias("origin"),
        F.when(atype == "directions", place).otherwise(F.lit("")).alias("destination"), F.lit("").alias("raw_url"))
    lat = ((F.col("s_acctbal") + 1000) % 180) - 90
    lng = ((F.col("s_suppkey") * 7.3) % 360) - 180
    catalog = (sup.join(nat, F.col("n_nationkey") == F.col("s_nationkey"))
               .join(reg, F.col("r_regionkey") == F.col("n_regionkey")).select(
        text_key(F.concat(F.lit("place "), F.col("s_suppkey").cast("string"))).alias("place_id"),
        F.lit("").alias("lookup_key"), F.col("s_name").alias("place_name"), _arr(F.lit("poi")).alias("place_types"),
        F.lit("poi").alias("primary_type"), lat.alias("lat"), lng.alias("lng"), F.lit("").alias("formatted_address"),
        F.lit("").alias("neighborhood"), F.lit("").alias("sublocality"), F.col("n_name").alias("locality"),
        F.lit("").alias("admin_area_1"), F.col("r_name").alias("country"), F.lit("").alias("country_code"),
        F.when(F.col("s_acctbal") > 0, 0.9).otherwise(0.3).cast("float").alias("match_confidence"),
        F.lit("poi").alias("match_type")))
    private = cust.select(
        (((F.col("c_acctbal") + 1000) % 180) - 90).alias("lat"), (((F.col("c_custkey") * 7.3) % 360) - 180).alias("lng"),
        F.when(F.col("c_acctbal") > 9900, 100000).otherwise(200).alias("radius_m"))
    vid = F.concat(F.lit("v"), _k().cast("string"))
    watches = ev.filter("event_type = 'purchase'").select(
        _ts().alias("watched_at"), vid.alias("video_id"), F.concat(F.lit("Video "), _k().cast("string")).alias("video_title"),
        F.lit("").alias("video_url"), F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("channel_id"),
        F.lit("").alias("channel_title"), F.lit("watched").alias("activity_type"), (F.col("value") > 300).alias("is_from_ads"))
    searches = ev.filter("event_type = 'error'").select(_ts().alias("searched_at"),
                                                        F.concat(F.lit("q "), _k().cast("string")).alias("query"))
    videos = part.filter("p_size > 3").select(
        F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("video_id"), F.col("p_name").alias("video_title"),
        F.lit("").alias("channel_id"), F.col("p_size").cast("string").alias("category_id"),
        (F.col("p_size") * 37).cast("long").alias("duration_seconds"),
        F.lit("1970-01-01 00:00:00").cast("timestamp").alias("published_at"), F.lit("").alias("default_language"))
    channels = cust.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("channel_id"),
                           F.col("c_name").alias("channel_title"), F.lit("").alias("primary_category_name"),
                           F.lit(0).cast("long").alias("subscriber_count"), F.lit("").alias("thumbnail_url"))
    calendar = ev.filter("event_type = 'signup'").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("calendar_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("me@example.com"))
         .otherwise(F.concat(F.lit("Team "), F.col("user_id").cast("string"))).alias("calendar_name"),
        _ts().alias("started_at"),
        F.timestamp_add("MINUTE", F.round("value").cast("long"), _ts()).alias("ended_at"),
        F.concat(F.lit("Meeting "), _k().cast("string")).alias("title"), F.lit("").alias("description"),
        place.alias("location"), F.lit("confirmed").alias("status"), (_k() % 5).cast("int").alias("attendee_count"),
        F.lit("").alias("recurrence_id"))
    return {"spotify_plays_raw": plays, "spotify_player_current": current, "spotify_tracks": tracks,
            "spotify_artists": artists, "spotify_saved_tracks": saved, "maps_activity": maps,
            "maps_place_catalog": catalog, "maps_private_places": private, "youtube_watch_history": watches,
            "youtube_search_history": searches, "youtube_videos": videos, "youtube_channels": channels,
            "calendar_events": calendar}


def standin_warehouse(spark: SparkSession, sf_dir: str) -> Cfg:
    """Write the stand-in bronze tables (each once per session) and return the
    Cfg that points at them, with as_of = 2024-01-31 and the KPI floor at
    the first day of the driver's event month."""
    from daybook.jobs.trips import TRIP_TABLES, segment_trips
    from daybook.session import run_parallel
    from daybook.sources.tables import overwrite_guarded
    base = ensure_checkpoint_dir(spark).rstrip("/")
    key = (sf_dir.rstrip("/"), base)
    if key not in _BUILT:
        import uuid
        _BUILT[key] = Cfg(as_of=AS_OF, kpi_start_date=KPI_START, root=f"{base}/standin-{uuid.uuid4().hex[:10]}"), set()
    cfg, written = _BUILT[key]

    def write(name: str, df: DataFrame) -> None:
        spec = TABLES[name]
        out = df.withColumn(spec.version, F.lit(AS_OF).cast("timestamp")) if spec.version else df
        out.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields]) \
            .write.mode("overwrite").parquet(cfg.table_path(spec.layer, spec.name))
        written.add(name)

    wanted = _ONLY.get()
    trips = wanted is None or "maps_trips" in wanted
    if wanted is not None:
        wanted |= frozenset(TRIP_TABLES if trips else ())
    if wanted is None or wanted - written:
        run_parallel([(write, (n, df)) for n, df in _frames(spark, sf_dir).items()
                      if n not in written and (wanted is None or n in wanted)], workers=3)
    if trips and "maps_trips" not in written:
        overwrite_guarded(segment_trips(spark, cfg), cfg, "maps_trips")
        written.add("maps_trips")
    return cfg
