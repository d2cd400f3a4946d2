"""Spotify record normalisers (SRC-05..11): raw JSON records (read with an
explicit schema) → bronze rows, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from daybook.functions.text import track_id_from_uri
from daybook.functions.timefn import parse_iso

IMAGES = "array<struct<url:string,height:int,width:int>>"
ARTISTS = "array<struct<id:string,name:string,uri:string>>"
ALBUM = f"struct<id:string,name:string,uri:string,images:{IMAGES},release_date:string>"
ITEM = (f"struct<id:string,name:string,uri:string,duration_ms:bigint,explicit:boolean,popularity:int,"
        f"external_ids:struct<isrc:string>,album:{ALBUM},artists:{ARTISTS}>")
NOW_PLAYING_DDL = (f"is_playing boolean, progress_ms bigint, item {ITEM}, "
                   "device struct<id:string,name:string,type:string,volume_percent:int>, "
                   "context struct<type:string,uri:string>")
RECENTLY_PLAYED_DDL = f"items array<struct<played_at:string,track:{ITEM},context:struct<type:string,uri:string>>>"
SAVED_TRACKS_DDL = "items array<struct<added_at:string,track:struct<id:string,uri:string>>>"
EXTENDED_HISTORY_DDL = ("ts string, spotify_track_uri string, master_metadata_track_name string, "
                        "master_metadata_album_artist_name string, master_metadata_album_album_name string, "
                        "ms_played bigint")
ARTIST_DDL = ("id string, name string, uri string, genres array<string>, popularity int, "
              "followers struct<total:bigint>, images array<struct<url:string>>")


def schema(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def _s(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _urls(images: Column) -> Column:
    return F.coalesce(F.transform(images, lambda i: _s(i["url"])), F.array().cast("array<string>"))


def now_playing_rows(payloads: DataFrame, captured_at: str = "captured_at",
                     fallback: str | None = None) -> DataFrame:
    """Now-playing payload → flat 19-field row (SRC-05). No ``item`` → no
    row; NULLs → defaults; arrays of urls/ids/names. With ``fallback`` the
    struct column ``fallback`` is used when the primary payload has no
    item (SRC-06: device playback, else currently playing)."""
    p = F.col("payload") if "payload" in payloads.columns else F.struct(*[F.col(c) for c in
                                                                             ("is_playing", "progress_ms", "item",
                                                                              "device", "context")])
    if fallback:
        p = F.when(p["item"].isNotNull(), p).otherwise(F.col(fallback))
    df = payloads.withColumn("__p", p).filter(F.col("__p.item").isNotNull())
    it, al, dv, cx = (F.col("__p.item"), F.col("__p.item.album"), F.col("__p.device"), F.col("__p.context"))
    return df.select(
        F.col(captured_at).alias("captured_at"), _s(it["id"]).alias("track_id"), _s(it["name"]).alias("track_name"),
        _s(it["uri"]).alias("track_uri"), F.coalesce(it["duration_ms"], F.lit(0)).cast("int").alias("track_duration_ms"),
        F.coalesce(F.col("__p.progress_ms"), F.lit(0)).cast("int").alias("progress_ms"),
        F.coalesce(F.col("__p.is_playing"), F.lit(False)).alias("is_playing"),
        _s(al["id"]).alias("album_id"), _s(al["name"]).alias("album_name"), _s(al["uri"]).alias("album_uri"),
        _urls(al["images"]).alias("album_images"),
        F.coalesce(F.transform(it["artists"], lambda a: _s(a["id"])), F.array().cast("array<string>")).alias("artists_ids"),
        F.coalesce(F.transform(it["artists"], lambda a: _s(a["name"])), F.array().cast("array<string>"))
        .alias("artists_names"),
        _s(dv["id"]).alias("device_id"), _s(dv["name"]).alias("device_name"), _s(dv["type"]).alias("device_type"),
        F.coalesce(dv["volume_percent"], F.lit(0)).cast("int").alias("device_volume_percent"),
        _s(cx["type"]).alias("context_type"), _s(cx["uri"]).alias("context_uri"))


def recently_played_rows(pages: DataFrame) -> DataFrame:
    """Recently-played pages → play rows (SRC-07); items without a parseable
    time are dropped."""
    e = pages.select(F.explode("items").alias("i"))
    t = F.col("i.track")
    out = e.select(
        parse_iso(F.col("i.played_at")).alias("played_at"), _s(t["id"]).alias("track_id"), _s(t["uri"]).alias("track_uri"),
        _s(t["name"]).alias("track_name"),
        F.coalesce(F.transform(t["artists"], lambda a: _s(a["id"])), F.array().cast("array<string>")).alias("artists_ids"),
        F.coalesce(F.transform(t["artists"], lambda a: _s(a["name"])), F.array().cast("array<string>"))
        .alias("artists_names"),
        _s(t["album"]["name"]).alias("album_name"), _urls(t["album"]["images"]).alias("album_images"),
        F.coalesce(t["duration_ms"], F.lit(0)).cast("long").alias("duration_ms"),
        _s(F.col("i.context.type")).alias("context_type"), _s(F.col("i.context.uri")).alias("context_uri"))
    return out.filter(F.col("played_at").isNotNull())


def saved_tracks_rows(pages: DataFrame) -> DataFrame:
    """Saved-track pages (one file per page) → rows (SRC-08)."""
    e = pages.select(F.explode("items").alias("i"))
    return e.select(parse_iso(F.col("i.added_at")).alias("added_at"), _s(F.col("i.track.id")).alias("track_id"),
                    _s(F.col("i.track.uri")).alias("track_uri")).filter(F.col("added_at").isNotNull())


def extended_history_rows(entries: DataFrame) -> DataFrame:
    """Extended-history entries → play rows (SRC-09): episodes (non-track
    URIs) and entries without a time are skipped; the single album-artist
    name becomes a one-element array."""
    tid = track_id_from_uri("spotify_track_uri")
    artist = _s(F.col("master_metadata_album_artist_name"))
    return entries.select(
        parse_iso("ts").alias("played_at"), tid.alias("track_id"), _s(F.col("spotify_track_uri")).alias("track_uri"),
        _s(F.col("master_metadata_track_name")).alias("track_name"), F.array().cast("array<string>").alias("artists_ids"),
        F.when(artist != "", F.array(artist)).otherwise(F.array().cast("array<string>")).alias("artists_names"),
        _s(F.col("master_metadata_album_album_name")).alias("album_name"),
        F.array().cast("array<string>").alias("album_images"), F.lit(0).cast("long").alias("duration_ms"),
        F.lit("").alias("context_type"), F.lit("").alias("context_uri")
    ).filter(F.col("played_at").isNotNull() & F.col("track_id").isNotNull())


def release_date(x) -> Column:
    """First valid of yyyy-MM-dd, yyyy-MM, yyyy; years outside 1900–2299 → NULL (SRC-10)."""
    c = F.col(x) if isinstance(x, str) else x
    full = F.when(c.rlike("^\\d{4}-\\d{2}-\\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))
    month = F.when(c.rlike("^\\d{4}-\\d{2}$"), F.try_to_date(c, "yyyy-MM"))
    year = F.when(c.rlike("^\\d{4}$"), F.try_to_date(c, "yyyy"))
    d = F.coalesce(full, month, year)
    return F.when(F.year(d).between(1900, 2299), d)


def track_catalog_rows(tracks: DataFrame) -> DataFrame:
    """Track objects → ``spotify_tracks`` rows (SRC-10)."""
    al = F.col("album")
    return tracks.select(
        _s(F.col("id")).alias("track_id"), _s(F.col("name")).alias("track_name"), _s(F.col("uri")).alias("track_uri"),
        F.coalesce(F.col("duration_ms"), F.lit(0)).cast("long").alias("duration_ms"),
        F.coalesce(F.col("explicit"), F.lit(False)).alias("explicit"),
        F.coalesce(F.col("popularity"), F.lit(0)).cast("int").alias("popularity"),
        _s(F.col("external_ids.isrc")).alias("isrc"), _s(al["id"]).alias("album_id"), _s(al["name"]).alias("album_name"),
        _s(al["uri"]).alias("album_uri"), _urls(al["images"]).alias("album_images"),
        release_date(al["release_date"]).alias("album_release_date"),
        F.coalesce(F.transform(F.col("artists"), lambda a: _s(a["id"])), F.array().cast("array<string>"))
        .alias("artists_ids"))


def artist_catalog_rows(artists: DataFrame) -> DataFrame:
    """Artist objects → ``spotify_artists`` rows (SRC-11)."""
    return artists.select(
        _s(F.col("id")).alias("artist_id"), _s(F.col("name")).alias("artist_name"), _s(F.col("uri")).alias("artist_uri"),
        F.coalesce(F.col("genres"), F.array().cast("array<string>")).alias("genres"),
        F.coalesce(F.col("popularity"), F.lit(0)).cast("int").alias("popularity"),
        F.coalesce(F.col("followers.total"), F.lit(0)).cast("long").alias("followers"),
        _s(F.get(F.col("images"), 0)["url"]).alias("image_url"))


def read_json(spark: SparkSession, path, ddl: str, multiline: bool = True) -> DataFrame:
    """Distributed JSON read with an explicit schema (never inferred)."""
    return spark.read.schema(schema(ddl)).option("multiLine", multiline).json(path)
