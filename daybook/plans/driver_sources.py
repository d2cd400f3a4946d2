"""Driver twins of the source normalisers and of the jobs fed by them.

Each query writes driver rows as export records (JSON lines in the layout of
the export), reads them with the export's schema and runs the library's
normaliser. The oracle computes the expected rows from the driver columns.
Times are compared as microseconds since the epoch, arrays as joined text;
the exports carry missing fields, unparseable times and records to drop, so
the rules for them decide rows too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans.driver import _ev, query
from daybook.session import scratch_path
from daybook.sources import google, places, spotify
from daybook.sources.driver import read

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
EV = f"(SELECT event_id, ts, user_id, event_type, value, {K} AS k, CAST(round(value * 1000) AS BIGINT) AS ms FROM events)"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return _ev(spark, d).withColumn("k", F.get_json_object("props", "$.k").cast("long")) \
        .withColumn("ms", F.round(F.col("value") * 1000).cast("long"))


def _text(*parts) -> Column:
    """Concatenation of literals (``'…``) and columns as text."""
    return F.concat(*[F.lit(p[1:]) if p.startswith("'") else F.col(p).cast("string") for p in parts])


def _iso(ts: str = "ts") -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _export(df: DataFrame, name: str, ddl: str, /, **fields: Column) -> DataFrame:
    """``fields`` of each row as one JSON line, read back with the schema of the export."""
    spark = df.sparkSession
    path = scratch_path(spark, f"export-{name}")
    df.select(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("value")).write.text(path)
    return spark.read.schema(spotify.schema(ddl)).json(path)


def _us(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.unix_micros(c))
    return df


def _joined(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.array_join(c, ","))
    return df


def _item() -> Column:
    """A track object: no album for clicks, images for even k only, a nameless
    artist for odd users."""
    album = F.struct(_text("'b", "k").alias("id"), _text("'Album ", "k").alias("name"), F.when(
        F.col("k") % 2 == 0, F.array(F.struct(_text("'http://img/", "k").alias("url")))).alias("images"))
    artist = F.struct(_text("'a", "user_id").alias("id"),
                      F.when(F.col("user_id") % 2 == 0, _text("'User ", "user_id")).alias("name"))
    return F.struct(_text("'t", "k").alias("id"), _text("'Track ", "k").alias("name"), _text("'spotify:track:t", "k").alias("uri"),
                    F.col("ms").alias("duration_ms"), F.when(F.col("event_type") != "click", album).alias("album"),
                    F.array(artist, F.struct(F.lit("guest").alias("id"), F.lit("Guest").alias("name"))).alias("artists"))


ITEM_SQL = """'t' || k AS track_id, 'Track ' || k AS track_name, 'spotify:track:t' || k AS track_uri,
  CASE WHEN event_type <> 'click' THEN 'Album ' || k ELSE '' END AS album_name,
  CASE WHEN event_type <> 'click' AND k % 2 = 0 THEN 'http://img/' || k ELSE '' END AS album_images,
  'a' || user_id || ',guest' AS artists_ids,
  CASE WHEN user_id % 2 = 0 THEN 'User ' || user_id ELSE '' END || ',Guest' AS artists_names"""


# --------------------------------------------------------------------------
# SRC-05/06 now-playing payload with the device payload as fallback
# --------------------------------------------------------------------------
@query("source_now_playing", f"""
SELECT epoch_us(ts) AS captured_at, {ITEM_SQL}, CAST(ms AS INTEGER) AS track_duration_ms, CAST(k AS INTEGER) AS progress_ms,
  event_type <> 'signup' AS is_playing, CASE WHEN event_type <> 'click' THEN 'b' || k ELSE '' END AS album_id,
  'd' || user_id AS device_id, CASE WHEN k % 3 = 0 THEN 0 ELSE CAST(k AS INTEGER) END AS device_volume_percent,
  CASE WHEN event_type = 'signup' THEN '' ELSE 'playlist' END AS context_type
FROM {EV} WHERE event_type <> 'error'
""")
def source_now_playing(spark, d):
    """Errors carry no item and give no row; sign-ups carry it in the fallback
    payload only (which has no context and is paused)."""
    ev = _events(spark, d)
    device = F.struct(_text("'d", "user_id").alias("id"), F.when(F.col("k") % 3 != 0, F.col("k").cast("int")).alias("volume_percent"))
    signup, error = F.col("event_type") == "signup", F.col("event_type") == "error"
    main = F.struct(F.lit(True).alias("is_playing"), F.col("k").alias("progress_ms"), F.when(~signup & ~error, _item()).alias("item"),
                    device.alias("device"), F.struct(F.lit("playlist").alias("type")).alias("context"))
    other = F.struct(F.col("k").alias("progress_ms"), F.when(signup, _item()).alias("item"), device.alias("device"))
    raw = _export(ev, "now-playing", f"at bigint, payload struct<{spotify.NOW_PLAYING_DDL}>, fallback struct<{spotify.NOW_PLAYING_DDL}>",
                  at=F.unix_micros(F.col("ts").cast("timestamp")), payload=main, fallback=other)
    out = spotify.now_playing_rows(raw.withColumn("captured_at", F.timestamp_micros("at")), fallback="fallback")
    return _joined(_us(out, "captured_at"), "album_images", "artists_ids", "artists_names").select(
        "captured_at", "track_id", "track_name", "track_uri", "album_name", "album_images", "artists_ids", "artists_names",
        "track_duration_ms", "progress_ms", "is_playing", "album_id", "device_id", "device_volume_percent", "context_type")


# --------------------------------------------------------------------------
# SRC-07/08/09 pages of plays, pages of saved tracks, extended history
# --------------------------------------------------------------------------
@query("source_recently_played", f"""
SELECT epoch_us(ts) AS played_at, {ITEM_SQL}, ms AS duration_ms FROM {EV} WHERE k % 7 <> 0
""")
def source_recently_played(spark, d):
    """Pages of two items; the second has no time, the first has none a parser
    accepts where k is a multiple of 7."""
    first = F.struct(F.when(F.col("k") % 7 == 0, F.lit("yesterday")).otherwise(_iso()).alias("played_at"), _item().alias("track"))
    second = F.struct(F.lit(None).cast("string").alias("played_at"), _item().alias("track"))
    pages = _export(_events(spark, d), "recently-played", spotify.RECENTLY_PLAYED_DDL, items=F.array(first, second))
    out = _joined(_us(spotify.recently_played_rows(pages), "played_at"), "album_images", "artists_ids", "artists_names")
    return out.drop("context_type", "context_uri")


@query("source_saved_tracks", f"""
SELECT epoch_us(ts) AS added_at, 't' || k AS track_id, '' AS track_uri FROM {EV} WHERE event_type <> 'error'
""")
def source_saved_tracks(spark, d):
    item = F.struct(F.when(F.col("event_type") != "error", _iso()).alias("added_at"), F.struct(_text("'t", "k").alias("id")).alias("track"))
    pages = _export(_events(spark, d), "saved-tracks", spotify.SAVED_TRACKS_DDL, items=F.array(item))
    return _us(spotify.saved_tracks_rows(pages), "added_at")


@query("source_extended_history", f"""
SELECT epoch_us(date_trunc('second', ts)) AS played_at, 't' || k AS track_id, 'spotify:track:t' || k AS track_uri,
  'Track ' || k AS track_name, CASE WHEN user_id % 2 = 0 THEN 'User ' || user_id ELSE '' END AS artists_names, '' AS album_name
FROM {EV} WHERE event_type NOT IN ('click', 'error')
""")
def source_extended_history(spark, d):
    """Clicks are episodes, errors have no uri; times are whole seconds."""
    kind = F.when(F.col("event_type") == "click", _text("'spotify:episode:e", "k")).when(
        F.col("event_type") != "error", _text("'spotify:track:t", "k"))
    raw = _export(_events(spark, d), "extended-history", spotify.EXTENDED_HISTORY_DDL,
                  ts=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), spotify_track_uri=kind,
                  master_metadata_track_name=_text("'Track ", "k"),
                  master_metadata_album_artist_name=F.when(F.col("user_id") % 2 == 0, _text("'User ", "user_id")), ms_played=F.col("ms"))
    out = _joined(_us(spotify.extended_history_rows(raw), "played_at"), "artists_names")
    return out.select("played_at", "track_id", "track_uri", "track_name", "artists_names", "album_name")


# --------------------------------------------------------------------------
# SRC-10/11 track and artist objects
# --------------------------------------------------------------------------
@query("source_track_catalog", """
SELECT 't' || p_partkey AS track_id, p_name AS track_name, CAST(p_size * 1000 AS BIGINT) AS duration_ms, p_size % 2 = 1 AS explicit,
  CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size END AS popularity, CASE WHEN p_size % 4 = 0 THEN 'ISRC' || p_partkey ELSE '' END AS isrc,
  p_brand AS album_name,
  CASE p_size % 4 WHEN 0 THEN CAST(1950 + p_size AS VARCHAR) || '-03-09' WHEN 1 THEN CAST(1950 + p_size AS VARCHAR) || '-03-01'
    WHEN 2 THEN CAST(1950 + p_size AS VARCHAR) || '-01-01' ELSE NULL END AS album_release_date, p_type || ',x' AS artists_ids
FROM part
""")
def source_track_catalog(spark, d):
    """Release dates come as days, months, years and as a year out of range."""
    year = (F.col("p_size") + 1950).cast("string")
    m = F.col("p_size") % 4
    released = (F.when(m == 0, F.concat(year, F.lit("-03-09"))).when(m == 1, F.concat(year, F.lit("-03"))).when(m == 2, year)
                .otherwise(F.lit("0000")))
    raw = _export(read(spark, d, "part"), "tracks", spotify.ITEM,
                  id=_text("'t", "p_partkey"), name=F.col("p_name"), duration_ms=F.col("p_size") * 1000,
                  explicit=F.when(F.col("p_size") % 2 == 1, F.lit(True)), popularity=F.when(F.col("p_size") % 5 != 0, F.col("p_size")),
                  external_ids=F.when(m == 0, F.struct(_text("'ISRC", "p_partkey").alias("isrc"))),
                  album=F.struct(F.col("p_brand").alias("name"), released.alias("release_date")),
                  artists=F.array(F.struct(F.col("p_type").alias("id")), F.struct(F.lit("x").alias("id"))))
    out = _joined(spotify.track_catalog_rows(raw), "artists_ids").withColumn("album_release_date", F.col("album_release_date").cast("string"))
    return out.select("track_id", "track_name", "duration_ms", "explicit", "popularity", "isrc", "album_name", "album_release_date", "artists_ids")


@query("source_artist_catalog", """
SELECT 'a' || c_custkey AS artist_id, c_name AS artist_name,
  CASE WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment) || ',live' ELSE '' END AS genres, c_nationkey AS popularity,
  CASE WHEN c_nationkey = 3 THEN 0 ELSE c_custkey * 10 END AS followers,
  CASE WHEN c_nationkey = 5 THEN '' ELSE 'http://img/' || c_custkey END AS image_url
FROM customer
""")
def source_artist_catalog(spark, d):
    n = F.col("c_nationkey")
    raw = _export(read(spark, d, "customer"), "artists", spotify.ARTIST_DDL, id=_text("'a", "c_custkey"), name=F.col("c_name"),
                  genres=F.when(n % 2 == 0, F.array(F.lower("c_mktsegment"), F.lit("live"))), popularity=n,
                  followers=F.when(n != 3, F.struct((F.col("c_custkey") * 10).alias("total"))),
                  images=F.when(n != 5, F.array(F.struct(_text("'http://img/", "c_custkey").alias("url")))))
    return _joined(spotify.artist_catalog_rows(raw), "genres").drop("artist_uri")


# --------------------------------------------------------------------------
# SRC-12/13 map activity, starred places
# --------------------------------------------------------------------------
@query("source_maps_activity", f"""
SELECT epoch_us(ts) AS event_ts,
  CASE event_type WHEN 'view' THEN 'search' WHEN 'click' THEN 'directions' WHEN 'error' THEN 'other' ELSE 'view_place' END AS activity_type,
  CASE WHEN event_type = 'view' THEN 'place ' || k ELSE '' END AS query,
  CASE event_type WHEN 'signup' THEN 'Area ' || k WHEN 'purchase' THEN 'Place ' || k ELSE '' END AS place_name,
  CASE WHEN event_type = 'purchase' THEN '0x' || k || ':0xab' ELSE '' END AS place_id,
  CASE WHEN event_type = 'purchase' THEN CAST('-' || user_id % 90 || '.25' AS DOUBLE) ELSE 0 END AS lat,
  CASE WHEN event_type = 'purchase' THEN CAST(user_id || '.5' AS DOUBLE) ELSE 0 END AS lng,
  CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'A ' || k ELSE '' END AS origin,
  CASE WHEN event_type = 'click' THEN 'B ' || k || ' to C' ELSE '' END AS destination
FROM {EV} WHERE k % 10 <> 0 AND k % 7 <> 0
""")
def source_maps_activity(spark, d):
    """Titles of every kind; other products and unparseable times drop out."""
    e = F.col("event_type")
    title = (F.when(e == "view", _text("'Searched for place ", "k"))
             .when((e == "click") & (F.col("user_id") % 2 == 0), _text("'Directions from A ", "k", "' to B ", "k", "' to C"))
             .when(e == "click", _text("'  Directions to B ", "k", "' to C ")).when(e == "signup", _text("'Viewed area around Area ", "k"))
             .when(e == "error", F.lit("Used Maps")).otherwise(_text("'Place ", "k")))
    lat = F.concat(F.lit("-"), (F.col("user_id") % 90).cast("string"), F.lit(".25"))
    url = F.concat(_text("'https://www.google.com/maps/place/x/data=!3d"), lat, _text("'!4d", "user_id", "'.5?ftid=0x", "k", "':0xab&hl=en"))
    raw = _export(_events(spark, d), "maps", google.MY_ACTIVITY_DDL, header=F.when(F.col("k") % 10 == 0, "Search").otherwise("Maps"),
                  title=title, titleUrl=F.when(e == "purchase", url), time=F.when(F.col("k") % 7 == 0, F.lit("n/a")).otherwise(_iso()))
    return _us(google.maps_activity_rows(raw), "event_ts").drop("raw_url")


@query("source_starred_places", """
SELECT CAST(c_nationkey || '.25' AS DOUBLE) AS lat, CAST('-' || c_custkey % 180 || '.5' AS DOUBLE) AS lng, 100 AS radius_m
FROM customer WHERE c_nationkey NOT IN (3, 5, 7)
""")
def source_starred_places(spark, d):
    """A collection per customer: its place and, for some nations, a point at
    0/0, text for a number or a point with one coordinate."""
    n = F.col("c_nationkey")
    point = (F.when(n == 3, F.array(F.lit("0"), F.lit("0"))).when(n == 5, F.array(F.lit("east"), F.lit("1"))).when(n == 7, F.array(F.lit("1")))
             .otherwise(F.array(F.concat(F.lit("-"), (F.col("c_custkey") % 180).cast("string"), F.lit(".5")), _text("c_nationkey", "'.25"))))
    raw = _export(read(spark, d, "customer"), "starred", google.STARRED_DDL,
                  features=F.array(F.struct(F.struct(point.alias("coordinates")).alias("geometry"))))
    return google.starred_place_rows(raw)


# --------------------------------------------------------------------------
# SRC-14/15/16 one archive of watches and searches
# --------------------------------------------------------------------------
@query("source_youtube_archive", f"""
SELECT epoch_us(ts) AS at, CASE WHEN event_type = 'error' THEN 'search' ELSE 'watch' END AS kind,
  CASE WHEN event_type = 'error' THEN '' ELSE lpad(CAST(k AS VARCHAR), 11, '0') END AS video_id,
  CASE WHEN event_type = 'error' THEN 'cats ' || k ELSE 'Video ' || k END AS title,
  CASE WHEN event_type <> 'error' AND user_id % 2 = 1 THEN 'UC' || user_id ELSE '' END AS channel_id,
  CASE WHEN event_type <> 'error' AND user_id % 2 = 1 THEN 'Channel ' || user_id ELSE '' END AS channel_title,
  event_type <> 'error' AND value > 300 AS is_from_ads
FROM {EV} WHERE event_type <> 'signup' AND k % 7 <> 0
""")
def source_youtube_archive(spark, d):
    """Watches by long and short address, searches, entries that are neither
    (sign-ups) and entries without a time."""
    e, u = F.col("event_type"), F.col("user_id")
    vid = F.lpad(F.col("k").cast("string"), 11, "0")
    url = (F.when(e == "click", F.concat(F.lit("https://youtu.be/"), vid, F.lit("?t=10")))
           .when(e.isin("view", "purchase"), F.concat(F.lit("https://www.youtube.com/watch?app=x&v="), vid))
           .when(e == "error", _text("'https://www.youtube.com/results?search_query=cats+", "k")))
    title = F.when(e == "error", _text("'Searched for cats ", "k")).when(e == "signup", F.lit("Visited")).otherwise(_text("'Watched Video ", "k"))
    sub = F.when(u % 2 == 1, F.array(F.struct(_text("'Channel ", "user_id").alias("name"),
                                              _text("'https://www.youtube.com/channel/UC", "user_id").alias("url"))))
    raw = _export(_events(spark, d), "youtube", google.MY_ACTIVITY_DDL, title=title, titleUrl=url, subtitles=sub,
                  time=F.when(F.col("k") % 7 != 0, _iso()), details=F.when(
                      F.col("value") > 300, F.array(F.struct(F.lit("From Google Ads").alias("name")))))
    watch, search = google.youtube_archive(raw)
    e = F.lit("")
    return _us(watch.select(F.col("watched_at").alias("at"), F.lit("watch").alias("kind"), "video_id", F.col("video_title").alias("title"),
                            "channel_id", "channel_title", "is_from_ads").unionByName(
        search.select(F.col("searched_at").alias("at"), F.lit("search").alias("kind"), e.alias("video_id"), F.col("query").alias("title"),
                      e.alias("channel_id"), e.alias("channel_title"), F.lit(False).alias("is_from_ads"))), "at")


# --------------------------------------------------------------------------
# SRC-17/18 video and channel objects
# --------------------------------------------------------------------------
@query("source_youtube_videos", """
SELECT 'v' || p_partkey AS video_id, p_name AS video_title, CAST(p_size AS VARCHAR) AS category_id,
  CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_size * 977 + (p_partkey % 2) * 86400 END AS duration_seconds,
  CASE WHEN p_size % 2 = 0 THEN 1577934245000000 ELSE 0 END AS published_at,
  CASE WHEN p_size % 3 = 0 THEN 'en' ELSE '' END AS default_language
FROM part
""")
def source_youtube_videos(spark, d):
    """Durations of days, hours, minutes and seconds, each part only where it is
    not zero; objects without a duration or a publication time."""
    s, size = F.col("p_size") * 977, F.col("p_size")

    def part(n: Column, unit: str) -> Column:
        return F.when(n > 0, F.concat(n.cast("int").cast("string"), F.lit(unit))).otherwise("")

    iso = F.concat(F.lit("P"), F.when(F.col("p_partkey") % 2 == 1, "1D").otherwise(""), F.lit("T"), part(F.floor(s / 3600), "H"),
                   part(F.floor(s % 3600 / 60), "M"), part(s % 60, "S"))
    raw = _export(read(spark, d, "part"), "videos", google.VIDEO_DDL, id=_text("'v", "p_partkey"), snippet=F.struct(
        F.col("p_name").alias("title"), size.cast("string").alias("categoryId"),
        F.when(size % 2 == 0, F.lit("2020-01-02T03:04:05Z")).alias("publishedAt"), F.when(size % 3 == 0, "en").alias("defaultLanguage")),
        contentDetails=F.when(size % 9 != 0, F.struct(iso.alias("duration"))))
    return _us(google.youtube_video_rows(raw), "published_at").drop("channel_id")


@query("source_youtube_channels", """
SELECT 'c' || c_custkey AS channel_id, c_name AS channel_title, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE '' END AS primary_category_name,
  CASE WHEN c_nationkey IN (3, 5) THEN 0 ELSE c_custkey END AS subscriber_count,
  CASE WHEN c_nationkey = 7 THEN '' ELSE 'http://img/' || c_custkey END AS thumbnail_url
FROM customer
""")
def source_youtube_channels(spark, d):
    """Subscriber counts come as text: hidden for one nation, missing for another."""
    n = F.col("c_nationkey")
    thumbs = F.struct(F.struct(_text("'http://img/", "c_custkey").alias("url")).alias("default"))
    raw = _export(read(spark, d, "customer"), "channels", google.CHANNEL_DDL, id=_text("'c", "c_custkey"),
                  snippet=F.struct(F.col("c_name").alias("title"), F.when(n != 7, thumbs).alias("thumbnails")),
                  statistics=F.struct(F.when(n == 3, "hidden").when(n != 5, F.col("c_custkey").cast("string")).alias("subscriberCount")),
                  primary_category_name=F.when(n % 2 == 0, F.col("c_mktsegment")))
    return google.youtube_channel_rows(raw)


# --------------------------------------------------------------------------
# SRC-19 calendar events
# --------------------------------------------------------------------------
@query("source_calendar_events", f"""
SELECT 'e' || event_id AS event_id, 'cal' || user_id AS calendar_id, 'Team ' || user_id AS calendar_name,
  epoch_us(CASE WHEN event_type = 'purchase' THEN date_trunc('day', ts) ELSE ts END) AS started_at,
  epoch_us(CASE WHEN event_type = 'purchase' THEN date_trunc('day', ts) + INTERVAL 1 DAY ELSE ts + to_minutes(CAST(k AS INTEGER)) END) AS ended_at,
  'Meeting ' || k AS title, CASE WHEN k % 2 = 0 THEN 'place ' || k ELSE '' END AS location,
  CASE k % 5 WHEN 0 THEN 'cancelled' ELSE 'confirmed' END AS status, CAST(CASE WHEN k % 4 = 0 THEN 0 ELSE k % 4 END AS INTEGER) AS attendee_count
FROM {EV} WHERE event_type <> 'error'
""")
def source_calendar_events(spark, d):
    """Purchases are whole days, sign-ups carry an offset of two hours, errors
    have no end; some events have an empty or no status and no attendees."""
    k, e = F.col("k"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    end = F.timestamp_add("MINUTE", k, ts)
    shifted = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"

    def moment(t: Column) -> Column:
        return F.when(e == "signup", F.date_format(F.timestamp_add("HOUR", F.lit(2), t), shifted)).otherwise(
            F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))

    day = e == "purchase"
    raw = _export(_events(spark, d), "calendar", f"calendar_id string, calendar_name string, {google.CALENDAR_EVENT_DDL}",
                  id=_text("'e", "event_id"), calendar_id=_text("'cal", "user_id"), calendar_name=_text("'Team ", "user_id"),
                  status=F.when(k % 5 == 0, "cancelled").when(k % 5 == 1, "").when(k % 5 == 2, "confirmed"),
                  summary=_text("'Meeting ", "k"), location=F.when(k % 2 == 0, _text("'place ", "k")),
                  start=F.struct(F.when(~day, moment(ts)).alias("dateTime"), F.when(day, F.date_format("ts", "yyyy-MM-dd")).alias("date")),
                  end=F.when(e != "error", F.struct(F.when(~day, moment(end)).alias("dateTime"), F.when(
                      day, F.date_format(F.date_add(F.to_date("ts"), 1), "yyyy-MM-dd")).alias("date"))),
                  attendees=F.when(k % 4 != 0, F.array_repeat(F.struct(F.lit("x@example.com").alias("email")), (k % 4).cast("int"))))
    return _us(google.calendar_event_rows(raw), "started_at", "ended_at").drop("description", "recurrence_id")


# --------------------------------------------------------------------------
# SRC-20..24, FLT-11, PIP-07 resolution of a work list of places
# --------------------------------------------------------------------------
@query("source_places_resolved", """
WITH w AS (SELECT *, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'zoom meeting ' || c_custkey ELSE 'hall ' || c_custkey END AS text FROM customer
           WHERE c_nationkey <> 3),
r AS (SELECT *, c_mktsegment <> 'MACHINERY' AND c_nationkey <> 1 AND (c_acctbal > 0 OR c_nationkey % 2 = 0) AS ok, c_acctbal > 0 AS first FROM w)
SELECT 'q:' || text AS place_id, CASE WHEN NOT ok THEN '' WHEN first THEN c_name ELSE 'Road ' || c_custkey END AS place_name,
  CASE WHEN NOT ok THEN '' WHEN first THEN lower(c_mktsegment) ELSE 'street' END AS primary_type,
  CASE WHEN ok THEN CAST(c_nationkey || '.25' AS DOUBLE) ELSE 0 END AS lat, CASE WHEN ok THEN CAST(c_custkey % 180 || '.5' AS DOUBLE) ELSE 0 END AS lng,
  CASE WHEN ok THEN 'Sub ' || c_nationkey ELSE '' END AS neighborhood,
  CASE WHEN ok AND c_nationkey % 2 = 0 THEN 'District' WHEN ok THEN 'Sub ' || c_nationkey ELSE '' END AS sublocality,
  CASE WHEN ok THEN 'NL' ELSE '' END AS country_code,
  CASE WHEN NOT ok THEN 0 WHEN first THEN c_nationkey * 4 ELSE 70 END AS confidence_pct,
  CASE WHEN NOT ok THEN 'unresolved' WHEN first THEN 'amenity' ELSE 'poi' END AS match_type
FROM r
""")
def source_places_resolved(spark, d):
    """Customers as places to resolve: one nation is known already, meeting links
    are no places, results at 0/0 count as misses, the second provider answers
    for those the first has no result for."""
    from daybook.functions.text import text_key
    n, machine, first = F.col("c_nationkey"), F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") > 0
    c = read(spark, d, "customer").withColumn("text", F.when(machine, _text("'zoom meeting ", "c_custkey")).otherwise(_text("'hall ", "c_custkey")))
    c = c.withColumn("geo_key", text_key("text"))
    raw = _export(c.filter(first | (n % 2 == 0)), "geocoder", f"first boolean, {places.GEOCODE_RESULT_DDL}", first=first,
                  key=F.col("geo_key"), place_id=_text("'g", "c_custkey"), name=F.when(first, F.col("c_name")),
                  address_line1=_text("'Road ", "c_custkey"), category=F.when(first, F.concat(F.lit("poi."), F.lower("c_mktsegment"))),
                  result_type=F.when(first, F.lit("amenity")).otherwise("street"),
                  lat=F.when(n == 1, F.lit(0.0)).otherwise(_text("c_nationkey", "'.25").cast("double")),
                  lon=F.when(n == 1, F.lit(0.0)).otherwise(F.concat((F.col("c_custkey") % 180).cast("string"), F.lit(".5")).cast("double")),
                  suburb=_text("'Sub ", "c_nationkey"), district=F.when(n % 2 == 0, F.lit("District")), country_code=F.lit("nl"),
                  rank=F.struct((n / 25).alias("confidence")))
    found = places.provider_fallback(places.geocoder_rows(raw.filter("first")),
                                     places.secondary_scored(places.geocoder_rows(raw.filter("NOT first"))))
    catalog = c.filter(n == 3).select(F.col("geo_key").alias("place_id"))
    out = places.resolve_places(c.select("geo_key", "text"), found, catalog)
    return out.select("place_id", "place_name", "primary_type", "lat", "lng", "neighborhood", "sublocality", "country_code",
                      F.round(F.col("match_confidence") * 100).cast("int").alias("confidence_pct"), "match_type")


@query("source_address_components", """
SELECT c_custkey, n_name AS country, upper(left(n_name, 2)) AS country_short, '' AS locality,
  CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) WHEN c_custkey % 3 = 1 THEN 'food' ELSE '' END AS primary_type
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def source_address_components(spark, d):
    """Address parts by kind and the first type that says something (SRC-21/22)."""
    j = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    third = F.col("c_custkey") % 3
    types = (F.when(third == 0, F.array(F.lit("food"), F.lower("c_mktsegment"))).when(third == 1, F.array(F.lit("food"), F.lit("premise")))
             .otherwise(F.array().cast("array<string>")))
    raw = _export(j, "components", "c_custkey bigint, parts array<struct<long_name:string,short_name:string,types:array<string>>>, types array<string>",
                  c_custkey=F.col("c_custkey"), types=types, parts=F.array(
                      F.struct(F.lit("Street").alias("long_name"), F.lit("St").alias("short_name"), F.array(F.lit("route")).alias("types")),
                      F.struct(F.col("n_name").alias("long_name"), F.upper(F.substring("n_name", 1, 2)).alias("short_name"),
                               F.array(F.lit("political"), F.lit("country")).alias("types"))))
    return raw.select("c_custkey", places.address_component("parts", "country").alias("country"),
                      places.address_component("parts", "country", "short_name").alias("country_short"),
                      places.address_component("parts", "locality").alias("locality"), places.primary_type("types").alias("primary_type"))
