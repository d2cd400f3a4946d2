"""Google export normalisers: Maps activity, starred places, YouTube watch
and search history, video/channel objects, calendar events (SRC-12..19)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.maps import classify_title, url_ftid, url_latlng, url_query
from daybook.functions.text import channel_id, video_id
from daybook.functions.timefn import parse_iso

MY_ACTIVITY_DDL = ("header string, title string, titleUrl string, time string, products array<string>, "
                   "subtitles array<struct<name:string,url:string>>, details array<struct<name:string>>")
STARRED_DDL = "features array<struct<geometry:struct<coordinates:array<string>>>>"
VIDEO_DDL = ("id string, snippet struct<title:string,channelId:string,categoryId:string,publishedAt:string,"
             "defaultLanguage:string>, contentDetails struct<duration:string>")
CHANNEL_DDL = ("id string, snippet struct<title:string,thumbnails:struct<default:struct<url:string>>>, "
               "statistics struct<subscriberCount:string>, primary_category_name string")
CALENDAR_EVENT_DDL = ("id string, status string, summary string, description string, location string, "
                      "start struct<dateTime:string,date:string>, end struct<dateTime:string,date:string>, "
                      "attendees array<struct<email:string>>, recurringEventId string")


def _s(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def maps_activity_rows(entries: DataFrame) -> DataFrame:
    """MyActivity entries → ``maps_activity`` rows (SRC-12): only
    ``header == 'Maps'`` with a parseable time; title prefix classifier;
    URL fallbacks for an empty search query / place name; ftid and
    ``!3d!4d`` coordinates from the URL."""
    e = entries.filter(F.col("header") == "Maps").withColumn("event_ts", parse_iso("time")) \
        .filter(F.col("event_ts").isNotNull())
    c = e.withColumn("c", classify_title("title")).withColumn("u", _s(F.col("titleUrl")))
    q = F.when((F.col("c.activity_type") == "search") & (F.col("c.query") == ""), url_query("u")).otherwise(F.col("c.query"))
    pn = F.when((F.col("c.activity_type") == "view_place") & (F.col("c.place_name") == ""), url_query("u")) \
        .otherwise(F.col("c.place_name"))
    ll = url_latlng("u")
    return c.select("event_ts", F.col("c.activity_type").alias("activity_type"), q.alias("query"),
                    pn.alias("place_name"), url_ftid("u").alias("place_id"), ll["lat"].alias("lat"),
                    ll["lng"].alias("lng"), F.col("c.origin").alias("origin"),
                    F.col("c.destination").alias("destination"), F.col("u").alias("raw_url"))


def starred_place_rows(collections: DataFrame, radius_m: int = 100) -> DataFrame:
    """GeoJSON features ([lng, lat]) → private places with a fixed radius;
    malformed and 0/0 points dropped; only coordinates leave (SRC-13)."""
    f = collections.select(F.explode("features").alias("f"))
    co = F.col("f.geometry.coordinates")
    lng, lat = F.get(co, 0).try_cast("double"), F.get(co, 1).try_cast("double")
    return (f.select(lat.alias("lat"), lng.alias("lng"))
            .filter(F.col("lat").isNotNull() & F.col("lng").isNotNull() & ~((F.col("lat") == 0) & (F.col("lng") == 0)))
            .withColumn("radius_m", F.lit(radius_m).cast("int")))


def youtube_watch_rows(entries: DataFrame) -> DataFrame:
    """Watch entries (SRC-14): need a video id and a time; 'Watched '
    stripped; channel from the first subtitle; ad flag from details."""
    vid = video_id(F.col("titleUrl"))
    ts = parse_iso("time")
    e = entries.withColumn("__vid", vid).withColumn("__ts", ts).filter((F.col("__vid") != "") & F.col("__ts").isNotNull())
    sub = F.get(F.col("subtitles"), 0)
    ads = F.coalesce(F.exists(F.col("details"), lambda d: _s(d["name"]).contains("From Google Ads")), F.lit(False))
    return e.select(F.col("__ts").alias("watched_at"), F.col("__vid").alias("video_id"),
                    F.regexp_replace(_s(F.col("title")), "^Watched ", "").alias("video_title"),
                    _s(F.col("titleUrl")).alias("video_url"), channel_id(sub["url"]).alias("channel_id"),
                    _s(sub["name"]).alias("channel_title"), F.lit("watched").alias("activity_type"),
                    ads.alias("is_from_ads"))


def youtube_search_rows(entries: DataFrame) -> DataFrame:
    """Search entries (SRC-15): title prefix 'Searched for '."""
    t = _s(F.col("title"))
    e = entries.filter(t.startswith("Searched for ")).withColumn("searched_at", parse_iso("time")) \
        .filter(F.col("searched_at").isNotNull())
    return e.select("searched_at", F.regexp_replace(t, "^Searched for ", "").alias("query"))


def youtube_archive(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One read, two outputs (SRC-16): a watch if it has a video id and a
    time, else a search if it is one, else dropped."""
    watch = youtube_watch_rows(entries)
    is_watch = (video_id(F.col("titleUrl")) != "") & parse_iso("time").isNotNull()
    return watch, youtube_search_rows(entries.filter(~is_watch))


def iso_duration_seconds(x) -> Column:
    """ISO-8601 duration (PT#H#M#S, optional days) → seconds (SRC-17)."""
    c = _s(F.col(x) if isinstance(x, str) else x)

    days = F.coalesce(F.regexp_extract(c, "P(?:\\d+W)?(\\d+)D", 1).try_cast("long"), F.lit(0))
    h = F.coalesce(F.regexp_extract(c, "T(?:.*?)(\\d+)H", 1).try_cast("long"), F.lit(0))
    m = F.coalesce(F.regexp_extract(c, "T(?:[^M]*?H)?(\\d+)M", 1).try_cast("long"), F.lit(0))
    s = F.coalesce(F.regexp_extract(c, "T(?:.*?[HM])?(\\d+)S", 1).try_cast("long"), F.lit(0))
    return days * 86400 + h * 3600 + m * 60 + s


def youtube_video_rows(videos: DataFrame) -> DataFrame:
    """Video objects (SRC-17): missing publishedAt → epoch."""
    sn = F.col("snippet")
    return videos.select(
        _s(F.col("id")).alias("video_id"), _s(sn["title"]).alias("video_title"), _s(sn["channelId"]).alias("channel_id"),
        _s(sn["categoryId"]).alias("category_id"),
        iso_duration_seconds(F.col("contentDetails.duration")).alias("duration_seconds"),
        F.coalesce(parse_iso(sn["publishedAt"]), F.lit("1970-01-01 00:00:00").cast("timestamp")).alias("published_at"),
        _s(sn["defaultLanguage"]).alias("default_language"))


def youtube_channel_rows(channels: DataFrame) -> DataFrame:
    """Channel objects (SRC-18)."""
    return channels.select(
        _s(F.col("id")).alias("channel_id"), _s(F.col("snippet.title")).alias("channel_title"),
        _s(F.col("primary_category_name")).alias("primary_category_name"),
        F.coalesce(F.col("statistics.subscriberCount").try_cast("long"), F.lit(0)).alias("subscriber_count"),
        _s(F.col("snippet.thumbnails.default.url")).alias("thumbnail_url"))


def _cal_ts(x: Column) -> Column:
    raw = F.coalesce(F.nullif(x["dateTime"], F.lit("")), F.nullif(x["date"], F.lit("")))
    promoted = F.when(raw.isNotNull() & ~raw.contains("T"), F.concat(raw, F.lit("T00:00:00+00:00"))).otherwise(raw)
    return parse_iso(promoted)


def calendar_event_rows(events: DataFrame, calendar_id: str | Column = "calendar_id",
                        calendar_name: str | Column = "calendar_name") -> DataFrame:
    """Calendar events (SRC-19): dateTime, else all-day date promoted to
    midnight UTC; rows missing start or end dropped; attendee count; status
    default 'confirmed'."""
    cid = F.col(calendar_id) if isinstance(calendar_id, str) else calendar_id
    cname = F.col(calendar_name) if isinstance(calendar_name, str) else calendar_name
    e = events.withColumn("__s", _cal_ts(F.col("start"))).withColumn("__e", _cal_ts(F.col("end"))) \
        .filter(F.col("__s").isNotNull() & F.col("__e").isNotNull())
    return e.select(
        _s(F.col("id")).alias("event_id"), _s(cid).alias("calendar_id"), _s(cname).alias("calendar_name"),
        F.col("__s").alias("started_at"), F.col("__e").alias("ended_at"), _s(F.col("summary")).alias("title"),
        _s(F.col("description")).alias("description"), _s(F.col("location")).alias("location"),
        F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("confirmed")).alias("status"),
        F.size(F.coalesce(F.col("attendees"), F.array().cast("array<struct<email:string>>"))).alias("attendee_count"),
        _s(F.col("recurringEventId")).alias("recurrence_id"))
