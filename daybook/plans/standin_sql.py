"""DuckDB oracle SQL for the model queries whose outputs compare exactly
(no arrays, no rounded ratios). Each text rebuilds the stand-in bronze rows
from the driver tables (same mapping as ``plans/standin.py``) and then
computes the model independently in SQL."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

WATCH_RAW = f"""SELECT DISTINCT CAST(ts AS TIMESTAMP) AS watched_at, 'v' || CAST({K} AS VARCHAR) AS video_id,
  'Video ' || CAST({K} AS VARCHAR) AS video_title, 'c' || CAST(user_id AS VARCHAR) AS channel_id, value > 300 AS is_from_ads
  FROM events WHERE event_type = 'purchase'"""
VIDEOS = """SELECT 'v' || CAST(p_partkey AS VARCHAR) AS video_id, p_name AS video_title, '' AS channel_id,
  CAST(p_size AS VARCHAR) AS category_id, CAST(p_size * 37 AS BIGINT) AS duration_seconds FROM part WHERE p_size > 3"""
CHANNELS = "SELECT 'c' || CAST(c_custkey AS VARCHAR) AS channel_id, c_name AS channel_title FROM customer"
WATCHES = f"""SELECT w.watched_at, w.video_id,
  CASE WHEN coalesce(v.video_title, '') <> '' THEN v.video_title ELSE w.video_title END AS video_title,
  '' AS video_url, CASE WHEN coalesce(v.channel_id, '') <> '' THEN v.channel_id ELSE w.channel_id END AS channel_id,
  CASE WHEN coalesce(ch.channel_title, '') <> '' THEN ch.channel_title ELSE '' END AS channel_title,
  'watched' AS activity_type, w.is_from_ads, CAST(coalesce(v.duration_seconds, 0) AS BIGINT) AS duration_seconds,
  coalesce(v.category_id, '') AS category_id, CAST(w.watched_at AS DATE) AS watched_date,
  CAST(hour(w.watched_at) AS INTEGER) AS watched_hour
  FROM ({WATCH_RAW}) w LEFT JOIN ({VIDEOS}) v USING (video_id)
  LEFT JOIN ({CHANNELS}) ch ON ch.channel_id = CASE WHEN coalesce(v.channel_id, '') <> '' THEN v.channel_id ELSE w.channel_id END"""
SEARCHES = f"""SELECT DISTINCT CAST(ts AS TIMESTAMP) AS searched_at, 'q ' || CAST({K} AS VARCHAR) AS query
  FROM events WHERE event_type = 'error'"""
CAL = f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS calendar_id,
  CASE WHEN user_id % 2 = 0 THEN 'me@example.com' ELSE 'Team ' || CAST(user_id AS VARCHAR) END AS calendar_name,
  CAST(ts AS TIMESTAMP) AS started_at, CAST(ts AS TIMESTAMP) + to_minutes(CAST(round(value) AS BIGINT)) AS ended_at,
  'Meeting ' || CAST({K} AS VARCHAR) AS title, '' AS description, 'place ' || CAST({K} AS VARCHAR) AS location,
  'confirmed' AS status, CAST({K} % 5 AS INTEGER) AS attendee_count, '' AS recurrence_id
  FROM events WHERE event_type = 'signup'"""
CAL_EVENTS = f"""SELECT event_id, calendar_id, calendar_name,
  CASE WHEN strpos(calendar_name, '@') > 0 THEN 'Personal' ELSE calendar_name END AS category,
  started_at, ended_at, title, description, location, status, attendee_count, recurrence_id,
  CAST(started_at AS DATE) AS event_date, CAST(hour(started_at) AS INTEGER) AS hour_of_day,
  date_diff('minute', started_at, ended_at) AS duration_minutes, CAST(isodow(started_at) AS INTEGER) AS day_of_week,
  CAST(isodow(started_at) >= 6 AS INTEGER) AS is_weekend,
  CAST(hour(started_at) = 0 AND minute(started_at) = 0 AND date_diff('minute', started_at, ended_at) >= 1440
       AND date_diff('minute', started_at, ended_at) % 1440 = 0 AS INTEGER) AS is_all_day
  FROM ({CAL}) WHERE status <> 'cancelled'"""
TIMED = f"SELECT * FROM ({CAL_EVENTS}) WHERE is_all_day = 0 AND started_at <= {AS_OF} AND event_date >= DATE '2024-01-01'"


def _hav_m(lat1, lng1, lat2, lng2) -> str:
    return (f"(2 * 6371.0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) "
            f"* cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))) * 1000.0)")


MAPS_RAW = f"""SELECT CAST(ts AS TIMESTAMP) AS event_ts,
  CASE WHEN value < 50 THEN 'directions' WHEN value < 150 THEN 'search' ELSE 'view_place' END AS activity_type,
  'place ' || CAST({K} AS VARCHAR) AS place FROM events WHERE event_type IN ('signup', 'error')"""
CATALOG = """SELECT 'q:place ' || CAST(s_suppkey AS VARCHAR) AS place_id, ((s_acctbal + 1000) % 180) - 90 AS lat,
  ((s_suppkey * CAST(7.3 AS DOUBLE)) % 360) - 180 AS lng FROM supplier"""
PRIVATE = """SELECT ((c_acctbal + 1000) % 180) - 90 AS lat, ((c_custkey * CAST(7.3 AS DOUBLE)) % 360) - 180 AS lng, CASE WHEN c_acctbal > 9900 THEN 100000.0 ELSE 200.0 END AS radius_m
  FROM customer"""
ENRICHED = f"""SELECT a.event_ts, a.activity_type, CAST(a.event_ts AS DATE) AS event_date,
  CAST(hour(a.event_ts) AS INTEGER) AS hour_of_day,
  CAST(EXISTS (SELECT 1 FROM ({PRIVATE}) p WHERE coalesce(c.lat, 0.0) <> 0 AND coalesce(c.lng, 0.0) <> 0
       AND {_hav_m('coalesce(c.lat, 0.0)', 'coalesce(c.lng, 0.0)', 'p.lat', 'p.lng')} <= p.radius_m) AS INTEGER) AS is_private
  FROM ({MAPS_RAW}) a LEFT JOIN ({CATALOG}) c ON c.place_id = 'q:' || lower(a.place)"""
PUBLIC = f"SELECT * FROM ({ENRICHED}) WHERE is_private = 0"

MODEL_ORACLE: dict[str, str] = {
    "model_silver_youtube_searches": f"SELECT searched_at, query, CAST(searched_at AS DATE) AS searched_date FROM ({SEARCHES})",
    "model_silver_youtube_watches": WATCHES,
    "model_gold_youtube_hourly_activity_dashboard": f"""
        SELECT CAST(h.range AS VARCHAR) AS hour, coalesce(c.n, 0) AS activities
        FROM range(24) h LEFT JOIN (SELECT watched_hour AS hh, count(*) AS n FROM ({WATCHES})
                                    WHERE watched_date >= DATE '2024-01-01' GROUP BY 1) c ON c.hh = h.range""",
    "model_gold_youtube_recent_videos_dashboard": f"""
        SELECT video_title AS title, strftime(watched_at, '%Y-%m-%dT%H:%M:%SZ') AS time,
               CAST(is_from_ads AS INTEGER) AS is_from_ads
        FROM ({WATCHES}) ORDER BY watched_at DESC LIMIT 10""",
    "model_silver_calendar_events": CAL_EVENTS,
    "model_gold_calendar_busy_hours": f"""
        SELECT CAST(h.range AS VARCHAR) || ':00' AS hour, coalesce(c.n, 0) AS events
        FROM range(24) h LEFT JOIN (SELECT hour_of_day AS hh, count(*) AS n FROM ({TIMED}) GROUP BY 1) c ON c.hh = h.range""",
    "model_gold_calendar_weekday_breakdown": f"""
        SELECT d.day, coalesce(c.n, 0) AS events
        FROM (VALUES (1, 'Mon'), (2, 'Tue'), (3, 'Wed'), (4, 'Thu'), (5, 'Fri'), (6, 'Sat'), (7, 'Sun')) d(dow, day)
        LEFT JOIN (SELECT day_of_week AS dow, count(*) AS n FROM ({TIMED}) GROUP BY 1) c USING (dow)""",
    "model_gold_calendar_daily_events": f"""
        SELECT event_date AS date, count(*) AS events FROM ({CAL_EVENTS})
        WHERE event_date >= DATE '2024-01-31' - 371 AND event_date <= DATE '2024-01-31' GROUP BY 1""",
    "model_gold_maps_hourly_activity_dashboard": f"""
        SELECT CAST(h.range AS VARCHAR) AS hour, coalesce(c.n, 0) AS activities
        FROM range(24) h LEFT JOIN (SELECT hour_of_day AS hh, count(*) AS n FROM ({PUBLIC})
                                    WHERE event_date >= DATE '2024-01-01' GROUP BY 1) c ON c.hh = h.range""",
    "model_gold_maps_daily_activity_dashboard": f"""
        SELECT event_date AS date, count(*) FILTER (WHERE activity_type = 'directions') AS directions,
               count(*) FILTER (WHERE activity_type = 'search') AS searches,
               count(*) FILTER (WHERE activity_type = 'view_place') AS explorations,
               count(*) FILTER (WHERE activity_type NOT IN ('directions', 'search', 'view_place')) AS other
        FROM ({PUBLIC}) WHERE event_date BETWEEN DATE '2024-01-31' - 29 AND DATE '2024-01-31' GROUP BY 1""",
}

# ---------------------------------------------------------------- spotify slice
PLAYS_RAW = f"""SELECT DISTINCT CAST(ts AS TIMESTAMP) AS played_at, 't' || CAST({K} AS VARCHAR) AS track_id,
  'Track ' || CAST({K} AS VARCHAR) AS track_name, ['a' || CAST(user_id AS VARCHAR)] AS artists_ids,
  ['User ' || CAST(user_id AS VARCHAR)] AS artists_names, CAST([] AS VARCHAR[]) AS album_images,
  CAST(round(value * 1000) AS BIGINT) AS duration_ms, event_type AS context_type FROM events
  WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-29 00:00:00'"""
CURRENT = f"""SELECT DISTINCT CAST(ts AS TIMESTAMP) AS captured_at, 't' || CAST({K} AS VARCHAR) AS track_id,
  'Track ' || CAST({K} AS VARCHAR) AS track_name, CAST(round(value * 1000) AS INTEGER) AS duration_ms,
  ['a' || CAST(user_id AS VARCHAR)] AS artists_ids, ['User ' || CAST(user_id AS VARCHAR)] AS artists_names,
  CAST([] AS VARCHAR[]) AS album_images, '' AS context_type FROM events WHERE event_type = 'click'"""
TRACKS = """SELECT 't' || CAST(p_partkey AS VARCHAR) AS track_id, p_name AS t_name, CAST(p_size * 10007 AS BIGINT) AS t_dur,
  [p_type] AS t_images, CAST([] AS VARCHAR[]) AS t_artists FROM part WHERE p_size > 5"""
ARTISTS = "SELECT 'a' || CAST(c_custkey AS VARCHAR) AS artist_id, c_name AS a_name FROM customer"


def _enrich(src: str) -> str:
    return f"""SELECT p.played_at, p.track_id,
      CASE WHEN coalesce(t.t_name, '') <> '' THEN t.t_name ELSE p.track_name END AS track_name,
      CASE WHEN coalesce(t.t_dur, 0) > 0 THEN t.t_dur ELSE coalesce(p.duration_ms, 0) END AS duration_ms,
      p.pid AS primary_artist_id,
      CASE WHEN coalesce(a.a_name, '') <> '' THEN a.a_name ELSE coalesce(p.artists_names[1], '') END AS primary_artist_name,
      CASE WHEN len(coalesce(t.t_images, [])) > 0 THEN t.t_images[1] ELSE coalesce(p.album_images[1], '') END AS album_art_url,
      coalesce(p.context_type, '') AS context_type
    FROM (SELECT *, CASE WHEN len(artists_ids) > 0 THEN artists_ids[1] ELSE '' END AS pid FROM ({src})) p
    LEFT JOIN ({TRACKS}) t USING (track_id) LEFT JOIN ({ARTISTS}) a ON a.artist_id = p.pid"""


STREAM_PLAYS = f"""WITH b AS (SELECT *, lag(track_id, 1, '__none__') OVER (ORDER BY captured_at, track_id) AS prev
           FROM ({CURRENT}) WHERE captured_at >= {AS_OF} - INTERVAL 7 DAY),
  s AS (SELECT * FROM b WHERE track_id <> prev AND track_id <> ''),
  n AS (SELECT *, lead(captured_at) OVER (ORDER BY captured_at, track_id) AS next_start FROM s)
  SELECT least(coalesce(next_start, {AS_OF}),
               CASE WHEN duration_ms > 0 THEN captured_at + to_seconds(CAST(floor(duration_ms / 1000) AS BIGINT) + 15)
                    ELSE {AS_OF} END) AS played_at, track_id, track_name, duration_ms, artists_ids, artists_names, album_images,
         context_type, captured_at
  FROM n"""
MERGED = f"""WITH raw AS ({PLAYS_RAW}), tt AS (SELECT max(played_at) AS T FROM raw),
  st AS (SELECT * FROM ({STREAM_PLAYS}) WHERE date_diff('second', captured_at, played_at) >= 30)
  SELECT * FROM ({_enrich('SELECT * FROM raw')}) WHERE played_at <= (SELECT T FROM tt)
  UNION ALL
  SELECT * FROM ({_enrich('SELECT played_at, track_id, track_name, CAST(duration_ms AS BIGINT) AS duration_ms, artists_ids, artists_names, album_images, context_type FROM st')}) s
  WHERE s.played_at > (SELECT T FROM tt) AND (SELECT T FROM tt) > TIMESTAMP '2000-01-01 00:00:00'
    AND NOT EXISTS (SELECT 1 FROM raw r WHERE r.played_at >= (SELECT T FROM tt) - INTERVAL 120 SECOND
                    AND r.track_id = s.track_id AND abs(date_diff('second', r.played_at, s.played_at)) <= 120)"""
SINCE_FLOOR = f"SELECT * FROM ({MERGED}) WHERE played_at >= TIMESTAMP '2024-01-01 00:00:00'"


def _fmt1(x: str) -> str:
    return f"regexp_replace(CAST(round({x}, 1) AS VARCHAR), '\\.0$', '')"


MODEL_ORACLE.update({
    "model_gold_spotify_daily_listening": f"""
        SELECT CAST(played_at AS DATE) AS date, round(sum(duration_ms) / 3600000.0, 1) AS hours FROM ({MERGED})
        WHERE played_at >= CAST(DATE '2024-01-31' - 29 AS TIMESTAMP) AND played_at <= {AS_OF} GROUP BY 1""",
    "model_gold_spotify_kpis_summary": f"""
        SELECT count(DISTINCT primary_artist_id) AS artists, count(DISTINCT track_id) AS songs,
               {_fmt1('coalesce(sum(duration_ms), 0) / 3600000.0')} || ' hrs' AS total_hours FROM ({SINCE_FLOOR})""",
    "model_gold_spotify_kpis_dashboard": f"""
        SELECT {_fmt1('total_ms / 3600000.0')} || ' hrs' AS total_time, CAST(songs AS VARCHAR) AS songs_streamed,
               CAST(artists AS VARCHAR) AS unique_artists,
               {_fmt1('total_ms / 3600000.0 / nullif(active_days, 0)')} || ' hrs' AS avg_daily
        FROM (SELECT coalesce(sum(duration_ms), 0) AS total_ms, count(DISTINCT track_id) AS songs,
                     count(DISTINCT primary_artist_id) AS artists, count(DISTINCT CAST(played_at AS DATE)) AS active_days
              FROM ({SINCE_FLOOR}))""",
    "model_gold_spotify_recent_tracks": f"""
        SELECT track_name AS track, primary_artist_name AS artist, strftime(played_at, '%Y-%m-%dT%H:%M:%SZ') AS played_at,
               album_art_url AS album_art FROM ({MERGED}) ORDER BY played_at DESC LIMIT 50""",
})

# ---------------------------------------------------------------- more models
SAVED = f"""SELECT DISTINCT CAST(ts AS TIMESTAMP) AS added_at, 't' || CAST({K} AS VARCHAR) AS track_id
  FROM events WHERE event_type = 'purchase'"""
MAPS_BRONZE = f"""SELECT CAST(ts AS TIMESTAMP) AS event_ts, t AS activity_type,
  CASE WHEN t = 'search' THEN p ELSE '' END AS query, CASE WHEN t = 'view_place' THEN p ELSE '' END AS place_name,
  '' AS place_id, 0.0 AS lat, 0.0 AS lng, '' AS origin, CASE WHEN t = 'directions' THEN p ELSE '' END AS destination,
  '' AS raw_url, {AS_OF} AS _ingested_at
  FROM (SELECT ts, CASE WHEN value < 50 THEN 'directions' WHEN value < 150 THEN 'search' ELSE 'view_place' END AS t,
               'place ' || CAST({K} AS VARCHAR) AS p FROM events WHERE event_type IN ('signup', 'error'))"""
KEYED = f"""SELECT *, CASE WHEN place_id <> '' THEN place_id
    WHEN best_text = '' THEN ''
    ELSE 'q:' || trim(regexp_replace(lower(best_text), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) END AS geo_key
  FROM (SELECT *, CASE WHEN place_name <> '' THEN place_name WHEN activity_type = 'search' AND query <> '' THEN query
                       WHEN activity_type = 'directions' AND destination <> '' THEN destination
                       WHEN query <> '' THEN query WHEN destination <> '' THEN destination ELSE '' END AS best_text
        FROM ({MAPS_BRONZE}))"""
CATEGORY_MAP = """(VALUES ('1','Film & Animation'),('2','Autos & Vehicles'),('10','Music'),('15','Pets & Animals'),
  ('17','Sports'),('18','Short Movies'),('19','Travel & Events'),('20','Gaming'),('21','Videoblogging'),
  ('22','People & Blogs'),('23','Comedy'),('24','Entertainment'),('25','News & Politics'),('26','Howto & Style'),
  ('27','Education'),('28','Science & Technology'),('29','Nonprofits & Activism'),('30','Movies'),
  ('31','Anime/Animation'),('32','Action/Adventure'),('33','Classics'),('34','Comedy'),('35','Documentary'),
  ('36','Drama'),('37','Family'),('38','Foreign'),('39','Horror'),('40','Sci-Fi/Fantasy'),('41','Thriller'),
  ('42','Shorts'),('43','Shows'),('44','Trailers')) AS m(id, name)"""


def _unit(n: str, word: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST({n} AS VARCHAR) || ' {word}' || CASE WHEN {n} = 1 THEN '' ELSE 's' END END"


def _readable(s: str) -> str:
    y, r1 = f"({s} // 31536000)", f"({s} % 31536000)"
    mo, r2 = f"({r1} // 2635200)", f"({r1} % 2635200)"
    d, r3 = f"({r2} // 86400)", f"({r2} % 86400)"
    h, r4 = f"({r3} // 3600)", f"({r3} % 3600)"
    mi, sec = f"({r4} // 60)", f"({r4} % 60)"
    parts = ", ".join(_unit(x, w) for x, w in ((y, "year"), (mo, "month"), (d, "day"), (h, "hour"), (mi, "minute"),
                                               (sec, "second")))
    return f"CASE WHEN {s} <= 0 THEN '0 seconds' ELSE regexp_replace(concat_ws(', ', {parts}), ', ([^,]*)$', ' and \\1') END"


def _uid(source: str, kind: str, ts: str, title: str, kind_sql: str | None = None, keys: tuple[str, ...] = ()) -> str:
    """sha256 of source:kind:time:title and the natural key (``kind_sql`` for a kind column)."""
    k = kind_sql or f"'{kind}'"
    more = "".join(f", coalesce({c}, '')" for c in keys)
    return f"sha256(concat_ws(':', '{source}', {k}, strftime({ts}, '%Y-%m-%d %H:%M:%S.%f'), coalesce({title}, ''){more}))"


MODEL_ORACLE.update({
    "model_silver_spotify_saved": f"""
        SELECT s.added_at, s.track_id, coalesce(t.t_name, '') AS track_name, coalesce(a.a_name, '') AS primary_artist_name,
               coalesce(t.t_images[1], '') AS album_art_url
        FROM ({SAVED}) s LEFT JOIN ({TRACKS}) t USING (track_id)
        LEFT JOIN ({ARTISTS}) a ON a.artist_id = coalesce(t.t_artists[1], '')""",
    "model_maps_activity_keyed": KEYED,
    "model_silver_events_unified_calendar": f"""
        SELECT started_at AS event_ts, 'calendar' AS source, 'meeting' AS kind, title, category AS subtitle, '' AS image_url,
               0 AS is_from_ads,
               to_json(map(['duration_minutes', 'location', 'attendee_count'],
                           [CAST(duration_minutes AS VARCHAR), location, CAST(attendee_count AS VARCHAR)])) AS metadata,
               {_uid('calendar', 'meeting', 'started_at', 'title', keys=('calendar_id', 'c.event_id'))} AS event_id
        FROM ({CAL_EVENTS}) c""",
    "model_silver_events_unified_youtube_watches": f"""
        SELECT watched_at AS event_ts, 'youtube' AS source, 'watch' AS kind, video_title AS title, channel_title AS subtitle,
               '' AS image_url, CAST(is_from_ads AS INTEGER) AS is_from_ads,
               to_json(map(['category_id', 'duration_seconds'], [category_id, CAST(duration_seconds AS VARCHAR)])) AS metadata,
               {_uid('youtube', 'watch', 'watched_at', 'video_title', keys=('video_id', 'channel_id'))} AS event_id
        FROM ({WATCHES}) WHERE video_id <> ''""",
    "model_gold_youtube_top_channels_dashboard": f"""
        WITH w AS (SELECT * FROM ({WATCHES}) WHERE watched_date >= DATE '2024-01-01' AND channel_id <> ''),
        r AS (SELECT channel_id, arg_max(channel_title, watched_at) AS channel_title, count(*) AS watch_count,
                     CAST(sum(duration_seconds) AS BIGINT) AS total_watch_time_seconds,
                     count(DISTINCT video_id) AS unique_videos_watched FROM w GROUP BY 1),
        c AS (SELECT channel_id, category_id AS top_cat FROM (
                SELECT channel_id, category_id, row_number() OVER (PARTITION BY channel_id ORDER BY count(*) DESC, category_id) AS rn
                FROM w WHERE category_id <> '' GROUP BY 1, 2) WHERE rn = 1),
        t AS (SELECT * FROM r ORDER BY total_watch_time_seconds DESC, watch_count DESC, channel_id LIMIT 10)
        SELECT t.channel_id, t.channel_title, t.watch_count, t.total_watch_time_seconds,
               {_readable('t.total_watch_time_seconds')} AS total_watch_time_formatted,
               CASE WHEN coalesce(c.top_cat, '') = '' THEN '' ELSE coalesce(m.name, 'Other') END AS primary_category,
               t.unique_videos_watched
        FROM t LEFT JOIN c USING (channel_id) LEFT JOIN {CATEGORY_MAP} ON m.id = c.top_cat""",
})

# enriched maps rows with the columns the visit feed and gold maps models read
CATALOG_FULL = """SELECT 'q:place ' || CAST(s_suppkey AS VARCHAR) AS place_id, s_name AS c_name, 'poi' AS primary_type,
  ((s_acctbal + 1000) % 180) - 90 AS lat, ((s_suppkey * CAST(7.3 AS DOUBLE)) % 360) - 180 AS lng, n_name AS locality, r_name AS country,
  CASE WHEN s_acctbal > 0 THEN 0.9 ELSE 0.3 END AS match_confidence
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""
ENRICHED_FULL = f"""SELECT k.event_ts, k.activity_type, k.query,
  CASE WHEN c.place_id IS NOT NULL THEN coalesce(c.c_name, '') ELSE k.place_name END AS place_name,
  coalesce(c.primary_type, '') AS primary_type, coalesce(c.lat, k.lat) AS lat, coalesce(c.lng, k.lng) AS lng,
  '' AS neighborhood, coalesce(c.locality, '') AS locality, coalesce(c.country, '') AS country,
  CAST(k.event_ts AS DATE) AS event_date, CAST(coalesce(c.match_confidence, 0.0) AS FLOAT) AS match_confidence
  FROM ({KEYED}) k LEFT JOIN ({CATALOG_FULL}) c ON c.place_id = k.geo_key"""
PUBLIC_FULL = f"""SELECT * FROM ({ENRICHED_FULL}) e WHERE NOT EXISTS (
  SELECT 1 FROM ({PRIVATE}) p WHERE e.lat <> 0 AND e.lng <> 0 AND {_hav_m('e.lat', 'e.lng', 'p.lat', 'p.lng')} <= p.radius_m)"""


def _label(prefix: str = "") -> str:
    n, lo, c = (f"{prefix}{x}" for x in ("neighborhood", "locality", "country"))
    return (f"CASE WHEN {n} <> '' AND {lo} <> '' THEN {n} || ', ' || {lo} WHEN {lo} <> '' THEN {lo} "
            f"WHEN {c} <> '' THEN {c} ELSE 'Unknown' END")


MAPS_VISITS = f"""SELECT event_ts, 'maps' AS source,
  CASE activity_type WHEN 'search' THEN 'maps_search' WHEN 'directions' THEN 'maps_directions'
       WHEN 'view_place' THEN 'maps_view' ELSE 'maps_other' END AS kind,
  coalesce(nullif(trim(place_name), ''), nullif(trim(query), ''), 'Maps activity') AS title, primary_type AS subtitle,
  '' AS image_url, 0 AS is_from_ads,
  to_json(map(['neighborhood', 'locality', 'country', 'primary_type', 'activity_type'],
              [neighborhood, locality, country, primary_type, activity_type])) AS metadata
  FROM ({PUBLIC_FULL})"""
LIKED = f"""SELECT s.added_at AS event_ts, 'spotify' AS source, 'liked' AS kind, coalesce(t.t_name, '') AS title,
  '' AS subtitle, coalesce(t.t_images[1], '') AS image_url, 0 AS is_from_ads,
  to_json(map(['source'], ['spotify_liked'])) AS metadata
  FROM ({SAVED}) s LEFT JOIN ({TRACKS}) t USING (track_id)"""

MODEL_ORACLE.update({
    "model_silver_events_unified_maps_visits":
        f"SELECT *, {_uid('maps', '', 'event_ts', 'title', kind_sql='kind')} AS event_id FROM ({MAPS_VISITS})",
    "model_silver_events_unified_spotify_liked":
        f"SELECT *, {_uid('spotify', 'liked', 'event_ts', 'title')} AS event_id FROM ({LIKED})",
    "model_gold_maps_recent_activities": f"""
        SELECT strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS time, {_label()} AS location,
               CASE WHEN activity_type = 'directions' THEN 'directions'
                    WHEN activity_type = 'search' AND primary_type <> '' THEN 'search · ' || primary_type
                    WHEN activity_type = 'search' THEN 'search' WHEN primary_type <> '' THEN primary_type ELSE 'view' END AS type
        FROM ({PUBLIC_FULL}) ORDER BY event_ts DESC LIMIT 10""",
    "model_gold_maps_destinations_dashboard": f"""
        WITH a AS (SELECT * FROM ({PUBLIC_FULL}) WHERE event_date >= DATE '2024-01-01'),
        g AS (SELECT {_label()} AS destination, count(*) AS count, min(primary_type) AS type FROM a
              WHERE country IN (SELECT DISTINCT country FROM a WHERE activity_type = 'directions' AND country <> '')
              GROUP BY 1)
        SELECT * FROM g WHERE destination <> 'Unknown' ORDER BY count DESC, destination LIMIT 10""",
    "model_gold_home_daily_data_generation": f"""
        WITH u AS (
          SELECT played_at AS event_ts, 'spotify' AS source FROM ({MERGED}) WHERE track_id <> ''
          UNION ALL SELECT event_ts, 'spotify' FROM ({LIKED})
          UNION ALL SELECT event_ts, 'maps' FROM ({PUBLIC_FULL})
          UNION ALL SELECT watched_at, 'youtube' FROM ({WATCHES})
          UNION ALL SELECT started_at, 'calendar' FROM ({CAL_EVENTS}))
        SELECT CAST(event_ts AS DATE) AS date, count(*) FILTER (WHERE source = 'spotify') AS spotify,
               count(*) FILTER (WHERE source = 'youtube') AS youtube, count(*) FILTER (WHERE source = 'calendar') AS google,
               count(*) FILTER (WHERE source = 'maps') AS maps
        FROM u WHERE event_ts >= CAST(DATE '2024-01-31' - 90 AS TIMESTAMP) AND event_ts <= {AS_OF} GROUP BY 1""",
})

ARTIST_GENRES = "SELECT 'a' || CAST(c_custkey AS VARCHAR) AS artist_id, [lower(c_mktsegment)] AS genres FROM customer"
MERGED_G = f"""SELECT m.*, coalesce(g.genres, CAST([] AS VARCHAR[])) AS genres FROM ({MERGED}) m
  LEFT JOIN ({ARTIST_GENRES}) g ON g.artist_id = m.primary_artist_id"""
PLAYS_FEED = f"""SELECT played_at AS event_ts, 'spotify' AS source, 'play' AS kind, track_name AS title,
  primary_artist_name AS subtitle, album_art_url AS image_url, 0 AS is_from_ads,
  to_json(map(['context_type', 'duration_ms', 'genres'], [context_type, CAST(duration_ms AS VARCHAR), to_json(genres)::VARCHAR]))
    AS metadata, {_uid('spotify', 'play', 'played_at', 'track_name', keys=('track_id',))} AS event_id
  FROM ({MERGED_G}) WHERE track_id <> ''"""
UNIFIED = f"""{PLAYS_FEED}
  UNION ALL SELECT *, {_uid('spotify', 'liked', 'event_ts', 'title')} FROM ({LIKED})
  UNION ALL SELECT *, {_uid('maps', '', 'event_ts', 'title', kind_sql='kind')} FROM ({MAPS_VISITS})
  UNION ALL {MODEL_ORACLE['model_silver_events_unified_youtube_watches']}
  UNION ALL {MODEL_ORACLE['model_silver_events_unified_calendar']}"""

MODEL_ORACLE.update({
    "model_gold_calendar_categories": f"""
        WITH b AS (SELECT category FROM ({CAL_EVENTS}) WHERE started_at <= {AS_OF} AND event_date >= DATE '2024-01-01'),
        g AS (SELECT category AS name, count(*) AS value FROM b GROUP BY 1)
        SELECT name, value, coalesce(round(value / nullif(sum(value) OVER (), 0) * 100.0, 0), 0.0) AS percentage FROM g""",
    "model_gold_spotify_genres": f"""
        SELECT name, count(*) AS value FROM (SELECT unnest(genres) AS name FROM ({MERGED_G})
                                           WHERE played_at >= TIMESTAMP '2024-01-01 00:00:00')
        WHERE name <> '' GROUP BY 1 ORDER BY value DESC, name LIMIT 20""",
    "model_silver_events_unified_spotify_plays": PLAYS_FEED,
    "model_silver_events_unified": UNIFIED,
    "model_gold_home_recent_events": f"""
        SELECT source, row_number() OVER (PARTITION BY source ORDER BY event_ts DESC, event_id) AS recency_rank, title,
               CASE WHEN source = 'spotify' THEN subtitle WHEN source = 'maps' THEN kind ELSE '' END AS subtitle,
               strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS time, image_url, kind AS activity_type, is_from_ads
        FROM ({UNIFIED}) QUALIFY recency_rank <= 10""",
})

MODEL_ORACLE.update({
    "model_gold_calendar_kpis": f"""
        WITH ev AS ({TIMED}), days AS (SELECT count(DISTINCT event_date) AS d FROM ev),
        ws AS (SELECT day_of_week, count(*) AS n FROM ev GROUP BY 1),
        b AS (SELECT coalesce((SELECT ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][day_of_week] FROM ws
                               ORDER BY n DESC, day_of_week LIMIT 1), 'Mon') AS busiestDay)
        SELECT count(*) FILTER (WHERE attendee_count > 0) AS plansCount,
               CAST(greatest(0, 30 - (SELECT d FROM days)) AS BIGINT) AS freeDays,
               count(*) AS totalEvents, CAST(coalesce(round(sum(duration_minutes) / 60.0, 0), 0) AS BIGINT) AS meetingHours,
               coalesce(round(count(*) / nullif((SELECT d FROM days), 0), 1), 0.0) AS avgDaily,
               (SELECT busiestDay FROM b) AS busiestDay
        FROM ev""",
    "model_gold_calendar_upcoming_events": f"""
        SELECT title, category, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS time, duration_minutes AS durationMinutes
        FROM ({CAL_EVENTS}) WHERE started_at >= {AS_OF} AND is_all_day = 0 ORDER BY started_at, event_id LIMIT 8""",
})


TRAVEL = ("(flight|fly to|airport|boarding|layover|✈|hotel|airbnb|hostel|check[ -]?in|check[ -]?out|"
          "trip to|travel to|vacation|holiday|getaway|cruise|train to|ferry|road trip)")
HOME = f"""SELECT locality AS home_locality, country AS home_country, avg(lat) AS home_lat, avg(lng) AS home_lng
  FROM ({PUBLIC_FULL}) WHERE locality <> '' AND match_confidence >= 0.4 GROUP BY 1, 2
  ORDER BY count(*) FILTER (WHERE activity_type = 'directions') * 3 + count(*) FILTER (WHERE activity_type = 'view_place')
           + count(*) FILTER (WHERE activity_type = 'search') DESC, home_locality, home_country LIMIT 1"""
CAL_GEO_J = f"""SELECT e.*, coalesce(c.locality, '') AS geo_locality, coalesce(c.country, '') AS geo_country,
  coalesce(c.lat, 0.0) AS lat, coalesce(c.lng, 0.0) AS lng, CAST(coalesce(c.match_confidence, 0.0) AS FLOAT) AS conf,
  h.home_country, h.home_lat, h.home_lng
  FROM (SELECT *, CASE WHEN location <> '' THEN 'q:' || trim(regexp_replace(lower(location), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))
                       ELSE '' END AS loc_key FROM ({CAL_EVENTS})) e
  LEFT JOIN ({CATALOG_FULL}) c ON c.place_id = e.loc_key CROSS JOIN ({HOME}) h"""
_D = _hav_m("lat", "lng", "home_lat", "home_lng")
MODEL_ORACLE["model_silver_calendar_geo"] = f"""
    SELECT event_id, calendar_id, calendar_name, category, started_at, ended_at, event_date, title, location,
           attendee_count, duration_minutes, is_all_day, geo_locality, geo_country, '' AS geo_country_code, lat, lng,
           conf AS match_confidence, home_country,
           CASE WHEN lat <> 0 OR lng <> 0 THEN round({_D} / 1000.0, 1) ELSE 0.0 END AS km_from_home,
           CAST(CAST(ended_at AS DATE) > CAST(started_at AS DATE) AS INTEGER) AS is_multi_day,
           CAST(regexp_matches(lower(title), '{TRAVEL}') AS INTEGER) AS is_travel_title,
           CAST(geo_country <> '' AND geo_country <> home_country AS INTEGER) AS is_foreign,
           CAST(lat <> 0 AND lng <> 0 AND {_D} > 100000 AS INTEGER) AS is_far,
           CAST(regexp_matches(lower(title), '{TRAVEL}') OR (geo_country <> '' AND geo_country <> home_country)
                OR (lat <> 0 AND lng <> 0 AND {_D} > 100000) AS INTEGER) AS corroborates_travel
    FROM ({CAL_GEO_J})"""

MODEL_ORACLE["model_gold_home_overview_stats"] = f"""
    WITH p AS (SELECT * FROM ({MERGED}) WHERE played_at >= TIMESTAMP '2024-01-01 00:00:00'),
    w AS (SELECT * FROM ({WATCHES}) WHERE watched_date >= DATE '2024-01-01'),
    a AS (SELECT * FROM ({PUBLIC_FULL}) WHERE event_date >= DATE '2024-01-01'),
    cities AS (SELECT count(*) AS n FROM (SELECT locality FROM a WHERE locality <> '' GROUP BY 1
                                          HAVING count(*) FILTER (WHERE activity_type = 'directions') > 0))
    SELECT (SELECT count(DISTINCT track_id) FROM p) AS songsStreamed,
           (SELECT count(DISTINCT primary_artist_id) FILTER (WHERE primary_artist_id <> '') FROM p) AS artistsListened,
           (SELECT count(*) FROM w) AS videosWatched,
           (SELECT count(DISTINCT channel_id) FILTER (WHERE channel_id <> '') FROM w) AS youtubeChannels,
           (SELECT count(*) FROM ({SEARCHES}) WHERE CAST(searched_at AS DATE) >= DATE '2024-01-01')
             + (SELECT count(*) FILTER (WHERE activity_type = 'search') FROM a) AS searchQueries,
           (SELECT n FROM cities) AS citiesVisited,
           round((SELECT coalesce(sum(duration_ms), 0) FROM p) / 3600000.0, 1) AS spotifyHours,
           round((SELECT coalesce(sum(duration_seconds), 0) FROM w) / 3600.0, 1) AS youtubeHours"""

MODEL_ORACLE["model_gold_youtube_kpis_with_watch_time_dashboard"] = f"""
    WITH w AS (SELECT * FROM ({WATCHES}) WHERE watched_date >= DATE '2024-01-01'),
    k AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_from_ads) AS ads, sum(duration_seconds) AS secs,
                 avg(duration_seconds) FILTER (WHERE duration_seconds > 0) AS avg_pos,
                 count(DISTINCT channel_id) FILTER (WHERE channel_id <> '') AS unique_channels,
                 count(DISTINCT video_id) AS unique_videos,
                 count(DISTINCT category_id) FILTER (WHERE category_id <> '') AS unique_categories,
                 count(DISTINCT watched_date) AS days, count(*) FILTER (WHERE duration_seconds > 0) AS enriched,
                 min(watched_date) AS first_d, max(watched_date) AS last_d FROM w),
    s AS (SELECT count(*) AS total_searches FROM ({SEARCHES}) WHERE CAST(searched_at AS DATE) >= DATE '2024-01-01')
    SELECT n AS videos_watched, total_searches, ads AS total_ads_watched,
           round(ads / nullif(n, 0) * 100.0, 1) AS ads_percentage,
           CAST(coalesce(secs, 0) AS BIGINT) AS total_watch_time_seconds,
           {_readable('CAST(coalesce(secs, 0) AS BIGINT)')} AS total_watch_time_formatted,
           coalesce(round(avg_pos, 0), 0.0) AS avg_watch_time_seconds,
           {_readable('CAST(coalesce(round(avg_pos, 0), 0) AS BIGINT)')} AS avg_watch_time_formatted,
           unique_channels, unique_videos, unique_categories,
           round(n / nullif(days, 0), 1) AS avg_activities_per_day, round(n / nullif(days, 0), 1) AS avg_watched_per_day,
           round(enriched / nullif(n, 0) * 100.0, 1) AS enrichment_percentage,
           coalesce(CAST(first_d AS VARCHAR), '1970-01-01') AS first_activity_date,
           coalesce(CAST(last_d AS VARCHAR), '1970-01-01') AS last_activity_date
    FROM k, s"""

# ---------------------------------------------------------------- arrays as text, ratios from integers
PLAY_TEXT = "played_at, track_id, track_name, duration_ms, primary_artist_id, primary_artist_name, genres, album_name, " \
    "album_art_url, context_type, context_uri"


def _play_row(src: str) -> str:
    """The full play row over an enriched source: genres of the artist, album of the track."""
    return f"""SELECT e.played_at, e.track_id, e.track_name, e.duration_ms, e.primary_artist_id, e.primary_artist_name,
      coalesce(lower(c.c_mktsegment), '') AS genres, coalesce(p.p_brand, '') AS album_name, e.album_art_url,
      e.context_type, '' AS context_uri
    FROM ({src}) e LEFT JOIN customer c ON 'a' || CAST(c.c_custkey AS VARCHAR) = e.primary_artist_id
    LEFT JOIN part p ON p.p_size > 5 AND 't' || CAST(p.p_partkey AS VARCHAR) = e.track_id"""


def _ratio(part: str, total: str, digits: int, scale: int = 1) -> str:
    """part / total x scale, rounded half up with integers."""
    ten = 10 ** digits
    return f"(CAST((2 * {part} * {ten * scale} + {total}) // (2 * {total}) AS DOUBLE) / {ten}.0)"


STREAM_ENRICHED = _enrich("SELECT played_at, track_id, track_name, CAST(duration_ms AS BIGINT) AS duration_ms, artists_ids, "
                          f"artists_names, album_images, context_type FROM ({STREAM_PLAYS}) "
                          "WHERE date_diff('second', captured_at, played_at) >= 30")
MODEL_ORACLE.update({
    "model_silver_spotify_plays": f"SELECT {PLAY_TEXT} FROM ({_play_row(_enrich(PLAYS_RAW))})",
    "model_silver_spotify_plays_stream": f"SELECT {PLAY_TEXT} FROM ({_play_row(STREAM_ENRICHED)})",
    "model_silver_spotify_plays_merged": f"SELECT {PLAY_TEXT} FROM ({_play_row(MERGED)})",
    "model_gold_spotify_recent_tracks": f"""
        SELECT track, artist, strftime(heard, '%Y-%m-%dT%H:%M:%SZ') AS played_at, album_art
        FROM (SELECT track_name AS track, primary_artist_name AS artist, played_at AS heard, album_art_url AS album_art, track_id
              FROM ({MERGED})) ORDER BY heard DESC, track_id, track, artist LIMIT 50""",
    "model_gold_spotify_current_track": f"""
        SELECT CAST(ts AS TIMESTAMP) AS captured_at, 't' || CAST({K} AS VARCHAR) AS track_id,
               'Track ' || CAST({K} AS VARCHAR) AS track_name, '' AS track_uri, '' AS album_id, '' AS album_name,
               '' AS album_uri, '' AS album_images, 'a' || CAST(user_id AS VARCHAR) AS artist_id,
               'User ' || CAST(user_id AS VARCHAR) AS artist_name,
               'spotify:artist:a' || CAST(user_id AS VARCHAR) AS artist_uri, 'a' || CAST(user_id AS VARCHAR) AS artists_ids,
               'User ' || CAST(user_id AS VARCHAR) AS artists_names, true AS is_playing, 0 AS progress_ms,
               CAST(round(value * 1000) AS INTEGER) AS track_duration_ms, CAST(user_id AS VARCHAR) AS device_id,
               '' AS device_name, '' AS device_type, 0 AS device_volume_percent, '' AS context_type, '' AS context_uri
        FROM events WHERE event_type = 'click' ORDER BY captured_at DESC, track_id, device_id LIMIT 1""",
    "model_gold_calendar_week_grid": f"""
        WITH c AS (SELECT day_of_week - 1 AS day, hour_of_day AS hour, count(*) AS n FROM ({TIMED}) GROUP BY 1, 2),
             m AS (SELECT max(n) AS mx FROM c)
        SELECT CAST(s.range // 24 AS INTEGER) AS day, CAST(s.range % 24 AS INTEGER) AS hour,
               coalesce({_ratio('c.n', 'm.mx', 2)}, 0.0) AS intensity
        FROM range(168) s CROSS JOIN m LEFT JOIN c ON c.day = s.range // 24 AND c.hour = s.range % 24""",
    "model_gold_youtube_category_breakdown_dashboard": f"""
        WITH g AS (SELECT coalesce(m.name, 'Other') AS category_name, count(*) AS watch_count,
                          CAST(sum(duration_seconds) AS BIGINT) AS secs, count(DISTINCT channel_id) AS unique_channels
                   FROM (SELECT * FROM ({WATCHES}) WHERE category_id <> '' AND watched_date >= DATE '2024-01-01') w
                   LEFT JOIN {CATEGORY_MAP} ON m.id = w.category_id GROUP BY 1),
             t AS (SELECT CAST(sum(watch_count) AS BIGINT) AS n, CAST(sum(secs) AS BIGINT) AS s FROM g)
        SELECT category_name, watch_count, secs AS total_watch_time_seconds,
               {_readable('secs')} AS total_watch_time_formatted,
               {_ratio('watch_count', 't.n', 1, 100)} AS watch_percentage, {_ratio('secs', 't.s', 1, 100)} AS time_percentage,
               unique_channels FROM g, t""",
    "model_gold_youtube_daily_watch_time_breakdown_dashboard": f"""
        WITH w AS (SELECT watched_date AS date, count(*) FILTER (WHERE NOT is_from_ads) AS wc,
                          count(*) FILTER (WHERE is_from_ads) AS ac,
                          CAST(sum(duration_seconds) FILTER (WHERE NOT is_from_ads) AS BIGINT) AS ws,
                          CAST(sum(duration_seconds) FILTER (WHERE is_from_ads) AS BIGINT) AS ads
                   FROM ({WATCHES}) WHERE watched_date BETWEEN DATE '2024-01-31' - 29 AND DATE '2024-01-31' GROUP BY 1),
             s AS (SELECT CAST(searched_at AS DATE) AS date, count(*) AS n FROM ({SEARCHES})
                   WHERE CAST(searched_at AS DATE) BETWEEN DATE '2024-01-31' - 29 AND DATE '2024-01-31' GROUP BY 1),
             d AS (SELECT date FROM w UNION SELECT date FROM s)
        SELECT d.date, {_ratio('coalesce(ws, 0)', '3600', 2)} AS watched_hours, 0.0 AS searches_hours, 0.0 AS visits_hours,
               {_ratio('coalesce(ads, 0)', '3600', 2)} AS ads_hours, 0.0 AS other_hours,
               {_ratio('coalesce(ws + ads, 0)', '3600', 2)} AS total_hours, coalesce(wc, 0) AS watched_count,
               coalesce(s.n, 0) AS searches_count, CAST(0 AS BIGINT) AS visits_count, coalesce(ac, 0) AS ads_count,
               ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][isodow(d.date)] AS day_name,
               CAST(isodow(d.date) >= 6 AS INTEGER) AS is_weekend
        FROM d LEFT JOIN w ON w.date = d.date LEFT JOIN s ON s.date = d.date""",
})


def _mean(c: str) -> str:
    """Mean of coordinates from a sum of whole micro-degrees."""
    return f"CAST(sum(CAST(round({c} * 1000000) AS BIGINT)) AS DOUBLE) / count({c}) / 1000000"


GATED = f"SELECT * FROM ({PUBLIC_FULL}) WHERE locality <> '' AND match_confidence >= CAST(0.4 AS FLOAT)"
WEIGHT = ("(count(*) FILTER (WHERE activity_type = 'directions') * 3 + count(*) FILTER (WHERE activity_type = 'view_place') "
          "+ count(*) FILTER (WHERE activity_type = 'search'))")
HOME_BASE = f"""SELECT locality AS home_locality, country AS home_country, {_mean('lat')} AS home_lat, {_mean('lng')} AS home_lng
  FROM ({GATED}) GROUP BY locality, country ORDER BY {WEIGHT} DESC, locality, country LIMIT 1"""

MODEL_ORACLE.update({
    "model_silver_home_base": HOME_BASE,
    "model_silver_geo_daily": f"""
        WITH l AS (SELECT event_date, locality, country, {_mean('lat')} AS lat, {_mean('lng')} AS lng, count(*) AS n,
                          {WEIGHT} AS weight, count(*) FILTER (WHERE activity_type = 'directions') AS directions
                   FROM ({GATED}) GROUP BY 1, 2, 3),
        p AS (SELECT *, sum(n) OVER (PARTITION BY event_date) AS activity_count,
                     sum(directions) OVER (PARTITION BY event_date) AS directions_count FROM l
              QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY weight DESC, n DESC, locality DESC, country DESC) = 1),
        m AS (SELECT *, {_hav_m('lat', 'lng', 'home_lat', 'home_lng')} AS m FROM p, ({HOME_BASE}))
        SELECT event_date, locality, country, lat, lng, CAST(activity_count AS BIGINT) AS activity_count,
               CAST(directions_count AS BIGINT) AS directions_count, home_locality, home_country, home_lat, home_lng,
               round(m / 1000.0, 1) AS km_from_home,
               CAST(country <> home_country OR (locality <> home_locality AND m > 50000) AS INTEGER) AS away
        FROM m""",
})


ENRICHED_ALL = f"""SELECT k.event_ts, k.activity_type, k.query,
  CASE WHEN c.place_id IS NOT NULL THEN c.c_name ELSE k.place_name END AS place_name, k.place_id,
  coalesce(c.primary_type, '') AS primary_type, CASE WHEN c.place_id IS NOT NULL THEN 'poi' ELSE '' END AS place_types,
  coalesce(c.lat, k.lat) AS lat, coalesce(c.lng, k.lng) AS lng, '' AS neighborhood, '' AS sublocality,
  coalesce(c.locality, '') AS locality, coalesce(c.country, '') AS country, '' AS country_code,
  CAST(coalesce(c.match_confidence, 0.0) AS FLOAT) AS match_confidence, CASE WHEN c.place_id IS NOT NULL THEN 'poi' ELSE '' END AS match_type,
  k.origin, k.destination, CAST(k.event_ts AS DATE) AS event_date, CAST(hour(k.event_ts) AS INTEGER) AS hour_of_day
  FROM ({KEYED}) k LEFT JOIN ({CATALOG_FULL}) c ON c.place_id = k.geo_key"""
GEO_DAILY = MODEL_ORACLE["model_silver_geo_daily"]
#: away days in runs (a gap of over four days splits), one trip per run with a directions day
TRIPS = f"""WITH g AS (SELECT * FROM ({GEO_DAILY}) WHERE away = 1),
  r AS (SELECT *, sum(CASE WHEN prev IS NULL OR date_diff('day', prev, event_date) > 4 THEN 1 ELSE 0 END)
                  OVER (ORDER BY event_date ROWS UNBOUNDED PRECEDING) AS run_id
        FROM (SELECT *, lag(event_date) OVER (ORDER BY event_date) AS prev FROM g)),
  a AS (SELECT run_id, min(event_date) AS started_at, max(event_date) AS ended_at, sum(directions_count) AS dirs,
               count(DISTINCT nullif(locality, '')) AS localities, count(DISTINCT nullif(country, '')) AS countries,
               CAST(floor(max(km_from_home)) AS BIGINT) AS max_km FROM r GROUP BY 1),
  md AS (SELECT run_id, locality AS destination FROM r GROUP BY 1, 2
         QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY count(*) DESC, min(event_date), locality) = 1),
  dc AS (SELECT r.run_id, arg_min(country, event_date) AS country FROM r JOIN md ON md.run_id = r.run_id AND destination = locality GROUP BY 1),
  pts AS (SELECT *, lag(lat) OVER w AS plat, lag(lng) OVER w AS plng, lead(lat) OVER w AS nlat
          FROM r WHERE lat <> 0 AND lng <> 0 WINDOW w AS (PARTITION BY run_id ORDER BY event_date)),
  km AS (SELECT run_id, sum(CASE WHEN plat IS NULL THEN {_hav_m('home_lat', 'home_lng', 'lat', 'lng')}
                                 ELSE {_hav_m('plat', 'plng', 'lat', 'lng')} END
                            + CASE WHEN nlat IS NULL THEN {_hav_m('lat', 'lng', 'home_lat', 'home_lng')} ELSE 0 END) / 1000 AS km
         FROM pts GROUP BY 1)
  SELECT started_at, ended_at, date_diff('day', started_at, ended_at) + 1 AS days, destination, coalesce(country, '') AS country,
         CAST(floor(coalesce(km, 0)) AS BIGINT) AS km, localities, countries, max_km
  FROM a JOIN md USING (run_id) LEFT JOIN dc USING (run_id) LEFT JOIN km USING (run_id) WHERE dirs > 0 AND destination <> ''"""

MODEL_ORACLE.update({
    "model_silver_maps_activity_enriched": f"""
        SELECT *, CAST(EXISTS (SELECT 1 FROM ({PRIVATE}) p WHERE e.lat <> 0 AND e.lng <> 0
          AND {_hav_m('e.lat', 'e.lng', 'p.lat', 'p.lng')} <= p.radius_m) AS INTEGER) AS is_private FROM ({ENRICHED_ALL}) e""",
    "model_gold_maps_trips": f"""
        SELECT CAST(started_at AS VARCHAR) AS start, CAST(ended_at AS VARCHAR) AS "end", destination, destination AS title, '' AS trip_type,
               country, '' AS summary, CAST(0 AS FLOAT) AS confidence, CAST(days AS INTEGER) AS days, km,
               CAST(localities AS INTEGER) AS localities, CAST(countries AS INTEGER) AS countries, max_km,
               CAST(NULL AS DOUBLE) AS temp_mean, CAST(NULL AS DOUBLE) AS precip_mm, '' AS weather,
               CAST(started_at AS VARCHAR) || '_' || CAST(ended_at AS VARCHAR) AS trip_key FROM ({TRIPS})""",
    "model_gold_maps_kpis_dashboard": f"""
        WITH a AS (SELECT * FROM ({PUBLIC_FULL}) WHERE event_date >= DATE '2024-01-01'),
        k AS (SELECT count(*) AS n, count(*) FILTER (WHERE activity_type = 'directions') AS d,
                     count(*) FILTER (WHERE activity_type = 'search') AS s, count(*) FILTER (WHERE activity_type = 'view_place') AS v,
                     count(DISTINCT event_date) AS days, count(DISTINCT nullif(place_name, '')) AS places,
                     count(DISTINCT nullif(locality, '')) FILTER (WHERE activity_type = 'directions') AS cities,
                     count(DISTINCT nullif(country, '')) FILTER (WHERE activity_type = 'directions') AS countries,
                     min(event_date) AS lo, max(event_date) AS hi FROM a),
        t AS (SELECT * FROM ({TRIPS})), recent AS (SELECT * FROM t WHERE started_at >= DATE '2024-01-01'),
        tk AS (SELECT CAST(coalesce(sum(days), 0) AS BIGINT) AS away, coalesce(max(days), 0) AS longest, CAST(coalesce(sum(km), 0) AS INTEGER) AS km
               FROM recent),
        np AS (SELECT count(*) AS new FROM (SELECT destination FROM t GROUP BY 1 HAVING min(year(started_at)) = 2024))
        SELECT n AS total_activities, d AS total_directions, s AS total_searches, v AS total_explorations, v AS total_likely_visits,
               days AS days_with_activity, places AS unique_destinations, cities AS cities_visited, countries AS countries_visited,
               CAST(coalesce(lo, DATE '1970-01-01') AS VARCHAR) AS first_activity, CAST(coalesce(hi, DATE '1970-01-01') AS VARCHAR) AS last_activity,
               CAST(coalesce(date_diff('day', lo, hi), 0) AS INTEGER) AS days_tracked, {_ratio('n', 'days', 1)} AS avg_activities_per_day,
               {_ratio('d', 'n', 1, 100)} AS directions_pct, {_ratio('s', 'n', 1, 100)} AS search_pct, {_ratio('v', 'n', 1, 100)} AS explore_pct,
               away AS days_away_from_home, longest AS longest_trip_days, km AS kilometers_traveled, new AS new_places_this_year,
               coalesce((SELECT home_locality FROM ({HOME_BASE})), '') AS home_locality,
               coalesce((SELECT home_country FROM ({HOME_BASE})), '') AS home_country
        FROM k, tk, np""",
    "model_gold_maps_locations_dashboard": f"""
        SELECT name, lat, lng, {_readable('(n * 60)')} AS duration, 'aggregated' AS dwell_time_category,
               CAST(0 AS DOUBLE) AS distance_to_next_km
        FROM (SELECT {_label()} AS name, {_mean('lat')} AS lat, {_mean('lng')} AS lng, count(*) AS n,
                     count(*) FILTER (WHERE activity_type = 'directions') AS d
              FROM ({PUBLIC_FULL}) WHERE event_date >= DATE '2024-01-01' AND lat <> 0 AND lng <> 0 AND match_confidence >= CAST(0.4 AS FLOAT)
                AND country IN (SELECT home_country FROM ({HOME_BASE}) UNION SELECT country FROM ({TRIPS}) WHERE country <> '')
              GROUP BY 1 HAVING d > 0 ORDER BY d DESC, n DESC, name LIMIT 500)""",
    "model_gold_spotify_top_artists": f"""
        WITH p AS (SELECT *, date_diff('day', DATE '2024-01-01', CAST(played_at AS DATE)) // 7 AS w FROM ({MERGED_G})
                   WHERE primary_artist_id <> '' AND played_at >= TIMESTAMP '2024-01-01 00:00:00'),
        a AS (SELECT primary_artist_id AS id, arg_max(primary_artist_name, (played_at, primary_artist_name)) AS name,
                     arg_max(genres, (played_at, genres)) AS genres, count(*) AS plays, sum(duration_ms) AS ms,
                     {" || ',' || ".join(f"count(*) FILTER (WHERE w = {w})" for w in range(5))} AS trend FROM p GROUP BY 1),
        t AS (SELECT *, row_number() OVER (ORDER BY plays DESC, name, id) AS rank FROM a)
        SELECT rank, name, plays, {_ratio('ms', '3600000', 1)} AS hours, coalesce(genres[1], '') AS genre, trend FROM t WHERE rank <= 15""",
})
