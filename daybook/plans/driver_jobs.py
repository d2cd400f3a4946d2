"""Driver twins of the jobs that append to or rebuild tables: bookkeeping of
calendar notifications, labels, home anchors, versions of calendar entries,
work lists, monitors. Tables are written to a fresh folder per run, from the
whole driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.plans.driver import EVENTS_AS_OF, ORDERS_AS_OF, query
from daybook.plans.driver_sources import EV, K, _events, _text
from daybook.plans.standin_sql import CAL, KEYED, MODEL_ORACLE, PLAYS_RAW, WATCH_RAW
from daybook.session import materialize, scratch_path
from daybook.sources.driver import read
from daybook.sources.tables import append, read_raw, to_json_lines

MID = dt.datetime(2024, 1, 15)
DAY = dt.timedelta(days=1)


def _cfg(spark, name: str, as_of: dt.datetime = EVENTS_AS_OF, **kw) -> Cfg:
    return Cfg(as_of=as_of, kpi_start_date=dt.date(2024, 1, 1), root=scratch_path(spark, name), **kw)


def _ltz(c="ts"):
    return F.col(c).cast("timestamp")


# --------------------------------------------------------------------------
# SNK-10/16, STM-11/12, JON-19/20: notifications drained twice
# --------------------------------------------------------------------------
@query("calendar_sync_drain", f"""
WITH ch AS (SELECT 'ch' || (c_custkey + 20) AS channel_id, 'cal' || c_nationkey AS calendar_id, c_mktsegment AS name,
                   CASE WHEN c_acctbal > 0 THEN 'token' || c_custkey END AS token, c_custkey AS updated FROM customer),
n AS (SELECT coalesce(calendar_id, '') AS calendar_id, event_id, ts < TIMESTAMP '2024-01-15' AS early
      FROM events LEFT JOIN ch ON channel_id = 'ch' || user_id WHERE event_type <> 'signup'),
f AS (SELECT calendar_id, arg_max(name, updated) AS name, arg_max(token, updated) FILTER (WHERE token IS NOT NULL) AS token FROM ch GROUP BY 1),
g AS (SELECT calendar_id, max(event_id) FILTER (WHERE early) AS first_message, count(*) FILTER (WHERE early) AS first_pending,
             max(event_id) FILTER (WHERE NOT early) AS max_message, count(*) FILTER (WHERE NOT early) AS pending FROM n GROUP BY 1)
SELECT g.*, coalesce(name, '') AS calendar_name, token AS sync_token FROM g LEFT JOIN f USING (calendar_id) WHERE pending > 0
""")
def calendar_sync_drain(spark, d):
    """Deliveries of two weeks are drained and marked; the next drain finds only
    what came since. Handshakes drop out, unknown channels go to calendar ''."""
    from daybook.jobs.calendar_sync import drain_plan, mark_processed, notification_rows, sync_cursors
    first = _cfg(spark, "calendar-sync", MID)
    second = first.with_(as_of=EVENTS_AS_OF)
    channels = read(spark, d, "customer").select(
        F.concat(F.lit("cal"), F.col("c_nationkey").cast("string")).alias("calendar_id"),
        F.concat(F.lit("ch"), (F.col("c_custkey") + 20).cast("string")).alias("channel_id"), F.col("c_mktsegment").alias("calendar_name"),
        F.when(F.col("c_acctbal") > 0, _text("'token", "c_custkey")).otherwise("").alias("sync_token"),
        F.timestamp_seconds("c_custkey").alias("_updated_at"))
    append(channels, first, "calendar_channels")
    hooks = _events(spark, d).select(
        "ts", _text("'ch", "user_id").alias("channel_id"), F.col("event_id").alias("message_number"), _ltz().alias("received_at"),
        F.when(F.col("k") % 2 == 0, _text("'r", "k")).alias("resource_id"),
        F.when(F.col("event_type") == "signup", "sync").otherwise("exists").alias("state"))
    early = F.col("ts") < F.lit(MID).cast("timestamp_ntz")
    append(notification_rows(hooks.filter(early), channels), first, "calendar_sync_notifications", ingested_at=MID - DAY)
    before = materialize(drain_plan(spark, first))
    mark_processed(spark, first, before)
    append(notification_rows(hooks.filter(~early), channels), second, "calendar_sync_notifications", ingested_at=EVENTS_AS_OF - DAY)
    after = drain_plan(spark, second)
    return (after.join(before.select("calendar_id", F.col("max_message").alias("first_message"), F.col("pending").alias("first_pending")),
                       "calendar_id", "left").join(sync_cursors(spark, second), "calendar_id", "left")
            .withColumn("first_pending", F.coalesce("first_pending", F.lit(0)))
            .select("calendar_id", "first_message", "first_pending", "max_message", "pending", "calendar_name", "sync_token"))


# --------------------------------------------------------------------------
# SNK-11, STR-20: labels posted by people
# --------------------------------------------------------------------------
@query("trip_labels_posted", f"""
WITH p AS (SELECT event_type, CASE WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR)
                                   ELSE CAST(CAST(ts AS DATE) AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) + 1 AS VARCHAR) END AS trip_key,
                  event_type = 'purchase' AS edit, 'Title ' || k AS title, left('Destination ' || repeat(k || ' ', 100), 200) AS destination,
                  left(trim(repeat('note ' || k || ' ', 90)), 500) AS note FROM {EV})
SELECT trip_key, CASE event_type WHEN 'view' THEN 'confirm' WHEN 'click' THEN 'reject' WHEN 'purchase' THEN 'edit' WHEN 'signup' THEN 'maybe' END AS label,
  CASE WHEN event_type IN ('error', 'signup') THEN NULL WHEN edit THEN title ELSE '' END AS edited_title,
  CASE WHEN event_type IN ('error', 'signup') THEN NULL WHEN edit THEN destination ELSE '' END AS edited_destination,
  CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE note END AS note,
  CASE event_type WHEN 'error' THEN 'bad trip_key' WHEN 'signup' THEN 'bad label' END AS reason
FROM p
""")
def trip_labels_posted(spark, d):
    """Accepted labels as the table holds them, rejected ones with a reason."""
    from daybook.jobs.overrides import post_labels
    cfg = _cfg(spark, "trip-labels")
    e, day = F.col("event_type"), F.to_date("ts")
    posted = _events(spark, d).select(
        F.when(e == "error", F.col("event_id").cast("string")).otherwise(
            F.concat_ws("_", day.cast("string"), F.date_add(day, 1).cast("string"))).alias("trip_key"),
        F.when(e == "view", "confirm").when(e == "click", "reject").when(e == "purchase", "edit").when(e == "signup", "maybe").alias("label"),
        _text("'  Title ", "k", "' ").alias("edited_title"),
        F.concat(F.lit("Destination "), F.repeat(_text("k", "' "), 100)).alias("edited_destination"),
        F.lit("weekend").alias("edited_trip_type"), F.repeat(_text("'note ", "k", "' "), 90).alias("note"))
    bad = post_labels(spark, cfg, posted)
    cols = ["trip_key", "label", "edited_title", "edited_destination", "note"]
    none = F.lit(None).cast("string")
    return read_raw(spark, cfg, "maps_trip_labels").select(*cols, none.alias("reason")).unionByName(
        bad.select("trip_key", "label", *[none.alias(c) for c in cols[2:]], "reason"))


# --------------------------------------------------------------------------
# SNK-17, JON-16, WIN-08: home anchors, a second version of some of them
# --------------------------------------------------------------------------
@query("home_anchor_of_events", f"""
WITH a AS (SELECT ts, CAST(ts AS DATE) AS day, CASE WHEN value > 100 THEN 'moved ' ELSE 'home ' END || k AS label, CAST(k AS DOUBLE) AS lat
           FROM {EV} WHERE event_type = 'signup'),
last AS (SELECT day, arg_max(label, ts) AS label, arg_max(lat, ts) AS lat FROM a GROUP BY 1)
SELECT event_id, label AS home_label, lat AS home_lat FROM (SELECT event_id, CAST(ts AS DATE) AS day FROM events) e
ASOF LEFT JOIN last ON e.day >= last.day
""")
def home_anchor_of_events(spark, d):
    """Every sign-up sets an anchor, those of a large value are set again later."""
    from daybook.jobs.overrides import home_on_date, set_home
    cfg = _cfg(spark, "home-anchors", MID)
    ev = _events(spark, d)
    anchors = ev.filter("event_type = 'signup'").select(
        _ltz().alias("valid_from"), F.col("k").cast("double").alias("lat"), F.lit(1.0).alias("lng"), F.lit(1.0).alias("radius_km"),
        _text("'home ", "k").alias("label"), "value", "k")
    set_home(spark, cfg, anchors)
    set_home(spark, cfg.with_(as_of=EVENTS_AS_OF), anchors.filter("value > 100").withColumn("label", _text("'moved ", "k")))
    return home_on_date(spark, cfg, ev.select("event_id", F.to_date("ts").alias("event_date"))).select("event_id", "home_label", "home_lat")


# --------------------------------------------------------------------------
# SNK-01, SRC-01, STM-13: versions of calendar entries, cancellations, the future
# --------------------------------------------------------------------------
ENTRIES = f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS calendar_id, ts AS started_at,
  ts + to_minutes(CAST(k AS INTEGER)) AS ended_at, CASE WHEN event_type = 'purchase' THEN 'Moved ' ELSE 'Meeting ' END || k AS title
  FROM {EV} WHERE event_type <> 'click'"""


def _entries(spark, d) -> Cfg:
    """All events as calendar entries; later versions cancel the clicks and
    rename the purchases, and an older version arrives last."""
    cfg = _cfg(spark, "calendar-versions", MID)
    ev = _events(spark, d)
    rows = ev.select("event_type", "k", F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("calendar_id"),
                     _text("'Team ", "user_id").alias("calendar_name"), _ltz().alias("started_at"),
                     F.timestamp_add("MINUTE", F.col("k"), _ltz()).alias("ended_at"), _text("'Meeting ", "k").alias("title"),
                     F.lit("confirmed").alias("status"))
    append(rows, cfg, "calendar_events", ingested_at=MID - DAY)
    append(rows.filter("event_type = 'click'").withColumn("status", F.lit("cancelled")), cfg, "calendar_events")
    append(rows.filter("event_type = 'purchase'").withColumn("title", _text("'Moved ", "k")), cfg, "calendar_events")
    append(rows.withColumn("title", F.lit("old")), cfg, "calendar_events", ingested_at=MID - 2 * DAY)
    return cfg


@query("calendar_versions_silver", f"""
SELECT event_id, title, epoch_us(started_at) AS started_at, CAST(date_diff('minute', started_at, ended_at) AS BIGINT) AS duration_minutes,
  'Team ' || calendar_id AS category FROM ({ENTRIES})
""")
def calendar_versions_silver(spark, d):
    """The newest version of each entry; cancelled entries are gone."""
    from daybook.plans.calendar import silver_calendar_events
    return silver_calendar_events(spark, _entries(spark, d)).select(
        "event_id", "title", F.unix_micros("started_at").alias("started_at"), F.col("duration_minutes").cast("long"), "category")


@query("calendar_versions_upcoming", f"""
SELECT title, 'Team ' || calendar_id AS category, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS time,
  CAST(date_diff('minute', started_at, ended_at) AS BIGINT) AS durationMinutes
FROM ({ENTRIES}) WHERE started_at >= TIMESTAMP '2024-01-15' ORDER BY started_at, event_id LIMIT 8
""")
def calendar_versions_upcoming(spark, d):
    """The next eight entries at the middle of the month (a top-k report)."""
    from daybook.plans.calendar import gold_calendar_upcoming_events, silver_calendar_events
    cfg = _entries(spark, d)
    ev = silver_calendar_events(spark, cfg)
    return gold_calendar_upcoming_events(spark, cfg, ev).withColumn("durationMinutes", F.col("durationMinutes").cast("long"))


@query("free_time_by_calendar", f"""
WITH s AS (SELECT calendar_id, CAST(started_at AS DATE) AS event_date, started_at, max(ended_at) AS ended_at, count(*) AS n FROM ({ENTRIES})
           WHERE started_at <= TIMESTAMP '2024-01-15' GROUP BY 1, 2, 3),
w AS (SELECT *, lead(started_at) OVER o AS nxt, max(ended_at) OVER (o ROWS UNBOUNDED PRECEDING) AS busy FROM s
      WINDOW o AS (PARTITION BY calendar_id, event_date ORDER BY started_at)),
g AS (SELECT *, CASE WHEN nxt > busy THEN date_diff('minute', busy, nxt) END AS gap FROM w)
SELECT calendar_id, event_date, coalesce(max(gap), 0) AS longest_gap_minutes, count(gap) AS fragments, CAST(sum(n) AS BIGINT) AS events
FROM g GROUP BY 1, 2
""")
def free_time_by_calendar(spark, d):
    """Longest free span and number of gaps per calendar and day (WIN-09)."""
    from daybook.plans.calendar import gap_kpis
    return gap_kpis(spark, _entries(spark, d), by=["calendar_id"])


# --------------------------------------------------------------------------
# PIP-05/06/08, JON-17: work lists over the stand-in warehouse
# --------------------------------------------------------------------------
@query("enrichment_worklists", f"""
WITH known AS (SELECT 'q:place ' || s_suppkey AS key FROM supplier)
SELECT DISTINCT 'place' AS kind, geo_key AS key, best_text AS text FROM ({KEYED}) WHERE geo_key <> '' AND geo_key NOT IN (SELECT key FROM known)
UNION ALL SELECT DISTINCT 'calendar place', 'q:' || location, location FROM ({CAL}) WHERE 'q:' || location NOT IN (SELECT key FROM known)
UNION ALL SELECT DISTINCT 'track', track_id, '' FROM ({PLAYS_RAW}) WHERE track_id NOT IN (SELECT 't' || p_partkey FROM part WHERE p_size > 5)
UNION ALL SELECT DISTINCT 'artist', 'a' || user_id, '' FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-29'
  AND user_id NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT DISTINCT 'video', video_id, '' FROM ({WATCH_RAW}) WHERE video_id NOT IN (SELECT 'v' || p_partkey FROM part WHERE p_size > 3)
""")
def enrichment_worklists(spark, d):
    """Keys that plays, watches, activity and calendar entries name and no
    catalog has yet, with the text to look places up by."""
    from daybook.jobs import worklists as w
    from daybook.plans.standin import standin_warehouse
    cfg = standin_warehouse(spark, d)
    out = None
    for kind, make, key in (("place", w.place_worklist, "geo_key"), ("calendar place", w.calendar_place_worklist, "geo_key"),
                            ("track", w.track_worklist, "track_id"), ("artist", w.artist_worklist, "artist_id"),
                            ("video", w.video_worklist, "video_id")):
        df = make(spark, cfg)
        part = df.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), (F.col("text") if "text" in df.columns else F.lit("")).alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


@query("skip_processed_days", f"""
SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'
EXCEPT SELECT user_id, CAST(ts AS DATE) FROM events WHERE event_type = 'purchase'
""")
def skip_processed_days(spark, d):
    """Days of a user already processed (those with a purchase) are not taken up again."""
    from daybook.jobs.worklists import skip_done
    ev = _events(spark, d).select("user_id", F.to_date("ts").alias("day"), "event_type")
    pairs = lambda t: ev.filter(F.col("event_type") == t).select("user_id", "day")
    return skip_done(pairs("view").distinct(), pairs("purchase"), ["user_id", "day"])


# --------------------------------------------------------------------------
# PIP-14/15/23, SNK-12: monitors
# --------------------------------------------------------------------------
SEEN = f"""SELECT max(ts) FILTER (WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-29') AS plays, max(ts) FILTER (WHERE event_type = 'click') AS stream,
  max(ts) FILTER (WHERE event_type = 'purchase') AS watches, max(ts) FILTER (WHERE event_type IN ('signup', 'error')) AS maps,
  max(ts) FILTER (WHERE event_type = 'signup') AS starts FROM events"""


@query("monitor_alerts", f"""
WITH s AS ({SEEN}), u AS (SELECT unnest([('spotify_stream', stream, 300), ('spotify_history', plays, 86400), ('youtube', watches, 172800),
  ('maps', maps, 172800), ('calendar', starts, 172800)]) AS x FROM s),
a AS (SELECT x[1] AS source, x[3] AS budget, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(x[2])) AS us FROM u),
f AS (SELECT source, budget, CASE WHEN us >= 0 THEN us // 1000000 ELSE -((-us + 999999) // 1000000) END AS age FROM a)
SELECT epoch_us(TIMESTAMP '2024-01-31') AS raised_at, 'freshness' AS kind,
  source || ' stale: last event ' || age || ' s ago (budget ' || budget || ' s)' AS message FROM f WHERE age > budget
""")
def monitor_alerts(spark, d):
    """Sources of the stand-in warehouse whose last row is older than its budget."""
    from daybook.jobs.health import monitor
    from daybook.plans.standin import standin_warehouse
    return monitor(spark, standin_warehouse(spark, d)).select(F.unix_micros("raised_at").alias("raised_at"), "kind", "message")


@query("age_alerts", """
SELECT 'record dated ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' is ' || date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02')
  || ' days old' AS message, count(*) AS n
FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') >= 1000 GROUP BY 1
""")
def age_alerts(spark, d):
    """Orders at least 1,000 days old at as_of, alerts counted by message."""
    from daybook.jobs.health import age_report
    return age_report(read(spark, d, "orders"), "o_orderdate", ORDERS_AS_OF, 1000).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# SNK-03/04/13/15: guarded rebuilds in a dev layer, rows as JSON lines
# --------------------------------------------------------------------------
@query("guarded_rebuild", """
SELECT o_custkey AS destination, CAST(min(o_orderdate) AS DATE) AS started_at, CAST(max(o_orderdate) AS DATE) AS ended_at, count(*) AS days,
  'dev_silver' AS layer FROM orders GROUP BY 1
""")
def guarded_rebuild(spark, d):
    """A table of the dev layer is rebuilt from all orders; a later rebuild that
    comes out empty is refused and leaves the rows as they are."""
    from daybook.sources.tables import overwrite_guarded
    cfg = _cfg(spark, "guarded-rebuild", env="dev")
    day = F.to_date("o_orderdate")
    rows = read(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("destination")).agg(
        F.min(day).alias("started_at"), F.max(day).alias("ended_at"), F.count(F.lit(1)).cast("int").alias("days"))
    for c, t in (("destination_country", "string"), ("km", "long"), ("localities", "int"), ("countries", "int"), ("max_km", "long")):
        rows = rows.withColumn(c, F.lit(None).cast(t))
    overwrite_guarded(rows.filter("days > 1"), cfg, "maps_trips")
    overwrite_guarded(rows, cfg, "maps_trips")
    try:
        overwrite_guarded(rows.filter("days < 0"), cfg, "maps_trips", allow_empty=False)
        raise AssertionError("an empty rebuild must be refused")
    except ValueError:
        pass
    return read_raw(spark, cfg, "maps_trips").select(F.col("destination").cast("long"), "started_at", "ended_at", F.col("days").cast("long"),
                                                     F.lit(cfg.layer("silver")).alias("layer"))


@query("json_lines_export", f"""
SELECT event_id, user_id, event_type, {K} AS k, epoch_us(ts) AS at FROM events
""")
def json_lines_export(spark, d):
    """Rows written as JSON lines and read back."""
    path = scratch_path(spark, "json-lines")
    rows = _events(spark, d).select("event_id", "user_id", "event_type", "k", F.unix_micros(_ltz()).alias("at"))
    to_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


# --------------------------------------------------------------------------
# STR-16/20, FLT-11, DAT-09/14: text and date rules over whole texts
# --------------------------------------------------------------------------
@query("text_rules", """
SELECT doc_id, CASE WHEN length(text) > 80 THEN left(text, 80) || '...' ELSE text END AS short,
  left(regexp_replace(coalesce(text, ''), '^[ \\t\\n\\v\\f\\r]+|[ \\t\\n\\v\\f\\r]+$', '', 'g'), 40) AS clipped,
  CASE WHEN replace(replace(lower(trim(coalesce(source, ''))), '-', '_'), ' ', '_') IN ('web', 'hot_source', 'forum')
       THEN replace(replace(lower(trim(source)), '-', '_'), ' ', '_') ELSE 'other' END AS source
FROM documents
""")
def text_rules(spark, d):
    """Texts cut with an ellipsis or trimmed and clipped, sources as members of a fixed set."""
    from daybook.functions.text import clip, enum_normalise, truncate_ellipsis
    return read(spark, d, "documents").select("doc_id", truncate_ellipsis("text", 80).alias("short"), clip("text", 40).alias("clipped"),
                                              enum_normalise("source", ["web", "hot_source", "forum"]).alias("source"))


@query("date_labels", f"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0') AS wire,
  CASE date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') WHEN 0 THEN 'Today' WHEN 1 THEN 'Yesterday'
       ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS label
FROM events
""")
def date_labels(spark, d):
    """Wire form in milliseconds and day labels seen from as_of."""
    from daybook.functions.timefn import day_label, wire_ms
    return _events(spark, d).select("event_id", wire_ms("ts").alias("wire"),
                                    day_label(F.to_date("ts"), EVENTS_AS_OF.date()).alias("label"))


@query("bundle_travel_distribution", f"""
WITH d AS ({MODEL_ORACLE["model_gold_maps_daily_activity_dashboard"]}),
t AS (SELECT unnest([('directions', sum(directions)), ('searches', sum(searches)), ('explorations', sum(explorations)), ('other', sum(other))]) AS x FROM d)
SELECT x[1] AS name, CAST(x[2] AS BIGINT) AS value FROM t WHERE x[2] > 0
""")
def bundle_travel_distribution(spark, d):
    """Shares of the activity kinds of the travel page (AGG-26, FLT-14)."""
    from daybook.plans.bundles import travel_bundle
    from daybook.plans.standin import standin_warehouse
    return travel_bundle(spark, standin_warehouse(spark, d))["distribution"]


@query("bundle_music_summary", f"""
WITH k AS ({MODEL_ORACLE["model_gold_spotify_kpis_summary"]})
SELECT 0 AS pos, 'Artists' AS label, CAST(artists AS VARCHAR) AS value FROM k UNION ALL SELECT 1, 'Songs', CAST(songs AS VARCHAR) FROM k
""")
def bundle_music_summary(spark, d):
    """Labelled counts of the music page's short form, in their fixed order."""
    from daybook.plans.bundles import spotify_summary_bundle
    from daybook.plans.standin import standin_warehouse
    return spotify_summary_bundle(spark, standin_warehouse(spark, d))["stats"]
