"""Operators of the activity warehouse exercised on the driver's tables.

Each query reads whole driver tables (stand-ins for the activity tables:
``events`` = activity stream, ``orders`` = plays, ``customer``/``nation``/
``region`` = catalogs and places, ``lineitem`` = fact, ``part`` names =
genres, ``pages.url`` = activity URLs, ``documents`` = free text) and runs
the library operator named in its docstring. ``ORACLE`` holds an
equivalent DuckDB SQL text per query.

Conventions that keep Spark and the oracle bit-identical: money and
durations are summed in integer cents; ratios are single divisions of
integers; timestamps stay ``timestamp_ntz`` end to end.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.functions.categories import category_name, kind_label
from daybook.functions.geo import haversine_km
from daybook.functions.maps import classify_title
from daybook.functions.numeric import quantize_level, safe_div
from daybook.functions.text import first_nonblank, join_nonblank, stable_id, text_key, url_decode_plus, url_param
from daybook.functions.timefn import iso_dow, iso_utc, minutes_between, readable_delta
from daybook.operators.islands import island_runs, run_mode, run_path_km
from daybook.operators.intervals import window_sums
from daybook.operators.joins import overlap_join, valid_intervals, within_radius_flag
from daybook.operators.segments import dwell_segments, transitions
from daybook.operators.spine import date_spine, densify, int_spine
from daybook.operators.topn import rank_rows, top_n, top_n_per_group, top_n_plus_other
from daybook.operators.versioned import latest_by_version
from daybook.sources.driver import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# fixed parameters of the driver twins
EVENTS_AS_OF = dt.datetime(2024, 1, 31)
ORDERS_AS_OF = dt.datetime(2001, 8, 2)
EVENTS_FLOOR = dt.datetime(2024, 1, 1)
ORDERS_FLOOR = dt.datetime(2001, 1, 1)
DWELL_S = 30
DEDUP_WINDOW_S = 120
GAP_DAYS = 3
EVENT_TYPES = ["signup", "purchase", "view", "click", "error"]


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def ntz(x: dt.datetime):
    return F.lit(x).cast("timestamp_ntz")


def cents(c) -> F.Column:
    """Whole cents of a 2-decimal amount (exact in every engine)."""
    return F.round(c * 100).cast("long")


def _ev(spark, d):
    return read(spark, d, "events")


# --------------------------------------------------------------------------
# AGG-13 latest version per key
# --------------------------------------------------------------------------
@query("latest_by_version", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT user_id, event_type, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def latest_by_version_q(spark, d):
    """Latest event per (user, event type): ``latest_by_version`` keyed on
    (user_id, event_type), version ts, tie → larger event_id."""
    ev = _ev(spark, d).select("user_id", "event_type", "event_id", "ts", "value")
    return latest_by_version(ev, ["user_id", "event_type"], "ts", tiebreak=["event_id"])


# --------------------------------------------------------------------------
# JON-01/02, PRJ-05 enrichment with fallbacks
# --------------------------------------------------------------------------
@query("enrich_with_fallback", """
SELECT o.o_orderkey,
       coalesce(nullif(c.c_name, ''), 'customer ' || CAST(o.o_custkey AS VARCHAR)) AS customer_name,
       coalesce(n.n_name, 'Unknown') AS nation_name,
       CAST(coalesce(n.n_regionkey, -1) AS BIGINT) AS region_key,
       o.o_totalprice
FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = coalesce(c.c_nationkey, -1)
""")
def enrich_with_fallback(spark, d):
    """Plays ⟕ catalog ⟕ second catalog on a key computed from the first
    join; catalog value preferred, fact fallback when missing/empty.
    No broadcast is forced: the catalog grows with the data, so Spark (and
    AQE at run time) broadcasts a side only when its measured size is under
    the threshold and shuffles both sides otherwise."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cat = read(spark, d, "customer").filter(F.col("c_mktsegment") != "BUILDING") \
        .select("c_custkey", "c_name", "c_nationkey")
    nat = read(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = o.join(cat, o.o_custkey == cat.c_custkey, "left")
    j = j.withColumn("__nkey", F.coalesce(F.col("c_nationkey"), F.lit(-1)))
    j = j.join(nat, j["__nkey"] == nat.n_nationkey, "left")
    return j.select(
        "o_orderkey",
        first_nonblank("c_name", F.concat(F.lit("customer "), F.col("o_custkey").cast("string")))
        .alias("customer_name"),
        F.coalesce("n_name", F.lit("Unknown")).alias("nation_name"),
        F.coalesce("n_regionkey", F.lit(-1)).cast("long").alias("region_key"),
        "o_totalprice")


# --------------------------------------------------------------------------
# FLT-02/03, AGG-03, DAT-01 daily totals over a sliding window
# --------------------------------------------------------------------------
@query("daily_totals_window", """
SELECT CAST(ts AS DATE) AS day, count(*) AS events,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0 AS total_value,
       count(DISTINCT user_id) AS users
FROM events
WHERE ts <= TIMESTAMP '2024-01-31 00:00:00' AND ts >= TIMESTAMP '2024-01-01 00:00:00'
  AND CAST(ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-31'
GROUP BY 1
""")
def daily_totals_window(spark, d):
    """Date floor + inclusive 30-day window ending at as_of, then per-day
    count, sum and distinct users (partial aggregation before the shuffle)."""
    ev = _ev(spark, d)
    day = F.to_date("ts")
    as_of_d = EVENTS_AS_OF.date()
    w = ev.filter((F.col("ts") <= ntz(EVENTS_AS_OF)) & (F.col("ts") >= ntz(EVENTS_FLOOR))
                  & day.between(F.date_sub(F.lit(as_of_d), 29), F.lit(as_of_d)))
    return w.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        (F.sum(cents(F.col("value"))) / 100.0).alias("total_value"),
        F.countDistinct("user_id").alias("users"))


# --------------------------------------------------------------------------
# SRC-29, JON-08 dense hourly histogram
# --------------------------------------------------------------------------
@query("dense_hourly", """
SELECT h.hour, coalesce(c.events, 0) AS events, coalesce(c.total_value, 0.0) AS total_value
FROM (SELECT range AS hour FROM range(24)) h
LEFT JOIN (SELECT hour(ts) AS hour, count(*) AS events,
                  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0 AS total_value
           FROM events GROUP BY 1) c USING (hour)
""")
def dense_hourly(spark, d):
    """24-row spine left-joined to hourly counts, zero filled."""
    ev = _ev(spark, d)
    counts = ev.groupBy(F.hour("ts").cast("long").alias("hour")).agg(
        F.count(F.lit(1)).alias("events"), (F.sum(cents(F.col("value"))) / 100.0).alias("total_value"))
    return densify(int_spine(spark, "hour", 24), counts, ["hour"], {"events": 0, "total_value": 0.0}) \
        .select("hour", F.col("events").cast("long").alias("events"), "total_value")


# --------------------------------------------------------------------------
# SRC-30, DAT-03 weekday breakdown, Monday first
# --------------------------------------------------------------------------
@query("dense_weekday", """
SELECT CAST(d.dow AS BIGINT) AS dow, d.day, coalesce(c.events, 0) AS events
FROM (VALUES (1, 'Mon'), (2, 'Tue'), (3, 'Wed'), (4, 'Thu'), (5, 'Fri'), (6, 'Sat'), (7, 'Sun')) d(dow, day)
LEFT JOIN (SELECT isodow(ts) AS dow, count(*) AS events FROM events GROUP BY 1) c ON c.dow = d.dow
""")
def dense_weekday(spark, d):
    """Inline 7-row relation of ISO weekdays left-joined to counts."""
    days = spark.createDataFrame([(i + 1, n) for i, n in enumerate(["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"])],
                                 "dow long, day string")
    counts = _ev(spark, d).groupBy(iso_dow("ts").alias("dow")).agg(F.count(F.lit(1)).alias("events"))
    return densify(days, counts, ["dow"], {"events": 0}).select(
        "dow", "day", F.col("events").cast("long").alias("events"))


# --------------------------------------------------------------------------
# JON-07, AGG-18 7x24 grid normalised by the busiest slot
# --------------------------------------------------------------------------
@query("week_grid_intensity", """
WITH grid AS (SELECT CAST(range // 24 AS BIGINT) AS day, CAST(range % 24 AS BIGINT) AS hour FROM range(168)),
c AS (SELECT CAST(isodow(ts) - 1 AS BIGINT) AS day, hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2),
g AS (SELECT grid.day, grid.hour, coalesce(c.n, 0) AS events FROM grid LEFT JOIN c USING (day, hour))
SELECT day, hour, events, coalesce(events / nullif(max(events) OVER (), 0), 0.0) AS intensity FROM g
""")
def week_grid_intensity(spark, d):
    """168-slot grid (day 0..6 × hour) from one range, counts joined in,
    intensity = slot / busiest slot. The max is a window over the fixed
    168-row grid, so it never sees raw rows."""
    grid = spark.range(168, numPartitions=1).select(
        (F.col("id") / 24).cast("long").alias("day"), (F.col("id") % 24).cast("long").alias("hour"))
    counts = _ev(spark, d).groupBy((F.weekday("ts")).cast("long").alias("day"),
                                   F.hour("ts").cast("long").alias("hour")).agg(F.count(F.lit(1)).alias("events"))
    g = densify(grid, counts, ["day", "hour"], {"events": 0})
    mx = F.max("events").over(Window.partitionBy())
    return g.select("day", "hour", F.col("events").cast("long").alias("events"),
                    F.coalesce(safe_div(F.col("events"), mx), F.lit(0.0)).alias("intensity"))


# --------------------------------------------------------------------------
# JON-08 on a date spine + MTH-07 heat levels
# --------------------------------------------------------------------------
@query("heatmap_dense_days", """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
s AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
c AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
j AS (SELECT s.day, coalesce(c.orders, 0) AS orders FROM s LEFT JOIN c USING (day))
SELECT day, orders,
       CASE WHEN orders <= 0 THEN 0.0
            ELSE least(floor(orders / max(orders) OVER () * 5) + 1, 5) / 5 END AS level
FROM j
""")
def heatmap_dense_days(spark, d):
    """Every day between the first and last order, zero filled, with a
    five-step heat level. The spine is one row per calendar day."""
    o = read(spark, d, "orders")
    day = F.to_date("o_orderdate")
    bounds = o.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    counts = o.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    j = densify(date_spine(bounds, "lo", "hi", "day"), counts, ["day"], {"orders": 0})
    mx = F.max("orders").over(Window.partitionBy())
    return j.select("day", F.col("orders").cast("long").alias("orders"),
                    quantize_level(F.col("orders"), mx).cast("double").alias("level"))


# --------------------------------------------------------------------------
# AGG-02/03/04/06/14, MTH-05 one KPI row
# --------------------------------------------------------------------------
@query("kpi_row", """
SELECT count(*) AS total_events,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0 AS total_value,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / (count(*) * 100.0) AS avg_value,
       coalesce(CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'purchase' AND value > 0) AS BIGINT)
                / nullif(count(*) FILTER (WHERE event_type = 'purchase' AND value > 0) * 100.0, 0), 0.0) AS avg_purchase_value,
       count(DISTINCT user_id) AS users,
       count(DISTINCT CAST(ts AS DATE)) AS active_days,
       count(*) FILTER (WHERE event_type = 'error') / nullif(count(DISTINCT user_id), 0) AS errors_per_user,
       count(*) / nullif(count(DISTINCT CAST(ts AS DATE)), 0) AS avg_daily
FROM events
""")
def kpi_row(spark, d):
    """One global aggregate (AGG-14): all KPIs in a single pass with
    partial aggregation; averages guarded against empty sets."""
    ev = _ev(spark, d)
    c = cents(F.col("value"))
    is_p = (F.col("event_type") == "purchase") & (F.col("value") > 0)
    agg = ev.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.sum(c).alias("cents"),
        F.sum(F.when(is_p, c)).alias("p_cents"),
        F.count_if(is_p).alias("p_n"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct(F.to_date("ts")).alias("active_days"),
        F.count_if(F.col("event_type") == "error").alias("errors"))
    return agg.select(
        F.col("n").alias("total_events"), "purchases",
        (F.col("cents") / 100.0).alias("total_value"),
        safe_div(F.col("cents"), F.col("n") * 100.0).alias("avg_value"),
        F.coalesce(safe_div(F.col("p_cents"), F.col("p_n") * 100.0), F.lit(0.0)).alias("avg_purchase_value"),
        "users", "active_days",
        safe_div(F.col("errors"), F.col("users")).alias("errors_per_user"),
        safe_div(F.col("n"), F.col("active_days")).alias("avg_daily"))


# --------------------------------------------------------------------------
# AGG-22 pivot by conditional counts
# --------------------------------------------------------------------------
@query("pivot_by_type", """
SELECT CAST(ts AS DATE) AS day,
       count(*) FILTER (WHERE event_type = 'signup') AS signup,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       count(*) FILTER (WHERE event_type = 'view') AS "view",
       count(*) FILTER (WHERE event_type = 'click') AS click,
       count(*) FILTER (WHERE event_type = 'error') AS error
FROM events GROUP BY 1
""")
def pivot_by_type(spark, d):
    """Per-day counts with one column per event type (a pivot with a fixed
    value list, so no extra pass to discover the values)."""
    ev = _ev(spark, d)
    p = ev.groupBy(F.to_date("ts").alias("day")).pivot("event_type", EVENT_TYPES).count()
    return p.select("day", *[F.coalesce(F.col(t), F.lit(0)).cast("long").alias(t) for t in EVENT_TYPES])


# --------------------------------------------------------------------------
# PRJ-09, AGG-17 code → label with 'Other', percent of total
# --------------------------------------------------------------------------
@query("category_breakdown", """
WITH m(id, name) AS (VALUES ('1','Film & Animation'),('2','Autos & Vehicles'),('10','Music'),('15','Pets & Animals'),
  ('17','Sports'),('18','Short Movies'),('19','Travel & Events'),('20','Gaming'),('21','Videoblogging'),
  ('22','People & Blogs'),('23','Comedy'),('24','Entertainment'),('25','News & Politics'),('26','Howto & Style'),
  ('27','Education'),('28','Science & Technology'),('29','Nonprofits & Activism'),('30','Movies'),
  ('31','Anime/Animation'),('32','Action/Adventure'),('33','Classics'),('34','Comedy'),('35','Documentary'),
  ('36','Drama'),('37','Family'),('38','Foreign'),('39','Horror'),('40','Sci-Fi/Fantasy'),('41','Thriller'),
  ('42','Shorts'),('43','Shows'),('44','Trailers')),
j AS (SELECT coalesce(m.name, 'Other') AS category, l.l_suppkey,
             CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents
      FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
      LEFT JOIN m ON m.id = CAST(p.p_size AS VARCHAR)),
c AS (SELECT category, count(*) AS lines, CAST(sum(cents) AS BIGINT) AS cents,
             count(DISTINCT l_suppkey) AS suppliers FROM j GROUP BY 1)
SELECT category, lines, cents / 100.0 AS revenue,
       lines * 100.0 / sum(lines) OVER () AS pct_lines,
       cents * 100.0 / sum(cents) OVER () AS pct_revenue,
       suppliers
FROM c
""")
def category_breakdown(spark, d):
    """Fact ⋈ dimension, code → label via a literal map ('Other' for
    unknown codes; two codes share 'Comedy' and merge), then percent of
    total over the per-category rows (a handful, bounded by the map)."""
    li = read(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    part = read(spark, d, "part").select("p_partkey", "p_size")
    j = li.join(part, li.l_partkey == part.p_partkey).withColumn("category", category_name(F.col("p_size")))
    c = j.groupBy("category").agg(F.count(F.lit(1)).alias("lines"),
                                  F.sum(cents(F.col("l_extendedprice"))).alias("cents"),
                                  F.countDistinct("l_suppkey").alias("suppliers"))
    tot = Window.partitionBy()
    return c.select("category", "lines", (F.col("cents") / 100.0).alias("revenue"),
                    (F.col("lines") * 100.0 / F.sum("lines").over(tot)).alias("pct_lines"),
                    (F.col("cents") * 100.0 / F.sum("cents").over(tot)).alias("pct_revenue"),
                    "suppliers")


# --------------------------------------------------------------------------
# AGG-07/08, SRT-01 top entities with their most frequent type
# --------------------------------------------------------------------------
@query("top_entities_with_mode", """
WITH a AS (SELECT user_id, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
           FROM events GROUP BY 1),
m AS (SELECT user_id, event_type FROM (
        SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
        FROM events GROUP BY user_id, event_type) WHERE rn = 1),
t AS (SELECT * FROM a ORDER BY cents DESC, user_id LIMIT 10)
SELECT row_number() OVER (ORDER BY t.cents DESC, t.user_id) AS rank, t.user_id, t.events,
       t.cents / 100.0 AS total_value, m.event_type AS top_type
FROM t JOIN m USING (user_id)
""")
def top_entities_with_mode(spark, d):
    """Top 10 users by total value; each with its most frequent event type
    (exact mode, ties → smallest value). Mode is a per-group hash
    aggregate whose buffer is bounded by the distinct types."""
    ev = _ev(spark, d)
    a = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"),
                                  F.sum(cents(F.col("value"))).alias("cents"),
                                  F.mode("event_type", deterministic=True).alias("top_type"))
    t = top_n(a, 10, [F.col("cents").desc(), F.col("user_id")])
    t = rank_rows(t, [F.col("cents").desc(), F.col("user_id")])
    return t.select("rank", "user_id", "events", (F.col("cents") / 100.0).alias("total_value"), "top_type")


# --------------------------------------------------------------------------
# WIN-01, AGG-11, ARR-04, DAT-13 top entities with a dense weekly trend
# --------------------------------------------------------------------------
@query("top_with_weekly_trend", """
WITH w AS (SELECT o_custkey, o_orderdate, o_totalprice FROM orders
           WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '2001-08-02 00:00:00'),
a AS (SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
      FROM w GROUP BY 1),
top AS (SELECT * FROM a ORDER BY orders DESC, o_custkey LIMIT 15),
wk AS (SELECT o_custkey, CAST(floor(date_diff('day', DATE '2001-01-01', CAST(o_orderdate AS DATE)) / 7) AS BIGINT) AS week,
              count(*) AS c FROM w WHERE o_custkey IN (SELECT o_custkey FROM top) GROUP BY 1, 2),
grid AS (SELECT t.o_custkey, g.range AS week FROM top t, range(31) g),
tr AS (SELECT grid.o_custkey, string_agg(CAST(coalesce(wk.c, 0) AS VARCHAR), ',' ORDER BY grid.week) AS trend
       FROM grid LEFT JOIN wk USING (o_custkey, week) GROUP BY 1)
SELECT row_number() OVER (ORDER BY t.orders DESC, t.o_custkey) AS rank, t.o_custkey, c.c_name AS name,
       t.orders, t.cents / 100.0 AS revenue, tr.trend
FROM top t JOIN customer c ON c.c_custkey = t.o_custkey JOIN tr USING (o_custkey)
""")
def top_with_weekly_trend(spark, d):
    """Top 15 customers since the floor date with a gap-filled weekly count
    array (week 0 = week of the floor date, up to as_of). Weekly counts are
    aggregated per (customer, week) and packed into a map per customer —
    at most one entry per week, so bounded by the window length."""
    floor_d, as_of_d = ORDERS_FLOOR.date(), ORDERS_AS_OF.date()
    n_weeks = (as_of_d - floor_d).days // 7 + 1
    o = read(spark, d, "orders").filter((F.col("o_orderdate") >= ntz(ORDERS_FLOOR))
                                        & (F.col("o_orderdate") <= ntz(ORDERS_AS_OF)))
    a = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"),
                                   F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    top = top_n(a, 15, [F.col("orders").desc(), F.col("o_custkey")])
    week = F.floor(F.datediff(F.to_date("o_orderdate"), F.lit(floor_d)) / 7).cast("long")
    wk = (o.join(F.broadcast(top.select("o_custkey")), "o_custkey", "left_semi")
          .groupBy("o_custkey", week.alias("week")).agg(F.count(F.lit(1)).alias("c")))
    trend = wk.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("week", "c"))).alias("m"))
    trend = trend.select("o_custkey", F.array_join(F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(n_weeks - 1).cast("long")),
        lambda w: F.coalesce(F.try_element_at(F.col("m"), w), F.lit(0)).cast("string")), ",").alias("trend"))
    cust = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    ranked = rank_rows(top, [F.col("orders").desc(), F.col("o_custkey")])
    return (ranked.join(cust, "o_custkey").join(trend, "o_custkey")
            .select("rank", "o_custkey", "name", "orders", (F.col("cents") / 100.0).alias("revenue"), "trend"))


# --------------------------------------------------------------------------
# WIN-02 top-N per group
# --------------------------------------------------------------------------
@query("top_n_per_group", """
SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rank,
       event_id, ts, user_id
FROM events
QUALIFY rank <= 10
""")
def top_n_per_group_q(spark, d):
    """The 10 most recent events per type (row_number + filter, planned
    with a per-partition group limit before the shuffle)."""
    ev = _ev(spark, d).select("event_type", "event_id", "ts", "user_id")
    return top_n_per_group(ev, ["event_type"], [F.col("ts").desc(), F.col("event_id").desc()], 10) \
        .select("event_type", "rank", "event_id", "ts", "user_id")


# --------------------------------------------------------------------------
# SRT-07 top-N plus 'Other'
# --------------------------------------------------------------------------
@query("top_n_plus_other", """
WITH c AS (SELECT p_brand AS name, count(*) AS value FROM part GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY value DESC, name) AS rn FROM c)
SELECT CASE WHEN rn <= 5 THEN name ELSE 'Other' END AS name, CAST(sum(value) AS BIGINT) AS value FROM r GROUP BY 1
""")
def top_n_plus_other_q(spark, d):
    """Five largest brands, everything else folded into 'Other'."""
    c = read(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    return top_n_plus_other(c, "name", "value", 5).select("name", F.col("value").cast("long").alias("value"))


# --------------------------------------------------------------------------
# AGG-20, ARR-06 group by exploded element
# --------------------------------------------------------------------------
@query("exploded_tokens", """
SELECT token AS name, count(*) AS value
FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part)
WHERE token <> ''
GROUP BY 1 ORDER BY value DESC, name LIMIT 20
""")
def exploded_tokens(spark, d):
    """Words of part names as genres: explode, skip '', top 20 by count."""
    toks = read(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("name")).filter("name <> ''")
    c = toks.groupBy("name").agg(F.count(F.lit(1)).alias("value"))
    return top_n(c, 20, [F.col("value").desc(), F.col("name")])


# --------------------------------------------------------------------------
# SET-03, JON-18 union of days from two sources
# --------------------------------------------------------------------------
@query("distinct_union_days", """
WITH v AS (SELECT CAST(ts AS DATE) AS day, count(*) AS views, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS vc
           FROM events WHERE event_type = 'view' GROUP BY 1),
p AS (SELECT CAST(ts AS DATE) AS day, count(*) AS purchases, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS pc
      FROM events WHERE event_type = 'purchase' GROUP BY 1),
days AS (SELECT day FROM v UNION SELECT day FROM p)
SELECT days.day, coalesce(v.views, 0) AS views, coalesce(v.vc, 0) / 100.0 AS view_value,
       coalesce(p.purchases, 0) AS purchases, coalesce(p.pc, 0) / 100.0 AS purchase_value,
       strftime(days.day, '%a') AS day_name, CAST(isodow(days.day) >= 6 AS INTEGER) AS is_weekend
FROM days LEFT JOIN v USING (day) LEFT JOIN p USING (day)
""")
def distinct_union_days(spark, d):
    """Days present in either source (UNION DISTINCT) left-joined to both
    per-day aggregates, with day name and weekend flag."""
    ev = _ev(spark, d).select("ts", "event_type", "value")
    day = F.to_date("ts").alias("day")
    v = ev.filter("event_type = 'view'").groupBy(day).agg(F.count(F.lit(1)).alias("views"),
                                                           F.sum(cents(F.col("value"))).alias("vc"))
    p = ev.filter("event_type = 'purchase'").groupBy(day).agg(F.count(F.lit(1)).alias("purchases"),
                                                               F.sum(cents(F.col("value"))).alias("pc"))
    days = v.select("day").union(p.select("day")).distinct()
    j = days.join(v, "day", "left").join(p, "day", "left")
    return j.select("day", F.coalesce("views", F.lit(0)).cast("long").alias("views"),
                    (F.coalesce("vc", F.lit(0)) / 100.0).alias("view_value"),
                    F.coalesce("purchases", F.lit(0)).cast("long").alias("purchases"),
                    (F.coalesce("pc", F.lit(0)) / 100.0).alias("purchase_value"),
                    F.date_format("day", "EEE").alias("day_name"),
                    (F.weekday("day") >= 5).cast("int").alias("is_weekend"))


# --------------------------------------------------------------------------
# SET-01, PRJ-07, JSN-01, UID-01 unified event feed
# --------------------------------------------------------------------------
UNIFIED_SQL = """
SELECT ts AS event_ts, 'events' AS source, event_type AS kind, 'user ' || CAST(user_id AS VARCHAR) AS title,
       event_type AS subtitle, '' AS image_url, CAST(0 AS INTEGER) AS is_from_ads,
       to_json(map(['cents', 'user'], [CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), CAST(user_id AS VARCHAR)])) AS metadata,
       sha256(concat_ws(':', 'events', event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 'user ' || CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR))) AS event_id
FROM events
UNION ALL
SELECT o_orderdate, 'orders', 'order', 'order ' || CAST(o_orderkey AS VARCHAR), o_orderpriority, '',
       CAST(o_orderstatus = 'P' AS INTEGER),
       to_json(map(['cents', 'status'], [CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), o_orderstatus])),
       sha256(concat_ws(':', 'orders', 'order', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), 'order ' || CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)))
FROM orders
UNION ALL
SELECT l_shipdate, 'lineitem', 'shipment', 'part ' || CAST(l_partkey AS VARCHAR), l_returnflag || l_linestatus, '',
       CAST(0 AS INTEGER),
       to_json(map(['qty'], [CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)])),
       sha256(concat_ws(':', 'lineitem', 'shipment', strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f'), 'part ' || CAST(l_partkey AS VARCHAR), CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)))
FROM lineitem
"""


def _unified(spark, d) -> DataFrame:
    """Three sources projected to the 9 unified columns and bag-unioned
    (no shuffle: a union of narrow projections)."""
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ev = _ev(spark, d)
    title_e = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    e = ev.select(
        F.col("ts").alias("event_ts"), F.lit("events").alias("source"), F.col("event_type").alias("kind"),
        title_e.alias("title"), F.col("event_type").alias("subtitle"), F.lit("").alias("image_url"),
        F.lit(0).cast("int").alias("is_from_ads"),
        F.to_json(F.create_map(F.lit("cents"), cents(F.col("value")).cast("string"),
                               F.lit("user"), F.col("user_id").cast("string"))).alias("metadata"),
        stable_id(F.lit("events"), "event_type", F.date_format("ts", fmt), title_e, "event_id").alias("event_id"))
    o = read(spark, d, "orders")
    title_o = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))
    oo = o.select(
        F.col("o_orderdate").alias("event_ts"), F.lit("orders").alias("source"), F.lit("order").alias("kind"),
        title_o.alias("title"), F.col("o_orderpriority").alias("subtitle"), F.lit("").alias("image_url"),
        (F.col("o_orderstatus") == "P").cast("int").alias("is_from_ads"),
        F.to_json(F.create_map(F.lit("cents"), cents(F.col("o_totalprice")).cast("string"),
                               F.lit("status"), F.col("o_orderstatus"))).alias("metadata"),
        stable_id(F.lit("orders"), F.lit("order"), F.date_format("o_orderdate", fmt), title_o, "o_orderkey")
        .alias("event_id"))
    li = read(spark, d, "lineitem")
    title_l = F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    ll = li.select(
        F.col("l_shipdate").alias("event_ts"), F.lit("lineitem").alias("source"), F.lit("shipment").alias("kind"),
        title_l.alias("title"), F.concat("l_returnflag", "l_linestatus").alias("subtitle"),
        F.lit("").alias("image_url"), F.lit(0).cast("int").alias("is_from_ads"),
        F.to_json(F.create_map(F.lit("qty"), F.col("l_quantity").cast("long").cast("string"))).alias("metadata"),
        stable_id(F.lit("lineitem"), F.lit("shipment"), F.date_format("l_shipdate", fmt), title_l,
                  F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
        .alias("event_id"))
    return e.unionByName(oo).unionByName(ll)


@query("unified_events", UNIFIED_SQL)
def unified_events(spark, d):
    """Cross-source event feed (SET-01): constant typed columns, a JSON
    metadata map and a stable sha256 event id per row."""
    return _unified(spark, d)


# --------------------------------------------------------------------------
# JON-11, SRT-08 anti-join work list with a per-run cap
# --------------------------------------------------------------------------
@query("worklist_anti_join", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')
""")
def worklist_anti_join(spark, d):
    """Ids not yet covered (left_anti, NULL-safe unlike NOT IN), all of them."""
    c = read(spark, d, "customer").select("c_custkey", "c_name")
    recent = read(spark, d, "orders").filter(F.col("o_orderdate") >= ntz(ORDERS_FLOOR)).select("o_custkey")
    return c.join(recent, c.c_custkey == recent.o_custkey, "left_anti")


# --------------------------------------------------------------------------
# SRT-10 bulk batches
# --------------------------------------------------------------------------
@query("batches", """
SELECT c_custkey AS id, 1 AS in_batches, 1 AS within_size FROM customer
""")
def batches(spark, d):
    """Every customer id in exactly one batch of at most 50 ids."""
    from daybook.jobs.worklists import chunks
    b = chunks(read(spark, d, "customer").select("c_custkey"), "c_custkey", 50)
    each = b.select(F.explode("ids").alias("id"), F.when(F.size("ids") <= 50, 1).otherwise(0).alias("ok"))
    return each.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("in_batches"), F.min("ok").alias("within_size"))


# --------------------------------------------------------------------------
# JON-12/13 semi-join to a union of relations
# --------------------------------------------------------------------------
@query("geo_gate_semi_join", """
SELECT s_suppkey, s_name, s_nationkey FROM supplier
WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000
                      UNION SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'EUROPE')
""")
def geo_gate_semi_join(spark, d):
    """Keep rows whose country is in (home-like set ∪ trip countries):
    union → distinct → left_semi."""
    gate = (read(spark, d, "customer").filter(F.col("c_acctbal") > 9000).select(F.col("c_nationkey").alias("k"))
            .union(read(spark, d, "nation").join(read(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
                   .filter(F.col("r_name") == "EUROPE").select(F.col("n_nationkey").alias("k")))
            .distinct())
    s = read(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return s.join(gate, s.s_nationkey == gate.k, "left_semi")


# --------------------------------------------------------------------------
# AGG-23 first-occurrence filter
# --------------------------------------------------------------------------
@query("first_seen_this_year", """
SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_order,
       count(*) FILTER (WHERE year(o_orderdate) = 2001) AS orders_this_year
FROM orders WHERE o_orderdate <= TIMESTAMP '2001-08-02 00:00:00'
GROUP BY 1 HAVING min(year(o_orderdate)) = 2001
""")
def first_seen_this_year(spark, d):
    """Entities whose first year equals as_of's year (HAVING on min)."""
    o = read(spark, d, "orders").filter(F.col("o_orderdate") <= ntz(ORDERS_AS_OF))
    yr = ORDERS_AS_OF.year
    g = o.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("first_order"),
                                   F.count_if(F.year("o_orderdate") == yr).alias("orders_this_year"),
                                   F.min(F.year("o_orderdate")).alias("__fy"))
    return g.filter(F.col("__fy") == yr).drop("__fy")


# --------------------------------------------------------------------------
# JON-04, PRJ-06, FLT-08 human > model > geometric with a verdict gate
# --------------------------------------------------------------------------
@query("override_precedence", """
WITH trips AS (SELECT o_orderkey AS k, o_custkey, 'order ' || CAST(o_orderkey AS VARCHAR) AS geo_title FROM orders),
enriched AS (SELECT l_orderkey AS k, count(*) FILTER (WHERE l_returnflag = 'R') = 0 AS e_is_trip,
                    'shipped ' || strftime(max(l_shipdate), '%Y-%m-%d') AS e_title
             FROM lineitem GROUP BY 1),
labels_ AS (SELECT doc_id AS k,
                   CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'confirm' ELSE 'edit' END AS label,
                   CASE WHEN toxic = 0 AND quality = 0 THEN 'edited ' || CAST(doc_id AS VARCHAR) ELSE '' END AS edited_title
            FROM labels),
weather AS (SELECT c_custkey, c_acctbal AS temp FROM customer),
j AS (SELECT t.k, t.geo_title, e.e_is_trip, e.e_title, l.label, l.edited_title, w.temp
      FROM trips t LEFT JOIN enriched e ON e.k = t.k LEFT JOIN labels_ l ON l.k = t.k
      LEFT JOIN weather w ON w.c_custkey = t.o_custkey)
SELECT k AS trip_key,
       CASE WHEN coalesce(edited_title, '') <> '' THEN edited_title
            WHEN coalesce(e_title, '') <> '' THEN e_title ELSE geo_title END AS title,
       CASE WHEN coalesce(edited_title, '') <> '' THEN 'human'
            WHEN coalesce(e_title, '') <> '' THEN 'model' ELSE 'geo' END AS title_source,
       coalesce(label, '') AS label, temp
FROM j
WHERE CASE WHEN label = 'reject' THEN 0 WHEN label = 'confirm' THEN 1
           WHEN e_is_trip IS NOT NULL THEN CAST(e_is_trip AS INTEGER) ELSE 1 END = 1
""")
def override_precedence(spark, d):
    """Candidates ⟕ model verdicts ⟕ human labels ⟕ weather; title by
    precedence human > model > geometric; gate: reject → out, confirm →
    in, else the model verdict, else in."""
    trips = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey",
                                            F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("geo_title"))
    enriched = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        (F.count_if(F.col("l_returnflag") == "R") == 0).alias("e_is_trip"),
        F.concat(F.lit("shipped "), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd")).alias("e_title"))
    lab = read(spark, d, "labels").select(
        F.col("doc_id").alias("k"),
        F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 1, "confirm").otherwise("edit").alias("label"),
        F.when((F.col("toxic") == 0) & (F.col("quality") == 0),
               F.concat(F.lit("edited "), F.col("doc_id").cast("string"))).otherwise(F.lit("")).alias("edited_title"))
    weather = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("temp"))
    j = trips.join(enriched, "k", "left").join(lab, "k", "left").join(weather, "o_custkey", "left")
    gate = (F.when(F.col("label") == "reject", 0).when(F.col("label") == "confirm", 1)
            .when(F.col("e_is_trip").isNotNull(), F.col("e_is_trip").cast("int")).otherwise(1))
    human = F.coalesce(F.col("edited_title"), F.lit("")) != ""
    model = F.coalesce(F.col("e_title"), F.lit("")) != ""
    return j.filter(gate == 1).select(
        F.col("k").alias("trip_key"),
        first_nonblank("edited_title", "e_title", "geo_title").alias("title"),
        F.when(human, "human").when(model, "model").otherwise("geo").alias("title_source"),
        F.coalesce("label", F.lit("")).alias("label"), "temp")


# --------------------------------------------------------------------------
# DAT-04/11, PRJ-08 durations on minute boundaries, all-day test
# --------------------------------------------------------------------------
@query("all_day_and_duration", """
WITH s AS (
  SELECT 'events' AS source, event_id AS id, ts AS started_at,
         ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS ended_at FROM events
  UNION ALL
  SELECT 'orders', o_orderkey, o_orderdate, o_orderdate + INTERVAL 1 DAY FROM orders)
SELECT source, id, hour(started_at) AS start_hour, isodow(started_at) AS dow,
       date_diff('minute', started_at, ended_at) AS duration_minutes,
       CAST(hour(started_at) = 0 AND minute(started_at) = 0 AND second(started_at) = 0
            AND date_diff('minute', started_at, ended_at) >= 1440
            AND date_diff('minute', started_at, ended_at) % 1440 = 0 AS INTEGER) AS is_all_day,
       CAST(isodow(started_at) >= 6 AS INTEGER) AS is_weekend
FROM s
""")
def all_day_and_duration(spark, d):
    """Minute-boundary durations (SEM-5), ISO weekday, weekend flag and the
    all-day test (midnight start, whole multiple of 1440 minutes)."""
    ev = _ev(spark, d).select(F.lit("events").alias("source"), F.col("event_id").alias("id"),
                              F.col("ts").alias("started_at"),
                              F.timestamp_add("SECOND", F.round(F.col("value") * 60).cast("long"), F.col("ts"))
                              .alias("ended_at"))
    od = read(spark, d, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"),
                                         F.col("o_orderdate").alias("started_at"),
                                         F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate")).alias("ended_at"))
    s = ev.unionByName(od)
    mins = minutes_between("started_at", "ended_at")
    midnight = F.col("started_at") == F.date_trunc("day", F.col("started_at"))
    all_day = midnight & (mins >= 1440) & (mins % 1440 == 0)
    return s.select("source", "id", F.hour("started_at").cast("long").alias("start_hour"),
                    iso_dow("started_at").alias("dow"), mins.cast("long").alias("duration_minutes"),
                    all_day.cast("int").alias("is_all_day"),
                    (F.weekday("started_at") >= 5).cast("int").alias("is_weekend"))


# --------------------------------------------------------------------------
# JON-14 interval-overlap join / JON-15 point-in-window join
# --------------------------------------------------------------------------
def _windows(spark, d) -> DataFrame:
    return read(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("w_start"),
        F.date_add(F.to_date("o_orderdate"), 7).alias("w_end"))


@query("interval_overlap_join", """
WITH w AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS w_start, CAST(o_orderdate AS DATE) + 7 AS w_end
           FROM orders),
li AS (SELECT CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + 3 AS e, l_quantity FROM lineitem)
SELECT w.o_orderkey, count(*) AS items, CAST(sum(li.l_quantity) AS BIGINT) AS qty
FROM w JOIN li ON li.s <= w.w_end + 2 AND li.e >= w.w_start - 2
GROUP BY 1
""")
def interval_overlap_join(spark, d):
    """Windows [order date, +7 d] widened by ±2 days joined to line-item
    intervals [ship date, +3 d] that overlap them, counted per window.

    Exact rewrite that keeps the pair set small: windows sharing the same
    dates are joined once (distinct intervals), and line items are
    pre-aggregated per distinct (start, end) interval before the range join
    (``overlap_join``: dyadic cells + exact predicate); the partial counts
    and sums are combined per window interval and attached back to the
    orders by an equi-join."""
    w = _windows(spark, d).select("o_orderkey", F.date_sub("w_start", 2).alias("b_start"),
                                  F.date_add("w_end", 2).alias("b_end"))
    li = read(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("s"),
                                           F.date_add(F.to_date("l_shipdate"), 3).alias("e"), "l_quantity")
    ragg = li.groupBy("s", "e").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    dw = w.select("b_start", "b_end").distinct()
    per = (overlap_join(dw, ragg, "b_start", "b_end", "s", "e")
           .groupBy("b_start", "b_end").agg(F.sum("n").alias("items"), F.sum("q").cast("long").alias("qty")))
    return w.join(per, ["b_start", "b_end"]).select("o_orderkey", "items", "qty")


@query("point_in_window_join", """
WITH w AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS w_start, CAST(o_orderdate AS DATE) + 7 AS w_end
           FROM orders),
c AS (SELECT w.o_orderkey, l.l_suppkey, count(*) AS n
      FROM w JOIN lineitem l ON CAST(l.l_shipdate AS DATE) >= w.w_start AND CAST(l.l_shipdate AS DATE) <= w.w_end
      GROUP BY 1, 2)
SELECT o_orderkey, l_suppkey, n, row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC, l_suppkey) AS rank
FROM c QUALIFY rank <= 10
""")
def point_in_window_join(spark, d):
    """Line items whose ship date falls inside a window; per window the
    top 10 suppliers by count.

    Line items are counted per supplier and dyadic block of ship days, and
    each distinct date range takes the sums of its few blocks
    (``window_sums``), so no row stands for a window and a day; the per-range
    top 10 is taken there and attached back to every order with that range."""
    w = _windows(spark, d)
    li = read(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("s"), "l_suppkey", F.lit(1).alias("n"))
    per = window_sums(w, "w_start", "w_end", li, "s", ["l_suppkey"], ["n"])
    top = top_n_per_group(per, ["w_start", "w_end"], [F.col("n").desc(), F.col("l_suppkey")], 10)
    return w.join(top, ["w_start", "w_end"]).select("o_orderkey", "l_suppkey", "n", "rank")


# --------------------------------------------------------------------------
# JON-16, WIN-08 piecewise as-of lookup
# --------------------------------------------------------------------------
@query("asof_anchor", """
WITH a AS (SELECT o_custkey, year(o_orderdate) AS y, min(o_orderdate) AS valid_from,
                  arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS anchor_key
           FROM orders GROUP BY 1, 2),
v AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_until FROM a)
SELECT o.o_orderkey, o.o_custkey, v.anchor_key, CAST(v.valid_from AS DATE) AS anchor_from
FROM orders o JOIN v ON v.o_custkey = o.o_custkey AND o.o_orderdate >= v.valid_from
     AND (v.valid_until IS NULL OR o.o_orderdate < v.valid_until)
""")
def asof_anchor(spark, d):
    """Anchors (first order of each year per customer) get a validity
    interval from the next anchor (``lead``); each order is matched to the
    anchor valid at its date (equi on the entity + range). Anchors per
    entity are few (one per year), so the range part stays small."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    a = o.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.min("o_orderdate").alias("valid_from"),
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("anchor_key"))
    v = valid_intervals(a, ["o_custkey"], "valid_from").withColumnRenamed("o_custkey", "a_custkey")
    cond = [F.col("o_custkey") == F.col("a_custkey"), F.col("o_orderdate") >= F.col("valid_from"),
            F.col("valid_until").isNull() | (F.col("o_orderdate") < F.col("valid_until"))]
    return o.join(v, cond).select("o_orderkey", "o_custkey", "anchor_key",
                                  F.to_date("valid_from").alias("anchor_from"))


# --------------------------------------------------------------------------
# JON-09, MTH-03 spatial private-place flag
# --------------------------------------------------------------------------
POINTS_SQL = """(SELECT c_custkey, ((c_acctbal + 1000) % 180) - 90 AS lat, ((c_custkey * 7.3) % 360) - 180 AS lng FROM customer)"""
PLACES_SQL = """(SELECT ((s_acctbal + 1000) % 180) - 90 AS lat, ((s_suppkey * 7.3) % 360) - 180 AS lng,
                        200000.0 + s_nationkey * 12000.0 AS radius_m FROM supplier)"""


def _points(spark, d):
    c = read(spark, d, "customer")
    return c.select("c_custkey", (((F.col("c_acctbal") + 1000) % 180) - 90).alias("lat"),
                    (((F.col("c_custkey") * 7.3) % 360) - 180).alias("lng"))


def _places(spark, d):
    s = read(spark, d, "supplier")
    return s.select((((F.col("s_acctbal") + 1000) % 180) - 90).alias("lat"),
                    (((F.col("s_suppkey") * 7.3) % 360) - 180).alias("lng"),
                    (F.lit(200000.0) + F.col("s_nationkey") * 12000.0).alias("radius_m"))


@query("spatial_private_flag", f"""
SELECT p.c_custkey, CAST(EXISTS (
  SELECT 1 FROM {PLACES_SQL} s
  WHERE NOT (p.lat = 0 AND p.lng = 0)
    AND 2 * 6371.0 * asin(sqrt(pow(sin((radians(s.lat) - radians(p.lat)) / 2), 2)
        + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lng - p.lng) / 2), 2))) * 1000.0 <= s.radius_m
) AS INTEGER) AS is_private
FROM {POINTS_SQL} p
""")
def spatial_private_flag(spark, d):
    """Flag points within any private place's radius (grid-cell equi-join
    plus exact haversine; semi ∪ anti so each point appears once).
    Coordinates are derived from the tables' numeric columns."""
    return within_radius_flag(_points(spark, d), _places(spark, d), "lat", "lng").select("c_custkey", "is_private")


# --------------------------------------------------------------------------
# AGG-09/15/16, JON-06 home base and dominant daily location
# --------------------------------------------------------------------------
def _hav_sql(lat1, lng1, lat2, lng2) -> str:
    return (f"(2 * 6371.0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))))")


ACTIVITY_SQL = """(SELECT CAST(o.o_orderdate AS DATE) AS event_date, n.n_name AS locality, r.r_name AS country,
        ((c.c_acctbal + 1000) % 180) - 90 AS lat, ((c.c_custkey * 7.3) % 360) - 180 AS lng,
        CASE o.o_orderpriority WHEN '1-URGENT' THEN 'directions' WHEN '2-HIGH' THEN 'view_place'
             WHEN '3-MEDIUM' THEN 'search' ELSE 'other' END AS activity_type
   FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
   JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
)"""


@query("home_and_daily_location", f"""
WITH a AS {ACTIVITY_SQL},
loc AS (SELECT locality, country, avg(lat) AS lat, avg(lng) AS lng,
               count(*) FILTER (WHERE activity_type = 'directions') * 3 + count(*) FILTER (WHERE activity_type = 'view_place')
               + count(*) FILTER (WHERE activity_type = 'search') AS weight FROM a GROUP BY 1, 2),
home AS (SELECT locality AS home_locality, country AS home_country, lat AS home_lat, lng AS home_lng
         FROM loc ORDER BY weight DESC, locality, country LIMIT 1),
day_loc AS (SELECT event_date, locality, country, avg(lat) AS lat, avg(lng) AS lng, count(*) AS n,
                   count(*) FILTER (WHERE activity_type = 'directions') * 3 + count(*) FILTER (WHERE activity_type = 'view_place')
                   + count(*) FILTER (WHERE activity_type = 'search') AS weight,
                   count(*) FILTER (WHERE activity_type = 'directions') AS directions
            FROM a GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY weight DESC, n DESC, locality DESC, country DESC) AS rn,
                  sum(n) OVER (PARTITION BY event_date) AS activity_count,
                  sum(directions) OVER (PARTITION BY event_date) AS directions_count FROM day_loc)
SELECT p.event_date, p.locality, p.country, CAST(p.activity_count AS BIGINT) AS activity_count,
       CAST(p.directions_count AS BIGINT) AS directions_count, h.home_locality, h.home_country,
       round({_hav_sql('p.lat', 'p.lng', 'h.home_lat', 'h.home_lng')}, 1) AS km_from_home,
       CASE WHEN p.country <> h.home_country THEN 1
            WHEN p.locality <> h.home_locality AND {_hav_sql('p.lat', 'p.lng', 'h.home_lat', 'h.home_lng')} > 50 THEN 1
            ELSE 0 END AS away
FROM ranked p CROSS JOIN home h WHERE p.rn = 1
""")
def home_and_daily_location(spark, d):
    """Home = place with the largest weighted activity (3·directions +
    views + searches); per day the dominant place (two-level aggregation,
    tie-safe ``max(struct(weight, n, locality, country, lat, lng))``),
    distance to home and the away rule (other country, or other locality
    more than 50 km away). The one-row home is read once and attached as
    literals (``attach_scalar``)."""
    from daybook.operators.merge import attach_scalar
    c = read(spark, d, "customer")
    a = (read(spark, d, "orders").join(c, F.col("c_custkey") == F.col("o_custkey"))
         .join(read(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
         .join(read(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
         .select(F.to_date("o_orderdate").alias("event_date"), F.col("n_name").alias("locality"),
                 F.col("r_name").alias("country"),
                 (((F.col("c_acctbal") + 1000) % 180) - 90).alias("lat"),
                 (((F.col("c_custkey") * 7.3) % 360) - 180).alias("lng"),
                 F.when(F.col("o_orderpriority") == "1-URGENT", "directions")
                  .when(F.col("o_orderpriority") == "2-HIGH", "view_place")
                  .when(F.col("o_orderpriority") == "3-MEDIUM", "search").otherwise("other").alias("activity_type")))
    from daybook.plans.common import place_weight
    loc = a.groupBy("locality", "country").agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"),
                                               place_weight("activity_type").alias("weight"))
    home = top_n(loc, 1, [F.col("weight").desc(), F.col("locality"), F.col("country")]).select(
        F.col("locality").alias("home_locality"), F.col("country").alias("home_country"),
        F.col("lat").alias("home_lat"), F.col("lng").alias("home_lng"))
    day_loc = a.groupBy("event_date", "locality", "country").agg(
        F.avg("lat").alias("lat"), F.avg("lng").alias("lng"), F.count(F.lit(1)).alias("n"),
        place_weight("activity_type").alias("weight"),
        F.count_if(F.col("activity_type") == "directions").alias("directions"))
    best = F.max(F.struct("weight", "n", "locality", "country", "lat", "lng"))
    day = day_loc.groupBy("event_date").agg(best.alias("b"), F.sum("n").alias("activity_count"),
                                            F.sum("directions").alias("directions_count"))
    p = attach_scalar(day.select("event_date", "b.*", "activity_count", "directions_count"), home)
    km = haversine_km("lat", "lng", "home_lat", "home_lng")
    away = F.when(F.col("country") != F.col("home_country"), 1) \
        .when((F.col("locality") != F.col("home_locality")) & (km > 50), 1).otherwise(0)
    return p.select("event_date", "locality", "country", F.col("activity_count").cast("long").alias("activity_count"),
                    F.col("directions_count").cast("long").alias("directions_count"), "home_locality",
                    "home_country", F.round(km, 1).alias("km_from_home"), away.cast("int").alias("away"))


# --------------------------------------------------------------------------
# WIN-06/07, AGG-24, PIP-01 trip islands
# --------------------------------------------------------------------------
@query("trip_islands", f"""
WITH e AS (SELECT user_id || '-' || event_type AS user_id, CAST(ts AS DATE) AS day, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
           FROM events),
home AS (SELECT user_id || '-' || event_type AS user_id, avg(value) / 10 AS home_lat, avg(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS home_lng
         FROM events GROUP BY 1),
daily AS (SELECT user_id, day, 'B' || CAST(CAST(floor(max(value) / 100) AS BIGINT) AS VARCHAR) AS locality,
                 avg(value) / 10 AS lat, avg(k) AS lng, count(*) FILTER (WHERE value >= 100) AS directions
          FROM e GROUP BY 1, 2),
r AS (SELECT *, sum(CASE WHEN prev IS NULL OR date_diff('day', prev, day) > {GAP_DAYS + 1} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS run_id
      FROM (SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM daily)),
runs AS (SELECT user_id, run_id, min(day) AS started_at, max(day) AS ended_at,
                sum(directions) AS directions, count(DISTINCT locality) AS localities FROM r GROUP BY 1, 2),
md AS (SELECT user_id, run_id, locality AS destination FROM (
         SELECT user_id, run_id, locality, row_number() OVER (PARTITION BY user_id, run_id ORDER BY count(*) DESC, min(day), locality) AS rn
         FROM r GROUP BY 1, 2, 3) WHERE rn = 1),
pts AS (SELECT r.*, h.home_lat, h.home_lng,
               lag(lat) OVER w AS plat, lag(lng) OVER w AS plng,
               row_number() OVER w AS rn_a,
               row_number() OVER (PARTITION BY r.user_id, run_id ORDER BY day DESC) AS rn_d
        FROM r JOIN home h USING (user_id) WHERE lat <> 0 AND lng <> 0
        WINDOW w AS (PARTITION BY r.user_id, run_id ORDER BY day)),
km AS (SELECT user_id, run_id,
              sum(CASE WHEN rn_a = 1 THEN {_hav_sql('home_lat', 'home_lng', 'lat', 'lng')} ELSE 0 END)
              + sum(CASE WHEN plat IS NULL THEN 0 ELSE {_hav_sql('plat', 'plng', 'lat', 'lng')} END)
              + sum(CASE WHEN rn_d = 1 THEN {_hav_sql('lat', 'lng', 'home_lat', 'home_lng')} ELSE 0 END) AS km
       FROM pts GROUP BY 1, 2)
SELECT runs.user_id, runs.run_id, runs.started_at, runs.ended_at,
       CAST(date_diff('day', runs.started_at, runs.ended_at) + 1 AS BIGINT) AS days,
       md.destination, runs.localities, CAST(floor(coalesce(km.km, 0)) AS BIGINT) AS km
FROM runs JOIN md USING (user_id, run_id) LEFT JOIN km USING (user_id, run_id)
WHERE runs.directions > 0 AND md.destination <> ''
""")
def trip_islands(spark, d):
    """Trip segmentation on a daily series per user and event type: daily aggregate →
    gaps-and-islands (gap > GAP_DAYS + 1 splits) → per run: span, mode
    destination (first-seen tie), distinct places, round-trip path length
    via ``lag`` (points with a zero coordinate skipped); runs without a
    directions day are dropped."""
    ev = _ev(spark, d).withColumn("user_id", F.concat_ws("-", "user_id", "event_type"))
    k = F.get_json_object("props", "$.k").cast("long")
    home = ev.groupBy("user_id").agg((F.avg("value") / 10).alias("home_lat"), F.avg(k).alias("home_lng"))
    e = ev.select("user_id", F.to_date("ts").alias("day"), "value", k.alias("k"))
    daily = e.groupBy("user_id", "day").agg(
        F.concat(F.lit("B"), F.floor(F.max("value") / 100).cast("long").cast("string")).alias("locality"),
        (F.avg("value") / 10).alias("lat"), F.avg("k").alias("lng"),
        F.count_if(F.col("value") >= 100).alias("directions"))
    from daybook.session import materialize
    # the daily series (one row per user and active day) feeds three
    # per-run aggregations: materialise it once instead of rescanning events
    r = materialize(island_runs(daily, ["user_id"], "day", GAP_DAYS))
    keys = ["user_id", "run_id"]
    runs = r.groupBy(*keys).agg(F.min("day").alias("started_at"), F.max("day").alias("ended_at"),
                                F.sum("directions").alias("directions"),
                                F.countDistinct("locality").alias("localities"))
    md = run_mode(r, keys, "locality", "day", "destination")
    km = run_path_km(r.join(home, "user_id"), keys, "day", "lat", "lng", "home_lat", "home_lng")
    out = runs.join(md, keys).join(km, keys, "left").filter((F.col("directions") > 0) & (F.col("destination") != ""))
    return out.select("user_id", "run_id", "started_at", "ended_at",
                      (F.datediff("ended_at", "started_at") + 1).cast("long").alias("days"),
                      "destination", "localities", F.floor(F.coalesce("km", F.lit(0.0))).cast("long").alias("km"))


# --------------------------------------------------------------------------
# STM-01 batch twin, WIN-05 transition filter
# --------------------------------------------------------------------------
@query("transition_filter", """
SELECT user_id, event_id, ts, event_type FROM (
  SELECT user_id, event_id, ts, event_type,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE prev IS NULL OR prev <> event_type
""")
def transition_filter(spark, d):
    """Emit only state changes per entity (first event always emitted)."""
    ev = _ev(spark, d).select("user_id", "event_id", "ts", "event_type")
    return transitions(ev, ["user_id"], "ts", ["event_type"], tiebreak=["event_id"], chunk=F.to_date("ts"))


# --------------------------------------------------------------------------
# STM-05/06, WIN-03/04 dwell segments
# --------------------------------------------------------------------------
@query("dwell_segments", f"""
WITH b AS (SELECT user_id, ts, event_type AS k, CAST(round(value * 1000) AS BIGINT) AS duration_ms,
                  lag(event_type, 1, '__none__') OVER (PARTITION BY user_id ORDER BY ts, event_type) AS prev FROM events),
s AS (SELECT * FROM b WHERE k <> prev AND k <> ''),
n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, k) AS next_start FROM s),
bd AS (SELECT *, least(coalesce(next_start, TIMESTAMP '2024-01-31 00:00:00'),
                       CASE WHEN duration_ms > 0 THEN ts + to_seconds(CAST(floor(duration_ms / 1000) AS BIGINT) + 15)
                            ELSE TIMESTAMP '2024-01-31 00:00:00' END) AS played_at FROM n)
SELECT user_id, k AS event_type, ts AS started_at, played_at, date_diff('second', ts, played_at) AS dwell_s
FROM bd WHERE date_diff('second', ts, played_at) >= {DWELL_S}
""")
def dwell_segments_q(spark, d):
    """Speed layer on events: segment on type change, end = min(next
    change | as_of, start + duration + 15 s), keep dwell ≥ 30 s."""
    ev = _ev(spark, d).select("user_id", "ts", "event_type",
                              F.round(F.col("value") * 1000).cast("long").alias("duration_ms"))
    seg = dwell_segments(ev, ["user_id"], "ts", "event_type", "duration_ms", EVENTS_AS_OF, dwell_s=DWELL_S,
                         chunk=F.to_date("ts"))
    from daybook.functions.timefn import seconds_between
    return seg.select("user_id", "event_type", F.col("ts").alias("started_at"), "played_at",
                      seconds_between("ts", "played_at").alias("dwell_s"))


# --------------------------------------------------------------------------
# STM-07/08, JON-10 lambda merge
# --------------------------------------------------------------------------
@query("lambda_merge", f"""
WITH h AS (SELECT user_id, event_type, event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00'),
s AS (SELECT user_id, event_type, event_id, ts + INTERVAL 3 SECOND AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'),
t AS (SELECT max(ts) AS T FROM h)
SELECT user_id, event_type, event_id, ts, 'history' AS origin FROM h WHERE ts <= (SELECT T FROM t)
UNION ALL
SELECT s.user_id, s.event_type, s.event_id, s.ts, 'stream' FROM s
WHERE s.ts > (SELECT T FROM t) AND (SELECT T FROM t) > TIMESTAMP '2000-01-01 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM h WHERE h.ts >= (SELECT T FROM t) - INTERVAL {DEDUP_WINDOW_S} SECOND
                  AND h.user_id = s.user_id AND h.event_type = s.event_type
                  AND abs(date_diff('second', h.ts, s.ts)) <= {DEDUP_WINDOW_S})
""")
def lambda_merge_q(spark, d):
    """History up to its watermark T plus stream rows after T that have no
    same-key history row within ±120 s (the stand-in stream is the last
    week of events re-captured 3 s later, overlapping the history)."""
    from daybook.operators.merge import lambda_merge
    ev = _ev(spark, d).select("user_id", "event_type", "event_id", "ts")
    hist = ev.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 25))).withColumn("origin", F.lit("history"))
    stream = (ev.filter(F.col("ts") >= ntz(dt.datetime(2024, 1, 24)))
              .withColumn("ts", F.timestamp_add("SECOND", F.lit(3), F.col("ts")))
              .withColumn("origin", F.lit("stream")))
    return lambda_merge(hist, stream, ["user_id", "event_type"], "ts", DEDUP_WINDOW_S)


# --------------------------------------------------------------------------
# STM-03/04 landing with redelivery dedup, availableNow
# --------------------------------------------------------------------------
@query("stream_dedup_availableNow", """
SELECT event_id, ts, user_id, event_type, value FROM events
""")
def stream_dedup_available_now(spark, d):
    """Events written as JSON messages, landed by a Structured Streaming
    query (availableNow), then the last three days are redelivered and a
    second run drains them; the landed table is read with latest-by-version.
    Scratch folders live under spark.checkpoint.dir."""
    ev = _ev(spark, d).select("event_id", "ts", "user_id", "event_type", "value")
    return _landed(spark, "stream-dedup", [ev, ev.filter(F.col("ts") >= F.timestamp_add("DAY", F.lit(-3), ntz(EVENTS_AS_OF)))])


def _landed(spark, name, batches):
    """Land each batch of events with a run of its own, then read the table."""
    from daybook.session import scratch_path
    from daybook.streaming.landing import land_json, read_landed
    base = scratch_path(spark, name)
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    for i, batch in enumerate(batches):
        batch.write.mode("overwrite").options(**micros).json(f"{base}/in/batch{i}")
        land_json(spark, f"{base}/in/*", schema=batch.schema, out_dir=f"{base}/bronze", checkpoint=f"{base}/_ckpt",
                  options=micros)
    return read_landed(spark, f"{base}/bronze", ["event_id"], "ts").select(
        "event_id", "ts", "user_id", "event_type", "value")


@query("stream_late_rows", """
SELECT event_id, ts, user_id, event_type, value FROM events
""")
def stream_late_rows(spark, d):
    """The newer half of the events lands first, then the older half, and the
    oldest ten days once more: every event is kept, however late."""
    ev = _ev(spark, d).select("event_id", "ts", "user_id", "event_type", "value")
    half = F.timestamp_add("DAY", F.lit(-15), ntz(EVENTS_AS_OF))
    old = F.timestamp_add("DAY", F.lit(-20), ntz(EVENTS_AS_OF))
    return _landed(spark, "stream-late", [ev.filter(F.col("ts") >= half), ev.filter(F.col("ts") < half),
                                          ev.filter(F.col("ts") < old)])


# --------------------------------------------------------------------------
# JSN-03, STM-02 contract validation and ok / dead-letter split
# --------------------------------------------------------------------------
@query("contract_split", """
WITH c AS (SELECT event_type,
  CASE WHEN NOT coalesce(json_valid(props), false) OR json_type(props) <> 'OBJECT' THEN 'not a JSON object'
       WHEN json_extract(props, '$.k') IS NULL THEN 'missing required field k'
       WHEN json_type(props, '$.k') NOT IN ('UBIGINT', 'BIGINT') THEN 'k is not of type integer'
       WHEN CAST(json_extract(props, '$.k') AS BIGINT) < 0 OR CAST(json_extract(props, '$.k') AS BIGINT) >= 90 THEN 'k out of range'
       WHEN len(list_filter(json_keys(props), lambda x: x <> 'k')) > 0 THEN 'unexpected field'
       ELSE '' END AS error FROM events)
SELECT event_type, CASE WHEN error = '' THEN 'ok' ELSE 'dlq' END AS status, error, count(*) AS n
FROM c GROUP BY 1, 2, 3
""")
def contract_split(spark, d):
    """Validate every payload against a closed contract (``k`` integer,
    0 ≤ k < 90), then count ok vs dead-letter rows by first error."""
    from daybook.functions.contract import Field, contract_errors
    errs = contract_errors("props", [Field("k", "integer", minimum=0, exclusive_maximum=90)])
    ev = _ev(spark, d).select("event_type", F.coalesce(F.get(errs, 0), F.lit("")).alias("error"))
    return ev.groupBy("event_type", F.when(F.col("error") == "", "ok").otherwise("dlq").alias("status"), "error") \
        .agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# STR-09/10 URL parameters
# --------------------------------------------------------------------------
@query("url_fields", """
SELECT page_id,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) AS host,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1) AS path,
       url_decode(replace(regexp_extract(url, '[?&]page=([^&#]+)', 1), '+', ' ')) AS page,
       url_decode(replace(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '+', ' ')) AS ref,
       url_decode(replace(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '+', ' ')) AS utm_source,
       regexp_extract(url, '#(.*)$', 1) AS fragment
FROM pages
""")
def url_fields(spark, d):
    """Host, path, decoded query parameters and fragment of every URL."""
    p = read(spark, d, "pages").select("page_id", "url")
    u = F.col("url")
    return p.select(
        "page_id",
        F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1).alias("host"),
        F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1).alias("path"),
        *[url_decode_plus(url_param(u, name)).alias(name) for name in ("page", "ref", "utm_source")],
        F.regexp_extract(u, "#(.*)$", 1).alias("fragment"))


# --------------------------------------------------------------------------
# STR-05, JON-05 join-key normaliser over whole texts
# --------------------------------------------------------------------------
@query("text_key_normalise", """
WITH k AS (SELECT doc_id, CASE WHEN t = '' THEN '' ELSE 'q:' || t END AS key FROM (
             SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS t FROM documents))
SELECT sha256(key) AS key_hash, count(*) AS n_docs, min(doc_id) AS first_doc, max(length(key)) AS key_chars
FROM k GROUP BY 1
""")
def text_key_normalise(spark, d):
    """Normalise whole documents to the shared text key and group equal
    keys. The shuffle carries a 256-bit hash of the key (computed
    map-side), not the text itself."""
    k = read(spark, d, "documents").select("doc_id", text_key(F.col("text")).alias("key"))
    return k.groupBy(F.sha2("key", 256).alias("key_hash")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"),
        F.max(F.length("key")).cast("long").alias("key_chars"))


# --------------------------------------------------------------------------
# STR-12, SRC-12 title classifier
# --------------------------------------------------------------------------
TITLES_SQL = """(
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS title_id, 'Searched for ' || p_name AS title FROM part
  UNION ALL SELECT 'b' || CAST(p_partkey AS VARCHAR), CASE WHEN p_size > 45 THEN '' ELSE '  ' || p_brand || ' ' END FROM part
  UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'Directions to ' || n_name FROM nation
  UNION ALL SELECT 'nr' || CAST(n_nationkey AS VARCHAR), 'Directions from ' || n_name || ' to ' || r_name || ' to go'
            FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'Directions from ' || c_name FROM customer
  UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), 'Viewed area around ' || r_name FROM region
  UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), CASE WHEN s_acctbal < 0 THEN 'Used Maps' ELSE s_name END FROM supplier)"""


def _titles(spark, d) -> DataFrame:
    part, nation, region = read(spark, d, "part"), read(spark, d, "nation"), read(spark, d, "region")
    cs = lambda c: F.col(c).cast("string")
    return (part.select(F.concat(F.lit("p"), cs("p_partkey")).alias("title_id"),
                        F.concat(F.lit("Searched for "), "p_name").alias("title"))
            .unionByName(part.select(F.concat(F.lit("b"), cs("p_partkey")).alias("title_id"),
                                     F.when(F.col("p_size") > 45, F.lit(""))
                                     .otherwise(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("title")))
            .unionByName(nation.select(F.concat(F.lit("n"), cs("n_nationkey")).alias("title_id"),
                                       F.concat(F.lit("Directions to "), "n_name").alias("title")))
            .unionByName(nation.join(region, F.col("r_regionkey") == F.col("n_regionkey")).select(
                F.concat(F.lit("nr"), cs("n_nationkey")).alias("title_id"),
                F.concat(F.lit("Directions from "), "n_name", F.lit(" to "), "r_name", F.lit(" to go")).alias("title")))
            .unionByName(read(spark, d, "customer").select(
                F.concat(F.lit("c"), cs("c_custkey")).alias("title_id"),
                F.concat(F.lit("Directions from "), "c_name").alias("title")))
            .unionByName(region.select(F.concat(F.lit("r"), cs("r_regionkey")).alias("title_id"),
                                       F.concat(F.lit("Viewed area around "), "r_name").alias("title")))
            .unionByName(read(spark, d, "supplier").select(
                F.concat(F.lit("s"), cs("s_suppkey")).alias("title_id"),
                F.when(F.col("s_acctbal") < 0, F.lit("Used Maps")).otherwise(F.col("s_name")).alias("title"))))


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


@query("title_classifier", f"""
WITH t AS (SELECT title_id, {_strip_sql('coalesce(title, \'\')')} AS t FROM {TITLES_SQL}),
x AS (SELECT title_id, t, CASE WHEN starts_with(t, 'Directions from ') THEN substr(t, 17) ELSE '' END AS rest FROM t)
SELECT title_id,
  CASE WHEN t = '' THEN 'other' WHEN starts_with(t, 'Searched for ') THEN 'search'
       WHEN starts_with(t, 'Directions from ') THEN 'directions' WHEN starts_with(t, 'Directions to ') THEN 'directions'
       WHEN starts_with(t, 'Viewed area around ') THEN 'view_place'
       WHEN starts_with(t, 'Used Maps') OR starts_with(t, 'Used the ') THEN 'other' ELSE 'view_place' END AS activity_type,
  CASE WHEN t <> '' AND starts_with(t, 'Searched for ') THEN {_strip_sql('substr(t, 14)')} ELSE '' END AS query,
  CASE WHEN t = '' OR starts_with(t, 'Searched for ') OR starts_with(t, 'Directions from ') OR starts_with(t, 'Directions to ')
            OR starts_with(t, 'Used Maps') OR starts_with(t, 'Used the ') THEN ''
       WHEN starts_with(t, 'Viewed area around ') THEN {_strip_sql('substr(t, 20)')} ELSE t END AS place_name,
  CASE WHEN t <> '' AND NOT starts_with(t, 'Searched for ') AND starts_with(t, 'Directions from ') THEN
       CASE WHEN strpos(rest, ' to ') > 0 THEN {_strip_sql("substr(rest, 1, strpos(rest, ' to ') - 1)")}
            ELSE {_strip_sql('rest')} END ELSE '' END AS origin,
  CASE WHEN t = '' OR starts_with(t, 'Searched for ') THEN ''
       WHEN starts_with(t, 'Directions from ') THEN
         CASE WHEN strpos(rest, ' to ') > 0 THEN {_strip_sql("substr(rest, strpos(rest, ' to ') + 4)")} ELSE '' END
       WHEN starts_with(t, 'Directions to ') THEN {_strip_sql('substr(t, 15)')} ELSE '' END AS destination
FROM x
""")
def title_classifier(spark, d):
    """Activity titles built from catalog names, classified by prefix and
    split back into query / place / origin / destination."""
    t = _titles(spark, d)
    return t.select("title_id", classify_title("title").alias("c")).select("title_id", "c.*")


# --------------------------------------------------------------------------
# STR-18 readable time delta
# --------------------------------------------------------------------------
def _unit_sql(n: str, word: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST({n} AS VARCHAR) || ' {word}' || CASE WHEN {n} = 1 THEN '' ELSE 's' END END"


@query("readable_delta", f"""
WITH t AS (SELECT user_id, CAST(floor(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100) AS BIGINT) AS s
           FROM events GROUP BY 1),
p AS (SELECT user_id, s, s // 31536000 AS y, (s % 31536000) // 2635200 AS mo, (s % 31536000 % 2635200) // 86400 AS d,
             (s % 31536000 % 2635200 % 86400) // 3600 AS h, (s % 31536000 % 2635200 % 86400 % 3600) // 60 AS mi,
             s % 31536000 % 2635200 % 86400 % 3600 % 60 AS sec FROM t)
SELECT user_id, s AS seconds,
       CASE WHEN s <= 0 THEN '0 seconds' ELSE regexp_replace(concat_ws(', ', {_unit_sql('y', 'year')}, {_unit_sql('mo', 'month')},
            {_unit_sql('d', 'day')}, {_unit_sql('h', 'hour')}, {_unit_sql('mi', 'minute')}, {_unit_sql('sec', 'second')}),
            ', ([^,]*)$', ' and \\1') END AS readable
FROM p
""")
def readable_delta_q(spark, d):
    """Per-user total duration rendered as human text (no UDF)."""
    t = _ev(spark, d).groupBy("user_id").agg(F.floor(F.sum(cents(F.col("value"))) / 100).cast("long").alias("seconds"))
    return t.select("user_id", "seconds", readable_delta(F.col("seconds")).alias("readable"))


# --------------------------------------------------------------------------
# PIP-16, PRJ-10, FLT-12 live timeline
# --------------------------------------------------------------------------
@query("recent_timeline", f"""
WITH u AS ({UNIFIED_SQL}),
top AS (SELECT * FROM u WHERE event_ts <= TIMESTAMP '2024-01-31 00:00:00' AND event_ts >= TIMESTAMP '2024-01-01 00:00:00'
        ORDER BY event_ts DESC, event_id DESC LIMIT 60),
lab AS (SELECT *, concat_ws(' - ', nullif(trim(coalesce(title, '')), ''), nullif(trim(coalesce(subtitle, '')), '')) AS value,
               CASE kind WHEN 'play' THEN 'Played' WHEN 'liked' THEN 'Liked' WHEN 'watch' THEN 'Watched'
                         WHEN 'meeting' THEN 'Event' WHEN 'maps_search' THEN 'Searched' WHEN 'maps_directions' THEN 'Directions'
                         WHEN 'maps_view' THEN 'Viewed' WHEN 'maps_other' THEN 'Maps' ELSE kind END AS label FROM top)
SELECT strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS time, source AS channel, label, value,
       CAST(greatest(1, floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(min(event_ts) OVER ())) / 60000000.0 + 0.5)) AS BIGINT) AS window_minutes
FROM lab WHERE value <> ''
""")
def recent_timeline(spark, d):
    """The 60 newest unified events of the last 30 days with an action
    label, 'title - subtitle' text (blank parts dropped) and the window
    they span. The top-60 is a distributed top-k; the window over it sees
    at most 60 rows."""
    u = _unified(spark, d)
    as_of = ntz(EVENTS_AS_OF)
    w = u.filter((F.col("event_ts") <= as_of) & (F.col("event_ts") >= F.timestamp_add("DAY", F.lit(-30), as_of)))
    top = top_n(w, 60, [F.col("event_ts").desc(), F.col("event_id").desc()])
    lab = top.select("*", join_nonblank("title", "subtitle").alias("value"), kind_label("kind").alias("label"))
    oldest = F.min("event_ts").over(Window.partitionBy())
    span_us = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(oldest.cast("timestamp"))
    return lab.filter(F.col("value") != "").select(
        iso_utc("event_ts").alias("time"), F.col("source").alias("channel"), "label", "value",
        F.greatest(F.lit(1), F.floor(span_us / 60000000.0 + 0.5)).cast("long").alias("window_minutes"))


# --------------------------------------------------------------------------
# PIP-14/15, SET-04 freshness and health
# --------------------------------------------------------------------------
FRESHNESS_SOURCES = [("events", "events", "ts", 172800), ("orders", "orders", "o_orderdate", 86400),
                     ("lineitem", "lineitem", "l_shipdate", 259200)]


def _fresh_sql(src, table, col, budget) -> str:
    return (f"SELECT '{src}' AS source, max({col}) AS last_ts, count(*) FILTER (WHERE {col} <= TIMESTAMP '2024-01-31 00:00:00' "
            f"AND {col} >= TIMESTAMP '2024-01-01 00:00:00') AS rows_30d, count(*) AS rows_total, {budget} AS budget_s FROM {table}")


@query("freshness_status", f"""
WITH f AS ({' UNION ALL '.join(_fresh_sql(*s) for s in FRESHNESS_SOURCES)}),
a AS (SELECT *, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_ts)) // 1000000 AS age_s FROM f),
b AS (SELECT *, CASE WHEN last_ts IS NULL THEN 'down' WHEN age_s <= budget_s THEN 'healthy' ELSE 'stale' END AS status FROM a)
SELECT source, last_ts, CAST(age_s AS BIGINT) AS age_s, CAST(budget_s AS BIGINT) AS budget_s,
       CAST(rows_total > 0 AND age_s > budget_s AS INTEGER) AS breach, status, rows_30d,
       CASE WHEN age_s IS NULL OR age_s < 0 THEN '—'
            WHEN age_s < 90 THEN CAST(CAST(floor(age_s + 0.5) AS BIGINT) AS VARCHAR) || 's ago'
            WHEN age_s < 5400 THEN CAST(CAST(floor(age_s / 60 + 0.5) AS BIGINT) AS VARCHAR) || 'm ago'
            WHEN age_s < 172800 THEN CAST(CAST(floor(age_s / 3600 + 0.5) AS BIGINT) AS VARCHAR) || 'h ago'
            ELSE CAST(CAST(floor(age_s / 86400 + 0.5) AS BIGINT) AS VARCHAR) || 'd ago' END AS last_seen,
       max(CASE status WHEN 'healthy' THEN 0 WHEN 'stale' THEN 2 ELSE 3 END) OVER () AS worst_rank
FROM b
""")
def freshness_status(spark, d):
    """Per source: last event time, age at as_of, budget, breach (empty
    sources are not flagged), health status, 30-day rows, humanised age
    and the worst status rank — one aggregate per source, unioned."""
    from daybook.jobs.freshness import freshness
    srcs = {name: (read(spark, d, table), col, budget) for name, table, col, budget in FRESHNESS_SOURCES}
    return freshness(srcs, EVENTS_AS_OF, window_days=30)


# --------------------------------------------------------------------------
# PIP-07/09 work list → fetched results → tombstones → merged catalog
# --------------------------------------------------------------------------
@query("tombstone_merge", """
WITH requested AS (SELECT DISTINCT l_partkey AS id FROM lineitem),
cached AS (SELECT p_partkey AS id, p_name AS title FROM part WHERE p_size <= 10),
todo AS (SELECT id FROM requested WHERE NOT EXISTS (SELECT 1 FROM cached c WHERE c.id = requested.id)),
fetched AS (SELECT p.p_partkey AS id, p.p_name AS title FROM part p JOIN todo t ON t.id = p.p_partkey WHERE p.p_retailprice < 1500),
tomb AS (SELECT id, '' AS title FROM todo WHERE NOT EXISTS (SELECT 1 FROM fetched f WHERE f.id = todo.id))
SELECT id AS p_partkey, title, 0 AS is_tombstone, 'cached' AS origin FROM cached
UNION ALL SELECT id, title, 0, 'fetched' FROM fetched
UNION ALL SELECT id, title, 1, 'tombstone' FROM tomb
""")
def tombstone_merge(spark, d):
    """Catalog enrichment round: requested ids ∖ catalog = work list; ids
    the source did not return become placeholder rows so the work list
    converges; merged catalog = cached ∪ fetched ∪ tombstones."""
    from daybook.jobs.worklists import merge_with_tombstones, worklist
    requested = read(spark, d, "lineitem").select(F.col("l_partkey").alias("id"))
    part = read(spark, d, "part")
    cached = part.filter(F.col("p_size") <= 10).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    todo = worklist(requested, cached, "id")
    fetched = (part.filter(F.col("p_retailprice") < 1500)
               .select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
               .join(todo, "id", "left_semi"))
    merged = merge_with_tombstones(cached, todo, fetched, "id", {"title": ""})
    return merged.select(F.col("id").alias("p_partkey"), "title", F.col("is_tombstone").cast("int").alias("is_tombstone"),
                         "origin")


# --------------------------------------------------------------------------
# PIP-21 not-null report over every table
# --------------------------------------------------------------------------
def _not_null_sql() -> str:
    from daybook.sources.driver import DRIVER_COLUMNS
    parts = []
    for t, cols in DRIVER_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {t}")
    return "\nUNION ALL ".join(parts)


@query("not_null_report", _not_null_sql())
def not_null_report(spark, d):
    """Null counts of every column of every driver table (one scan each)."""
    from daybook.jobs.quality import null_reports
    from daybook.sources.driver import DRIVER_COLUMNS
    return null_reports({t: read(spark, d, t).select(*cols) for t, cols in DRIVER_COLUMNS.items()})


# --------------------------------------------------------------------------
# PIP-19 snapshot → list → restore round trip
# --------------------------------------------------------------------------
@query("snapshot_round_trip", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, CAST(coalesce(sum({cols[0]}), 0) AS BIGINT) AS key_sum FROM {t}"
    for t, cols in __import__("daybook.sources.driver", fromlist=["DRIVER_COLUMNS"]).DRIVER_COLUMNS.items()))
def snapshot_round_trip(spark, d):
    """Snapshot every driver table (zstd Parquet + manifest), list the
    snapshots, restore the latest complete one into a fresh warehouse and
    report rows and key checksums of the restored tables."""
    from daybook.session import scratch_path
    from daybook.sources.driver import DRIVER_COLUMNS
    from daybook.sources.snapshot import list_snapshots, restore, snapshot
    base = scratch_path(spark, "snapshot")
    tables = {t: read(spark, d, t) for t in DRIVER_COLUMNS}
    snapshot(spark, tables, f"{base}/snap", EVENTS_AS_OF.date())
    assert list_snapshots(spark, f"{base}/snap").filter("complete").count() == 1
    restore(spark, f"{base}/snap", lambda t: f"{base}/restored/{t}" if t in DRIVER_COLUMNS else None)
    from functools import reduce
    outs = [spark.read.parquet(f"{base}/restored/{t}").agg(
        F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col(cols[0]).cast("long")), F.lit(0)).cast("long").alias("key_sum"))
        for t, cols in DRIVER_COLUMNS.items()]
    return reduce(DataFrame.unionByName, outs)
