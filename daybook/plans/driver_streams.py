"""Driver twins of the ordered streams, of their alerts and of the joins and
tables laid out for them; registered with those of ``plans.driver``."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.plans.driver import DWELL_S, EVENTS_AS_OF, ORACLE, _ev, query


def _out_of_order(spark, d, name, columns, make, key):
    """``make`` applied to a stream of all events that come in two batches,
    each spread over the whole month, with a restart in between, and then a row
    of another key that lets the watermark pass."""
    from daybook.session import scratch_path
    base = scratch_path(spark, name)
    ev = _ev(spark, d).select("event_id", F.col("user_id").cast("string").alias("user_id"), F.col("ts").cast("timestamp").alias("ts"),
                              *columns)
    parts = [ev.filter(F.pmod(F.hash("event_id"), F.lit(2)) == k) for k in range(2)]
    last = ev.limit(1).withColumn("user_id", F.lit("end")).withColumn("ts", F.timestamp_add("DAY", F.lit(400), F.col("ts")))
    for part in [*parts, last]:
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(ev.schema).parquet(f"{base}/in")
        q = (make(stream).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/_ckpt")
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out").filter(F.col(key) != "end")


# --------------------------------------------------------------------------
# STM-01 transition filter as an ordered stream
# --------------------------------------------------------------------------
@query("stream_transitions", """
SELECT user_id, event_id, ts, event_type FROM (
  SELECT user_id, event_id, ts, event_type,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS prev FROM events)
WHERE prev IS NULL OR prev <> event_type
""")
def stream_transitions(spark, d):
    """Events stream in out of order, over several batches and restarts; the
    transitions are those of the ordered events."""
    from daybook.streaming.now_playing import transition_filter_stream
    out = _out_of_order(spark, d, "stream-transitions", ["event_type"], lambda s: transition_filter_stream(
        s, key="user_id", ts="ts", state=("event_type",), watermark="45 days"), "user_id")
    return out.select(F.col("user_id").cast("long").alias("user_id"), "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")


# --------------------------------------------------------------------------
# STM-05/06 dwell segments as an ordered stream
# --------------------------------------------------------------------------
@query("stream_dwell_segments", f"""
WITH b AS (SELECT user_id, ts, event_type AS k, CAST(round(value * 1000) AS BIGINT) AS duration_ms,
                  lag(event_type, 1, '__none__') OVER (PARTITION BY user_id ORDER BY ts, event_type) AS prev FROM events),
s AS (SELECT * FROM b WHERE k <> prev AND k <> ''),
n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, k) AS next_start,
             ts + to_seconds(CASE WHEN duration_ms > 0 THEN CAST(floor(duration_ms / 1000) AS BIGINT) + 15 ELSE 21600 END) AS clamp FROM s),
bd AS (SELECT *, least(coalesce(next_start, clamp), clamp) AS played_at FROM n)
SELECT user_id, k AS event_type, ts AS started_at, played_at, date_diff('second', ts, played_at) AS dwell_s
FROM bd WHERE date_diff('second', ts, played_at) >= {DWELL_S}
""")
def stream_dwell_segments(spark, d):
    """The speed layer over events that come out of order; open tails close at
    their clamp, six hours after the start when the duration is unknown."""
    from daybook.functions.timefn import seconds_between
    from daybook.streaming.speed_layer import plays_stream
    rows = [F.col("event_type").alias("track_id"), F.round(F.col("value") * 1000).cast("long").alias("track_duration_ms")]
    out = _out_of_order(spark, d, "stream-dwell", rows, lambda s: plays_stream(
        s.withColumnsRenamed({"user_id": "device_id", "ts": "captured_at"}), watermark="45 days", dwell_s=DWELL_S), "device_id")
    return out.select(F.col("device_id").cast("long").alias("user_id"), F.col("track_id").alias("event_type"),
                      F.col("started_at").cast("timestamp_ntz").alias("started_at"),
                      F.col("played_at").cast("timestamp_ntz").alias("played_at"),
                      seconds_between("started_at", "played_at").alias("dwell_s"))


# --------------------------------------------------------------------------
# STM-15 lag alerts
# --------------------------------------------------------------------------
@query("lag_alert_stretches", """
WITH s AS (SELECT date_trunc('hour', ts) AS t, CAST(max(event_id % 1000) AS BIGINT) AS lag FROM events GROUP BY 1),
limits AS (SELECT CAST(floor(median(lag)) AS BIGINT) AS most FROM s),
m AS (SELECT t, lag - most AS lag, max(CASE WHEN lag <= most THEN t END) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING) AS since FROM s, limits),
r AS (SELECT since, min(t) AS a, max(t) AS b, max(lag) AS n FROM m WHERE lag > 0 GROUP BY since)
SELECT a + INTERVAL 120 MINUTE AS raised_at, 'stream_lag' AS kind,
       'consumer lag up to ' || n || ' messages for over 120 minutes' AS message
FROM r WHERE b >= a + INTERVAL 120 MINUTE
""")
def lag_alert_stretches(spark, d):
    """Hours whose samples stay above the median for two hours or more (lag is
    what they are above it), one alert a stretch, also over midnight."""
    from daybook.streaming.now_playing import lag_alerts
    samples = _ev(spark, d).groupBy(F.date_trunc("hour", "ts").alias("sampled_at")).agg(F.max(F.col("event_id") % 1000).alias("lag"))
    most = samples.select(F.floor(F.median("lag")).alias("m")).scalar()
    return lag_alerts(samples.withColumn("lag", F.col("lag") - most), 0, 120).select(
        F.col("raised_at").cast("timestamp_ntz").alias("raised_at"), "kind", "message")


# --------------------------------------------------------------------------
# AGG-13, SRC-01 latest version from a table laid out by key
# --------------------------------------------------------------------------
@query("latest_by_version_bucketed", ORACLE["latest_by_version"])
def latest_by_version_bucketed(spark, d):
    """The versions arrive in three appends; the read finds the latest per key
    in the buckets as they lie, without an exchange."""
    from daybook.session import scratch_path
    from daybook.sources import versioned_table as V
    rows = _ev(spark, d).select("user_id", "event_type", "ts", "event_id", "value")
    path = scratch_path(spark, "versions")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    V.create(spark, path, schema, ["user_id", "event_type"], "ts", 8)
    for k in range(3):
        V.append(spark, path, rows.filter(F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == k))
    return V.latest(spark, path)


# --------------------------------------------------------------------------
# STM-09, PIP-12 late re-ingest with a ledger
# --------------------------------------------------------------------------
@query("late_reingest", """
SELECT event_id, CAST(ts AS DATE) AS event_date, event_type FROM events
""")
def late_reingest(spark, d):
    """Three ingests: the first misses rows that come late, the second takes
    them up, the third comes after more than a fortnight and misses nothing."""
    import datetime as dt

    from daybook.jobs.imports import ingest_dates
    from daybook.session import scratch_path
    base = scratch_path(spark, "reingest")
    ev = _ev(spark, d).select("event_id", "ts", "event_type")
    late = (F.col("ts") >= F.lit("2024-01-09").cast("timestamp_ntz")) & (F.pmod(F.hash("event_id"), F.lit(5)) == 0)
    for day, rows in ((10, ev.filter(~late)), (12, ev), (31, ev)):
        ingest_dates(spark, rows, "ts", "events", f"{base}/events", f"{base}/ledger", dt.datetime(2024, 1, day, 23, 59, 59, 999999))
    return spark.read.parquet(f"{base}/events").select("event_id", "event_date", "event_type")


# --------------------------------------------------------------------------
# SNK-08, PIP-19 restore of what differs
# --------------------------------------------------------------------------
@query("restore_differences", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
UNION ALL SELECT -1, -1, 'own'
""")
def restore_differences(spark, d):
    """A restored table loses some rows and gets one of its own; the next
    restore compares checksums and brings back the lost rows only."""
    from daybook.session import scratch_path
    from daybook.sources.driver import read
    from daybook.sources.snapshot import restore, snapshot
    base = scratch_path(spark, "differences")
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    snapshot(spark, {"orders": orders}, f"{base}/snap", EVENTS_AS_OF.date())
    damaged = orders.filter("o_orderpriority <> '3-MEDIUM' OR o_custkey % 2 = 0").unionByName(
        orders.limit(1).select(F.lit(-1).cast("long").alias("o_orderkey"), F.lit(-1).cast("long").alias("o_custkey"), F.lit("own").alias("o_orderpriority")))
    damaged.write.parquet(f"{base}/out/orders")
    restore(spark, f"{base}/snap", lambda t: f"{base}/out/{t}")
    restore(spark, f"{base}/snap", lambda t: f"{base}/out/{t}")
    return spark.read.parquet(f"{base}/out/orders")
