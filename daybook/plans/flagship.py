"""Flagship query: the driver twin of ``gold_spotify_daily_listening``.

events (plays) read as latest version per (event_id) → enriched against
customer (catalog) and nation (second catalog, computed key) with
fallbacks → the last 30 days up to as_of → per-day hours and plays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.text import first_nonblank
from daybook.operators.versioned import latest_by_version
from daybook.plans.driver import EVENTS_AS_OF, cents, ntz
from daybook.sources.driver import read

DAILY_LISTENING_SQL = """
WITH p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1),
e AS (SELECT p.ts, p.value, coalesce(nullif(c.c_mktsegment, ''), 'unknown') AS segment
      FROM p LEFT JOIN customer c ON c.c_custkey = p.user_id)
SELECT CAST(ts AS DATE) AS day, count(*) AS plays,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 360000.0 AS hours,
       count(DISTINCT segment) AS segments
FROM e
WHERE ts <= TIMESTAMP '2024-01-31 00:00:00' AND CAST(ts AS DATE) >= DATE '2024-01-02'
GROUP BY 1
"""


def daily_listening_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily hours and plays over the last 30 days (value = seconds)."""
    ev = latest_by_version(read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value"),
                           ["event_id"], "ts")
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    e = ev.join(cust, ev.user_id == cust.c_custkey, "left").select(
        "ts", "value", first_nonblank("c_mktsegment", F.lit("unknown")).alias("segment"))
    as_of_d = EVENTS_AS_OF.date()
    w = e.filter((F.col("ts") <= ntz(EVENTS_AS_OF)) & (F.to_date("ts") >= F.date_sub(F.lit(as_of_d), 29)))
    return w.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("plays"), (F.sum(cents(F.col("value"))) / 360000.0).alias("hours"),
        F.countDistinct("segment").alias("segments"))
