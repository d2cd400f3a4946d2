"""Extensions and helpers not covered elsewhere."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.functions.timefn import as_timestamp, day_label
from daybook.jobs.health import age_report
from daybook.jobs.overrides import home_on_date, set_home
from daybook.operators.segments import transition_events
from daybook.operators.sketch import daily_states, merge_states
from daybook.plans.calendar import gap_kpis
from daybook.plans.home import overview_series
from daybook.sources.tables import compact, read_raw, read_table

T0 = dt.datetime(2025, 6, 1, 9)


def test_sketch_states_merge(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("user"), F.lit("g").alias("g"),
                                  F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 7).cast("int")).alias("day"))
    est = merge_states(daily_states(df, ["g"], "day", "user"), ["g"]).first()
    assert abs(est["approx_distinct"] - 1000) < 50 and est["rows"] == 5000


def test_gaps_transitions_and_labels(spark, cfg, put_rows):
    put_rows(cfg, "calendar_events", [
        {"event_id": "a", "started_at": T0, "ended_at": T0 + dt.timedelta(hours=1), "status": "confirmed"},
        {"event_id": "b", "started_at": T0 + dt.timedelta(hours=3), "ended_at": T0 + dt.timedelta(hours=4), "status": "confirmed"},
        {"event_id": "c", "started_at": T0 + dt.timedelta(hours=4), "ended_at": T0 + dt.timedelta(hours=5), "status": "confirmed"}])
    g = gap_kpis(spark, cfg).first()
    assert (g["longest_gap_minutes"], g["fragments"], g["events"]) == (120, 1, 3)
    ev = spark.createDataFrame([("d", T0, "x", True), ("d", T0 + dt.timedelta(seconds=10), "x", False),
                                ("d", T0 + dt.timedelta(seconds=20), "x", True), ("d", T0 + dt.timedelta(seconds=25), "y", True)],
                               "dev string, ts timestamp, track string, playing boolean")
    kinds = [(r["transition"], r["skipped"]) for r in transition_events(ev, ["dev"], "ts", "track", "playing").orderBy("ts").collect()]
    assert kinds == [("started", False), ("paused", False), ("resumed", True), ("started", False)]
    d = spark.createDataFrame([(dt.date(2025, 6, 30),), (dt.date(2025, 6, 29),), (dt.date(2025, 6, 1),)], "d date")
    assert [r[0] for r in d.select(day_label("d", dt.date(2025, 6, 30))).collect()] == ["Today", "Yesterday", "2025-06-01"]
    s = spark.createDataFrame([("2025-06-01 10:00:00",)], "x string").select(as_timestamp("x")).first()[0]
    assert s == dt.datetime(2025, 6, 1, 10)


def test_home_anchors_age_overview_compact(spark, cfg, put_rows):
    set_home(spark, cfg, spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0, 2.0, 5.0, "old"),
                                                (dt.datetime(2025, 3, 1), 3.0, 4.0, 5.0, "new")],
                                               "valid_from timestamp, lat double, lng double, radius_km double, label string"))
    days = spark.createDataFrame([(dt.date(2024, 6, 1),), (dt.date(2025, 6, 1),), (dt.date(2023, 1, 1),)], "event_date date")
    got = {r["event_date"]: r["home_label"] for r in home_on_date(spark, cfg, days).collect()}
    assert got == {dt.date(2024, 6, 1): "old", dt.date(2025, 6, 1): "new", dt.date(2023, 1, 1): None}
    a = age_report(spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 6, 29),)], "issued date"),
                   "issued", dt.datetime(2025, 6, 30), 30)
    assert a.count() == 1
    gen = spark.createDataFrame([(dt.date(2025, 6, 1) + dt.timedelta(days=i), 1, 2, 3, 4) for i in range(40)],
                                "date date, spotify long, youtube long, google long, maps long")
    o = overview_series(spark, cfg, gen).collect()
    assert len(o) == 30 and o[0]["date"] == dt.date(2025, 6, 11) and o[0]["sum_total"] == 300 and o[0]["avg_per_day"] == 10
    put_rows(cfg, "youtube_search_history", [{"searched_at": T0, "query": "q"}])
    put_rows(cfg, "youtube_search_history", [{"searched_at": T0, "query": "q"}], ingested_at=cfg.as_of + dt.timedelta(1))
    assert read_raw(spark, cfg, "youtube_search_history").count() == 2
    compact(spark, cfg, "youtube_search_history")
    assert read_raw(spark, cfg, "youtube_search_history").count() == 1
    assert read_table(spark, cfg, "youtube_search_history").count() == 1


def test_cluster_conf_sizes():
    from daybook.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8, executor_memory_gb=32)
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 ** 2
    assert int(c["spark.sql.shuffle.partitions"]) == 24000
    assert int(c["spark.sql.shuffle.partitions"]) % 8000 == 0
    small = cluster_conf(1024 ** 3, executors=1, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
