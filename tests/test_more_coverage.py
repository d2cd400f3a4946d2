"""Functions the other tests do not reach: remaining normalisers, sinks,
bundle reshaping, work lists, windowed ingest and stream alert rules."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.jobs import imports, worklists
from daybook.plans import bundles
from daybook.sources import google, spotify as sp
from daybook.sources.tables import read_table, register_views, to_json_lines
from daybook.streaming.now_playing import alert_rules

AS_OF = dt.datetime(2025, 6, 30, 12)


def test_spotify_and_channel_normalisers(spark):
    rp = spark.createDataFrame([{"items": [{"played_at": "2025-06-01T10:00:00.000Z", "context": {"type": "album", "uri": "u"},
                                            "track": {"id": "t1", "name": "N", "duration_ms": 5,
                                                      "artists": [{"id": "a", "name": "A"}], "album": {"name": "Al", "images": []}}},
                                           {"played_at": None, "track": {"id": "t2"}}]}], sp.RECENTLY_PLAYED_DDL)
    r = sp.recently_played_rows(rp).collect()
    assert len(r) == 1 and (r[0]["track_id"], r[0]["artists_names"], r[0]["context_type"]) == ("t1", ["A"], "album")
    st = spark.createDataFrame([{"items": [{"added_at": "2025-06-01T10:00:00Z", "track": {"id": "t9", "uri": "u9"}}]}],
                               sp.SAVED_TRACKS_DDL)
    assert sp.saved_tracks_rows(st).first()["track_id"] == "t9"
    ar = spark.createDataFrame([{"id": "a1", "name": "Art", "genres": ["rock"], "followers": {"total": 7},
                                 "images": [{"url": "img"}]}, {"id": "a2", "name": "B"}], sp.ARTIST_DDL)
    a = {x["artist_id"]: x for x in sp.artist_catalog_rows(ar).collect()}
    assert (a["a1"]["followers"], a["a1"]["image_url"], a["a2"]["image_url"], a["a2"]["genres"]) == (7, "img", "", [])
    ch = spark.createDataFrame([{"id": "c1", "snippet": {"title": "T", "thumbnails": {"default": {"url": "th"}}},
                                 "statistics": {"subscriberCount": "12"}}], google.CHANNEL_DDL)
    c = google.youtube_channel_rows(ch).first()
    assert (c["channel_title"], c["subscriber_count"], c["thumbnail_url"]) == ("T", 12, "th")
    from pyspark.sql.types import StructField, StructType, TimestampType
    payload_t = sp.schema(sp.NOW_PLAYING_DDL)
    np_schema = StructType([StructField("captured_at", TimestampType()), StructField("payload", payload_t),
                            StructField("fallback", payload_t)])
    rows = [(AS_OF, {"is_playing": False, "item": None},
             {"is_playing": True, "progress_ms": 9, "item": {"id": "fb", "name": "Fallback", "artists": []}}),
            (AS_OF, {"is_playing": True, "item": {"id": "pri", "name": "Primary"}}, None)]
    got = {r["track_id"]: r for r in sp.now_playing_rows(spark.createDataFrame(rows, np_schema), fallback="fallback").collect()}
    assert set(got) == {"fb", "pri"} and got["fb"]["progress_ms"] == 9 and got["fb"]["is_playing"] is True


def test_layers_views_json(spark, cfg):
    dev = Cfg(root="/w", env="dev")
    assert dev.table_path("silver", "x") == "/w/dev_silver/x" and dev.table_path("bronze", "y") == "/w/bronze/y"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    register_views(spark, {"tiny_model": df})
    assert spark.sql("SELECT count(*) AS n FROM tiny_model").first()["n"] == 1
    out = tempfile.mkdtemp(prefix="jl-") + "/o"
    to_json_lines(df, out)
    assert json.loads(spark.read.text(out).first()["value"]) == {"k": 1, "v": "a"}


def test_reshaping_and_helpers(spark, cfg, put_rows):
    rec = spark.createDataFrame([("spotify", 1, "S", "Art", "t", "i", "play", 0), ("maps", 1, "Cafe", "maps_view", "t", "", "maps_view", 0)],
                                "source string, recency_rank int, title string, subtitle string, time string, image_url string, "
                                "activity_type string, is_from_ads int")
    r = bundles.recent_by_source(rec)
    assert r["spotify"].first()["artist"] == "Art" and r["maps"].first()["kind"] == "maps_view"
    done = spark.createDataFrame([("k1",)], "trip_key string")
    cand = spark.createDataFrame([("k1",), ("k2",)], "trip_key string")
    assert [x[0] for x in worklists.skip_done(cand, done, ["trip_key"]).collect()] == ["k2"]
    assert worklists.skip_done(cand, done, ["trip_key"], force=True).count() == 2
    ch = worklists.chunks(spark.range(120).select(F.col("id").cast("string").alias("k")), "k", 50)
    sizes = [len(x["ids"]) for x in ch.collect()]
    assert max(sizes) <= 50 and sum(sizes) == 120
    uneven = worklists.chunks(spark.range(10_000).select((F.col("id") * F.col("id")).alias("k")), "k", 50).collect()
    assert max(len(x["ids"]) for x in uneven) <= 50 and len(uneven) <= 200 + 8
    assert len({k for x in uneven for k in x["ids"]}) == 10_000
    ev = spark.createDataFrame([(AS_OF - dt.timedelta(days=d),) for d in range(6)], "ts timestamp")
    assert imports.windowed(ev, "ts", AS_OF, 3).count() == 4
    put_rows(cfg, "spotify_player_current", [{"captured_at": AS_OF - dt.timedelta(days=2), "track_id": "t"}])
    put_rows(cfg, "spotify_player_current_dlq", [{"rejected_at": AS_OF - dt.timedelta(hours=1), "error": "e", "payload": "p"}])
    al = {x["kind"] for x in alert_rules(read_table(spark, cfg, "spotify_player_current"),
                                          read_table(spark, cfg, "spotify_player_current_dlq"), AS_OF).collect()}
    assert al == {"stream_rejects", "stream_silence"}


def test_domain_worklists_and_google_import(spark, cfg, put_rows):
    put_rows(cfg, "spotify_plays_raw", [{"played_at": AS_OF, "track_id": "t1", "artists_ids": ["a1", "a2"]},
                                        {"played_at": AS_OF, "track_id": "t2", "artists_ids": ["a2"]}])
    put_rows(cfg, "spotify_tracks", [{"track_id": "t1", "artists_ids": ["a3"]}])
    put_rows(cfg, "spotify_artists", [{"artist_id": "a2"}])
    assert [x[0] for x in worklists.track_worklist(spark, cfg).collect()] == ["t2"]
    assert sorted(x[0] for x in worklists.artist_worklist(spark, cfg).collect()) == ["a1"]
    assert sorted(x[0] for x in worklists.artist_worklist(spark, cfg, backfill=True).collect()) == ["a1", "a3"]
    put_rows(cfg, "youtube_watch_history", [{"watched_at": AS_OF, "video_id": v} for v in ("v1", "v2", "v3")])
    todo = worklists.video_worklist(spark, cfg)
    returned = spark.createDataFrame([("v1",)], "video_id string")
    failed = spark.createDataFrame([("v3",)], "video_id string")
    tomb = worklists.video_tombstones(todo, returned, failed).collect()
    assert [t["video_id"] for t in tomb] == ["v2"] and tomb[0]["video_title"] == ""
    put_rows(cfg, "calendar_events", [{"event_id": "e", "started_at": AS_OF, "ended_at": AS_OF, "status": "confirmed",
                                       "location": "  Main   Station "}])
    assert worklists.calendar_place_worklist(spark, cfg).first()["geo_key"] == "q:main station"
    root = tempfile.mkdtemp(prefix="ga-")
    with open(os.path.join(root, "MyActivity.json"), "w") as f:
        json.dump([{"header": "Maps", "title": "Directions to Louvre", "time": "2025-06-01T10:00:00Z"},
                   {"header": "YouTube", "title": "Watched X", "titleUrl": "https://www.youtube.com/watch?v=abcdefghijk",
                    "time": "2025-06-01T11:00:00Z"},
                   {"header": "YouTube", "title": "Searched for cats", "time": "2025-06-01T12:00:00Z"}], f)
    got = imports.import_google_archive(spark, cfg, root)
    assert got == {"maps": 1, "watches": 1, "searches": 1}


def test_rows_without_entity_keep_their_neighbour_across_chunks(spark):
    from daybook.operators.segments import transitions
    rows = spark.createDataFrame([(None, AS_OF, "x"), (None, AS_OF + dt.timedelta(days=1), "x"), ("e", AS_OF, "x")],
                                 "entity string, ts timestamp, state string")
    plain = transitions(rows, ["entity"], "ts", ["state"]).count()
    assert transitions(rows, ["entity"], "ts", ["state"], chunk=F.to_date("ts")).count() == plain == 2


def test_left_overlap_keeps_rows_with_nulls_once(spark):
    from daybook.operators.joins import overlap_join
    left = spark.createDataFrame([(1, None, dt.date(2025, 1, 1), dt.date(2025, 1, 5)),
                                  (2, None, dt.date(2026, 1, 1), dt.date(2026, 1, 2))], "k int, note string, a date, b date")
    right = spark.createDataFrame([(dt.date(2025, 1, 3), "r")], "d date, r string")
    got = sorted((r.k, r.r) for r in overlap_join(left, right, "a", "b", "d", how="left").collect())
    assert got == [(1, "r"), (2, None)]


def test_gap_kpis_of_nested_events_and_lag_alerts(spark, cfg):
    from daybook.plans.calendar import gap_kpis
    from daybook.streaming.now_playing import lag_alerts
    day = dt.datetime(2025, 6, 2)
    at = lambda h, m=0: day + dt.timedelta(hours=h, minutes=m)
    ev = spark.createDataFrame([("a", at(9), at(15), day.date(), 0), ("b", at(10), at(11), day.date(), 0),
                                ("c", at(16), at(17), day.date(), 0)],
                               "event_id string, started_at timestamp, ended_at timestamp, event_date date, is_all_day int")
    g = gap_kpis(spark, cfg, ev).first()
    assert (g["longest_gap_minutes"], g["fragments"], g["events"]) == (60, 1, 3)
    # many calendars of one hour, each with an own event: one start for all, and spans per calendar
    many = ev.crossJoin(spark.range(200).select(F.col("id").alias("calendar_id"))).unionByName(
        ev.limit(0).withColumn("calendar_id", F.lit(0).cast("long"))).filter("event_id <> 'b' OR calendar_id < 5")
    both = gap_kpis(spark, cfg, many).first()
    assert (both["longest_gap_minutes"], both["fragments"], both["events"]) == (60, 1, 405)
    alone = gap_kpis(spark, cfg, many.filter("event_id <> 'a'"), ["calendar_id"])
    assert {(r["calendar_id"] < 5, r["longest_gap_minutes"], r["fragments"], r["events"]) for r in alone.collect()} == \
        {(True, 300, 1, 2), (False, 0, 0, 1)}
    lag = spark.createDataFrame([(at(1, m), 60 if 5 <= m <= 18 or 30 <= m <= 35 else 3) for m in range(60)],
                                "sampled_at timestamp, lag int")
    assert [(r.raised_at, r.kind) for r in lag_alerts(lag).collect()] == [(at(1, 15), "stream_lag")]


def test_lag_alert_over_midnight(spark):
    """A stretch over midnight, or over days, is one stretch."""
    from daybook.streaming.now_playing import lag_alerts
    t0 = dt.datetime(2025, 6, 2, 12)
    high = lambda m: 11 * 60 + 52 <= m < 12 * 60 + 10 or 30 * 60 <= m < 90 * 60
    rows = [(t0 + dt.timedelta(minutes=m), 90 if high(m) else 2) for m in range(5 * 24 * 60)]
    lag = spark.createDataFrame([*rows, (None, 99), (t0 + dt.timedelta(minutes=40), None)], "sampled_at timestamp, lag int")
    got = sorted((r.raised_at, r.message) for r in lag_alerts(lag).collect())
    assert [g[0] for g in got] == [t0 + dt.timedelta(hours=12, minutes=2), t0 + dt.timedelta(hours=30, minutes=10)]
    first = spark.createDataFrame([(t0 + dt.timedelta(minutes=m), 60) for m in range(12)], "sampled_at timestamp, lag int")
    assert [r.raised_at for r in lag_alerts(first).collect()] == [t0 + dt.timedelta(minutes=10)]
    assert lag_alerts(first.limit(0)).count() == 0


def test_a_cluster_needs_a_shared_scratch_folder():
    from daybook.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    try:
        ensure_checkpoint_dir(Session())
        raise AssertionError("expected an error")
    except ValueError as e:
        assert "spark.checkpoint.dir" in str(e)


def test_daily_build_writes_every_model(spark):
    import pytest

    from daybook.plans.registry import MODELS, run_daily
    from daybook.plans.standin import standin_warehouse
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    cfg = standin_warehouse(spark, sf)
    rows = run_daily(spark, cfg)
    assert set(rows) == set(MODELS)
    for name in ("silver_events_unified", "gold_home_overview_stats", "gold_spotify_genres", "silver_geo_daily"):
        assert rows[name] == MODELS[name](spark, cfg).count() == spark.table(name).count() > 0


def test_plans_are_built_without_jobs(spark):
    import pytest

    from daybook.plans.registry import MODELS
    from daybook.plans.standin import standin_warehouse
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    cfg = standin_warehouse(spark, sf)
    spark.sparkContext.setJobGroup("plan-build", "plans")
    for build in MODELS.values():
        build(spark, cfg)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("plan-build") == []
