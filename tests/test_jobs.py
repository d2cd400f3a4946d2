"""Jobs: work lists, place resolution, calendar sync, overrides, imports,
health, bundles, trip evidence/verdicts/weather and the full model build."""

import datetime as dt
import json
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from daybook.jobs import calendar_sync, health, imports, overrides, trips, worklists
from daybook.plans import bundles, maps, registry
from daybook.sources import places
from daybook.sources.tables import read_raw, read_table
from tests.test_models_maps import AS_OF, ROME, _activity, _catalog


def test_worklists_and_resolution(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    put_rows(cfg, "maps_activity", [
        {"event_ts": AS_OF - dt.timedelta(days=1), "activity_type": "search", "query": "Pantheon", "lat": 41.9, "lng": 12.47},
        {"event_ts": AS_OF - dt.timedelta(days=2), "activity_type": "search", "query": "restaurants"},
        {"event_ts": AS_OF - dt.timedelta(days=3), "activity_type": "search", "query": "Atlantis"},
        {"event_ts": AS_OF - dt.timedelta(days=4), "activity_type": "search", "query": "colosseum"}])
    wl = {r["geo_key"]: r for r in worklists.place_worklist(spark, cfg).collect()}
    assert set(wl) == {"q:pantheon", "q:restaurants", "q:atlantis"}          # catalog hit excluded
    results = spark.createDataFrame([("q:pantheon", "Pantheon", 41.8986, 12.4769), ("q:atlantis", "", 0.0, 0.0)],
                                    "lookup_key string, place_name string, lat double, lng double") \
        .withColumn("primary_type", F.lit("church"))
    cols = read_table(spark, cfg, "maps_place_catalog").columns
    for c in cols:
        if c not in results.columns and c != "_fetched_at":
            results = results.withColumn(c, F.lit(None).cast(read_table(spark, cfg, "maps_place_catalog").schema[c].dataType))
    res = places.resolve_places(worklists.place_worklist(spark, cfg).select("geo_key", "text"), results,
                                read_table(spark, cfg, "maps_place_catalog"))
    rows = res.collect()
    new = {r["place_id"]: r for r in rows}
    assert new["q:pantheon"]["place_name"] == "Pantheon"
    assert new["q:restaurants"]["match_type"] == "unresolved" and new["q:atlantis"]["match_type"] == "unresolved"
    from daybook.sources.tables import append
    append(spark.createDataFrame(rows, res.schema), cfg, "maps_place_catalog")
    assert worklists.place_worklist(spark, cfg).count() == 0                  # converged


def test_calendar_sync_and_labels(spark, cfg, put_rows):
    put_rows(cfg, "calendar_channels", [{"calendar_id": "c1", "channel_id": "ch1", "calendar_name": "Work",
                                         "sync_token": "tok1", "_updated_at": AS_OF - dt.timedelta(hours=2)},
                                        {"calendar_id": "c1", "channel_id": "ch2", "calendar_name": "Work 2",
                                         "sync_token": "", "_updated_at": AS_OF - dt.timedelta(hours=1)}])
    hooks = spark.createDataFrame([("ch1", 1, AS_OF, "r", "sync"), ("ch1", 2, AS_OF, "r", "exists"),
                                   ("ch1", 3, AS_OF, "r", "exists"), ("chX", 1, AS_OF, "r", "exists")],
                                  "channel_id string, message_number long, received_at timestamp, resource_id string, state string")
    chans = read_table(spark, cfg, "calendar_channels")
    rows = calendar_sync.notification_rows(hooks, chans)
    assert rows.count() == 3 and rows.filter("calendar_id = ''").count() == 1
    from daybook.sources.tables import append
    append(rows, cfg, "calendar_sync_notifications", ingested_at=AS_OF - dt.timedelta(minutes=5))
    plan = {r["calendar_id"]: r for r in calendar_sync.drain_plan(spark, cfg).collect()}
    assert plan["c1"]["max_message"] == 3 and plan["c1"]["calendar_name"] == "Work 2"
    calendar_sync.mark_processed(spark, cfg, calendar_sync.drain_plan(spark, cfg))
    assert calendar_sync.drain_plan(spark, cfg).count() == 0
    assert calendar_sync.sync_cursors(spark, cfg).first()["sync_token"] == "tok1"
    posted = spark.createDataFrame([("2025-01-01_2025-01-05", "edit", "New", "", "", "n"),
                                    ("2025-01-01_2025-01-05", "confirm", "ignored", "", "", ""),
                                    ("bad", "edit", "", "", "", ""), ("2025-01-01_2025-01-05", "maybe", "", "", "", "")],
                                   "trip_key string, label string, edited_title string, edited_destination string, "
                                   "edited_trip_type string, note string")
    ok, bad = overrides.validate_labels(posted)
    assert bad.count() == 2 and sorted(r["edited_title"] for r in ok.collect()) == ["", "New"]


def test_imports_and_health(spark, cfg):
    root = tempfile.mkdtemp(prefix="imp-")
    hist = [{"ts": "2025-06-01T10:00:00Z", "spotify_track_uri": "spotify:track:a1", "master_metadata_track_name": "A",
             "master_metadata_album_artist_name": "Art", "master_metadata_album_album_name": "Alb", "ms_played": 1},
            {"ts": "2025-06-01T11:00:00Z", "spotify_track_uri": "spotify:episode:e", "ms_played": 1}]
    os.makedirs(os.path.join(root, "sub"))
    with open(os.path.join(root, "sub", "Streaming_History_Audio_2025.json"), "w") as f:
        json.dump(hist, f)
    with zipfile.ZipFile(os.path.join(root, "part2.zip"), "w") as z:
        z.writestr("Streaming_History_Audio_2024.json", json.dumps([dict(hist[0], ts="2024-06-01T10:00:00Z")]))
    r = imports.import_extended_history(spark, cfg, root)
    assert r == {"entries": 3, "kept": 2, "skipped": 1}
    rep = {x["channel"]: x for x in health.health_report(spark, cfg).collect()}
    assert rep["spotify"]["status"] == "stale" and rep["youtube"]["status"] == "down"
    assert rep["spotify"]["worst_status"] == "down" and rep["spotify"]["events_per_month"] == 1
    st = {x["layer"]: x for x in health.storage_stats(spark, cfg).collect()}
    assert st["bronze"]["rows"] == 2 and st["bronze"]["bytes"] > 0
    assert health.monitor(spark, cfg).count() >= 1
    assert health.table_inventory(spark, cfg).count() >= 20


def test_trips_evidence_verdicts_weather_and_build(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    _activity(cfg, put_rows)
    t = trips.segment_trips(spark, cfg)
    t.write.mode("overwrite").parquet(cfg.table_path("silver", "maps_trips"))
    put_rows(cfg, "calendar_events", [{"event_id": "f", "calendar_name": "me@x", "title": "Flight to Rome",
                                       "started_at": dt.datetime.combine(AS_OF.date() - dt.timedelta(days=51), dt.time(7)),
                                       "ended_at": dt.datetime.combine(AS_OF.date() - dt.timedelta(days=51), dt.time(9)),
                                       "status": "confirmed"}])
    from daybook.plans.calendar import silver_calendar_geo
    e = maps.silver_maps_activity_enriched(spark, cfg)
    ev = {r["trip_key"]: r for r in trips.trip_evidence(spark, cfg, read_table(spark, cfg, "maps_trips"), e,
                                                        silver_calendar_geo(spark, cfg)).collect()}
    rome_key = [k for k in ev if "Rome, Italy" in ev[k]["evidence"]][0]
    assert ev[rome_key]["n"] == 7 and ev[rome_key]["n_dir"] == 5      # home days inside the window count too
    assert "Flight to Rome" in ev[rome_key]["evidence"] and "Rome, Italy" in ev[rome_key]["evidence"]
    lines = ev[rome_key]["evidence"].split("\n")
    trip = {(r["started_at"], r["ended_at"]): r for r in t.collect()}[(ev[rome_key]["started_at"], ev[rome_key]["ended_at"])]
    assert lines[1] == f"dates: {trip['started_at']} to {trip['ended_at']} ({trip['days']} days)"
    assert lines[2] == "geometric guess: Rome, Italy"
    assert lines[3] == f"distinct: {trip['localities']} localities, {trip['countries']} countries"
    assert lines[4] == f"distances: at most {trip['max_km']} km from home, round trip about {trip['km']} km"
    bare = trips.trip_evidence(spark, cfg, t.select("started_at", "ended_at"), e).filter(F.col("trip_key") == rome_key).first()
    assert bare["n"] == 7 and "geometric guess: ?, ?" in bare["evidence"] and "  (none)" in bare["evidence"]
    v = spark.createDataFrame([(rome_key, "noise {\"is_trip\": true, \"confidence\": 1.7, \"trip_type\": \"Road Trip\","
                                          " \"title\": \"Rome\", \"suggested_split\": [\"a\", \"b\"]} tail", "m1")],
                              "trip_key string, raw string, model string").join(
        read_table(spark, cfg, "maps_trips").withColumn("trip_key", maps.trip_key("started_at", "ended_at")), "trip_key")
    nv = trips.normalise_verdicts(v.withColumn("evidence", F.lit(""))).first()
    assert nv["confidence"] == 1.0 and nv["trip_type"] == "other" and nv["suggested_split"] == '["a", "b"]'
    cents = trips.destination_centroid(read_table(spark, cfg, "maps_trips").withColumn(
        "trip_key", maps.trip_key("started_at", "ended_at")), maps.public_activity(spark, cfg, e))
    c = {r["trip_key"]: r for r in cents.collect()}[rome_key]
    assert abs(c["lat"] - ROME[0]) < 1e-6
    d0 = AS_OF.date() - dt.timedelta(days=50)
    wx = spark.createDataFrame([(round(ROME[0], 2), round(ROME[1], 2), d0 + dt.timedelta(days=i), 20.0 + i, 25.0, None, 1.0)
                                for i in range(5)],
                               "lat double, lng double, day date, temperature_2m_mean double, temperature_2m_max double, "
                               "temperature_2m_min double, precipitation_sum double")
    ws = trips.weather_summary(read_table(spark, cfg, "maps_trips").withColumn("trip_key", maps.trip_key("started_at", "ended_at")),
                               cents, wx).collect()
    assert len(ws) == 1 and ws[0]["temp_mean"] == 22.0 and ws[0]["temp_min"] == 22.0 and ws[0]["precip_mm"] == 5.0
    assert ws[0]["summary"] == "22°C avg · 5mm rain"
    models = registry.build_all(spark, cfg)
    assert len(models) >= 48
    for name, df in models.items():
        df.limit(1).collect()
    b = bundles.travel_bundle(spark, cfg)
    assert {r["name"] for r in b["distribution"].collect()} >= {"directions"}
    h = bundles.home_bundle(spark, cfg, models)
    s = h["summary"].first()
    assert s["songsStreamed"] == "0" and s["spotifyHours"] == 0.0 and s["citiesVisited"].isdigit()
    daily = h["daily"].collect()
    assert h["daily"].columns == ["date", "spotify", "youtube", "calendar", "maps"] and daily == sorted(daily)
    total = sum(r["spotify"] + r["youtube"] + r["calendar"] + r["maps"] for r in daily)
    assert total > 0 and h["totals"].first()["totalEvents"] == str(total)
    assert h["recent_maps"].count() > 0 and h["timeline"].count() >= 0 and h["current"].first()["has_track"] is False
    short = bundles.spotify_summary_bundle(spark, cfg)
    assert [tuple(r) for r in short["stats"].orderBy("pos").collect()] == [(0, "Artists", "0"), (1, "Songs", "0")]
    assert short["total_hours"].first()[0] == "0 hrs"
    alone = bundles.overview_bundle(spark, cfg)
    assert alone["summary"].first() == s and alone["daily"].collect() == daily
    cur = bundles.current_track_shaped(models["gold_spotify_current_track"]).collect()
    assert len(cur) == 1 and cur[0]["has_track"] is False
    assert read_raw(spark, cfg, "alerts").count() == 0


def test_private_places_rebuild_is_fail_safe(spark, cfg):
    root = tempfile.mkdtemp(prefix="star-")
    with open(os.path.join(root, "Saved Places.json"), "w") as f:
        json.dump({"features": [{"geometry": {"coordinates": [2.35, 48.85]}},
                                {"geometry": {"coordinates": [0, 0]}}]}, f)
    assert imports.rebuild_private_places(spark, cfg, root) == 1
    empty = tempfile.mkdtemp(prefix="star-empty-")
    with open(os.path.join(empty, "Saved Places.json"), "w") as f:
        json.dump({"features": []}, f)
    try:
        imports.rebuild_private_places(spark, cfg, empty)
        raise AssertionError("an empty rebuild must be refused")
    except ValueError:
        pass
    assert read_table(spark, cfg, "maps_private_places").count() == 1   # old list intact


def test_long_split_list_stays_json(spark):
    import json
    items = [f'day {i} "quoted", é' for i in range(400)]
    v = spark.createDataFrame([("k", dt.date(2024, 1, 1), dt.date(2024, 1, 2), json.dumps({"suggested_split": items}), "m")],
                              "trip_key string, started_at date, ended_at date, raw string, model string")
    assert json.loads(trips.normalise_verdicts(v).first().suggested_split) == items
    cut = trips.normalise_verdicts(v, split_chars=2000).first().suggested_split
    kept = json.loads(cut)
    assert len(cut) <= 2000 and kept == items[:len(kept)] and len(kept) > 50
