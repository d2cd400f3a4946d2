"""Maps models and the trip pipeline on hand-made rows (FIXTURES.md)."""

import datetime as dt

from daybook.jobs.trips import segment_trips
from daybook.plans import maps

AS_OF = dt.datetime(2025, 6, 30, 12, 0, 0)
PARIS = (48.8566, 2.3522)
ROME = (41.9028, 12.4964)
MILAN = (45.4642, 9.1900)


def _catalog(cfg, put_rows):
    rows = [("q:cafe de flore", "Cafe de Flore", PARIS, "Paris", "France"),
            ("q:colosseum", "Colosseum", ROME, "Rome", "Italy"),
            ("q:duomo", "Duomo", MILAN, "Milan", "Italy")]
    put_rows(cfg, "maps_place_catalog", [
        {"place_id": k, "place_name": n, "lat": ll[0], "lng": ll[1], "locality": loc, "country": c,
         "match_confidence": 0.9, "match_type": "poi", "primary_type": "tourist_attraction"} for k, n, ll, loc, c in rows]
        + [{"place_id": "q:nowhere", "match_type": "unresolved"}])


def _act(day, title_type, text, n=1, hour=10):
    ts = dt.datetime.combine(AS_OF.date() - dt.timedelta(days=60 - day), dt.time(hour))
    out = []
    for i in range(n):
        r = {"event_ts": ts + dt.timedelta(minutes=i), "activity_type": title_type}
        r["destination" if title_type == "directions" else "query" if title_type == "search" else "place_name"] = text
        out.append(r)
    return out


def _activity(cfg, put_rows):
    rows = []
    for d in range(0, 60):
        if d in (10, 11, 14, 19, 30):
            continue
        rows += _act(d, "directions", "Cafe de Flore", 2)
    rows += _act(10, "directions", "Colosseum") + _act(11, "view_place", "Colosseum") + _act(14, "search", "Colosseum")
    rows += _act(19, "directions", "Duomo")       # 5 days after the Rome run -> a new run
    rows += _act(30, "view_place", "Duomo")       # a run with no directions day -> dropped
    rows += _act(5, "search", "nowhere")          # sentinel match
    rows.append({"event_ts": dt.datetime(2025, 5, 1, 8), "activity_type": "view_place", "place_name": "Raw Place",
                 "lat": 10.0, "lng": 20.0})       # no catalog row, raw coordinates
    put_rows(cfg, "maps_activity", rows)


def test_enriched_join_and_defaults(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    _activity(cfg, put_rows)
    e = maps.silver_maps_activity_enriched(spark, cfg)
    sent = e.filter("query = 'nowhere'").first()
    assert sent["match_type"] == "unresolved" and sent["place_name"] == "" and sent["lat"] == 0.0
    raw = e.filter("event_ts = timestamp'2025-05-01 08:00:00'").first()
    assert (raw["place_name"], raw["lat"], raw["lng"]) == ("Raw Place", 10.0, 20.0)
    strict = maps.silver_maps_activity_enriched(spark, cfg, strict_defaults=True) \
        .filter("event_ts = timestamp'2025-05-01 08:00:00'").first()
    assert (strict["place_name"], strict["lat"]) == ("", 0.0)
    assert e.agg({"is_private": "max"}).first()[0] == 0            # empty private list


def test_private_flag_edges(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    base = dt.datetime(2025, 6, 1, 9)
    deg = 1 / 111195.0
    pts = [("in", PARIS[0] + 50 * deg), ("edge", PARIS[0] + 99.5 * deg), ("out", PARIS[0] + 150 * deg)]
    put_rows(cfg, "maps_activity", [{"event_ts": base + dt.timedelta(minutes=i), "activity_type": "view_place",
                                     "place_name": name, "lat": lat, "lng": PARIS[1]} for i, (name, lat) in enumerate(pts)]
             + [{"event_ts": base + dt.timedelta(hours=1), "activity_type": "view_place", "place_name": "zero"}])
    put_rows(cfg, "maps_private_places", [{"lat": PARIS[0], "lng": PARIS[1], "radius_m": 100}])
    got = {r["place_name"]: r["is_private"] for r in maps.silver_maps_activity_enriched(spark, cfg).collect()}
    assert got == {"in": 1, "edge": 1, "out": 0, "zero": 0}
    assert maps.public_activity(spark, cfg).count() == 2


def test_home_geo_daily_trips_and_gold(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    _activity(cfg, put_rows)
    home = maps.silver_home_base(spark, cfg).first()
    assert (home["home_locality"], home["home_country"]) == ("Paris", "France")
    g = {r["event_date"]: r for r in maps.silver_geo_daily(spark, cfg).collect()}
    day = lambda n: AS_OF.date() - dt.timedelta(days=60 - n)
    assert g[day(10)]["away"] == 1 and g[day(10)]["locality"] == "Rome" and g[day(0)]["away"] == 0
    assert g[day(10)]["km_from_home"] > 1000
    trips = {(r["started_at"], r["ended_at"]): r for r in segment_trips(spark, cfg).collect()}
    assert set(trips) == {(day(10), day(14)), (day(19), day(19))}
    rome = trips[(day(10), day(14))]
    assert (rome["destination"], rome["destination_country"], rome["days"]) == ("Rome", "Italy", 5)
    assert rome["km"] > 2 * 1100 and rome["localities"] == 1
    # persist candidates, add verdicts and labels, check the gold precedence and gate
    tdf = segment_trips(spark, cfg)
    tdf.write.mode("overwrite").parquet(cfg.table_path("silver", "maps_trips"))
    k_rome, k_milan = f"{day(10)}_{day(14)}", f"{day(19)}_{day(19)}"
    put_rows(cfg, "maps_trips_enriched", [
        {"trip_key": k_rome, "is_trip": 1, "title": "Roman holiday", "destination_label": "Roma", "confidence": 0.8},
        {"trip_key": k_milan, "is_trip": 0, "title": "Layover"}])
    gold = {r["trip_key"]: r for r in maps.gold_maps_trips(spark, cfg).collect()}
    assert set(gold) == {k_rome} and gold[k_rome]["title"] == "Roman holiday"
    put_rows(cfg, "maps_trip_labels", [{"trip_key": k_milan, "label": "confirm"},
                                       {"trip_key": k_rome, "label": "edit", "edited_title": "Rome 2025"}],
             ingested_at=AS_OF + dt.timedelta(seconds=5))
    gold = {r["trip_key"]: r for r in maps.gold_maps_trips(spark, cfg).collect()}
    assert set(gold) == {k_rome, k_milan}                    # confirm overrides the negative verdict
    assert gold[k_rome]["title"] == "Rome 2025" and gold[k_rome]["destination"] == "Roma"
    assert gold[k_milan]["title"] == "Layover"
    put_rows(cfg, "maps_trip_labels", [{"trip_key": k_rome, "label": "reject"}],
             ingested_at=AS_OF + dt.timedelta(seconds=9))
    assert {r["trip_key"] for r in maps.gold_maps_trips(spark, cfg).collect()} == {k_milan}
    kp = maps.gold_maps_kpis_dashboard(spark, cfg).first()
    assert kp["cities_visited"] == 3 and kp["countries_visited"] == 2 and kp["home_locality"] == "Paris"
    assert kp["longest_trip_days"] == 1 and kp["new_places_this_year"] == 1
    hourly = maps.gold_maps_hourly_activity_dashboard(spark, cfg).collect()
    assert len(hourly) == 24 and hourly[10]["activities"] > 0
    dest = maps.gold_maps_destinations_dashboard(spark, cfg).collect()
    assert dest[0]["destination"] == "Paris"
    assert maps.gold_maps_recent_activities(spark, cfg).count() == 10
    locs = {r["name"] for r in maps.gold_maps_locations_dashboard(spark, cfg).collect()}
    assert "Paris" in locs and "Milan" in locs


def test_daily_series_from_written_sums(spark, cfg, put_rows):
    """The trip job writes the sums per day and place; series and home follow
    from them as from the activity itself."""
    _catalog(cfg, put_rows)
    _activity(cfg, put_rows)
    days = maps.place_days(spark, cfg).localCheckpoint()
    got = maps.silver_geo_daily(spark, cfg, days=days)
    want = maps.silver_geo_daily(spark, cfg)
    assert got.collect() == want.collect() and got.count() > 0
    home = maps.silver_home_base(spark, cfg).first()
    assert {tuple(r) for r in got.select(*home.asDict()).distinct().collect()} == {tuple(home)}
    assert "Parquet" not in got._jdf.queryExecution().executedPlan().toString()


def test_queries_read_written_silver(spark, cfg, put_rows, monkeypatch):
    """The registered query writes the long silver chains first: its own plan holds
    no search for private places (in the driver it was there once a reading),
    and its rows are those of the model in one plan."""
    import __spark_entry__
    from daybook.plans.registry import MODELS
    _catalog(cfg, put_rows)
    _activity(cfg, put_rows)
    put_rows(cfg, "maps_private_places", [{"lat": ROME[0], "lng": ROME[1], "radius_m": 500}])
    at = [AS_OF - dt.timedelta(days=d) for d in (3, 2, 1)]
    put_rows(cfg, "spotify_plays_raw", [{"played_at": t, "track_id": f"t{i % 2}", "duration_ms": 1000 * i,
                                         "artists_ids": ["a1"], "artists_names": ["A"]} for i, t in enumerate(at)])
    put_rows(cfg, "spotify_artists", [{"artist_id": "a1", "artist_name": "Artist"}])
    put_rows(cfg, "youtube_watch_history", [{"watched_at": t, "video_id": "v1", "channel_id": "c1"} for t in at])
    monkeypatch.setattr("daybook.plans.standin.standin_warehouse", lambda spark, sf_dir: cfg)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    found = __spark_entry__.queries()
    for name in ("gold_home_recent_events", "gold_maps_destinations_dashboard"):
        got, want = found[f"model_{name}"](spark, "unused"), MODELS[name](spark, cfg)
        assert "ASIN(" in plan(want) and "ASIN(" not in plan(got), name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != [], name
        assert got.dtypes == want.dtypes, name
