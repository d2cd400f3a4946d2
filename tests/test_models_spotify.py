"""Spotify models on hand-made bronze rows (FIXTURES.md edge rows)."""

import datetime as dt

from daybook.plans import spotify

AS_OF = dt.datetime(2025, 6, 30, 12, 0, 0)


def _catalog(cfg, put_rows):
    put_rows(cfg, "spotify_tracks", [
        {"track_id": "t1", "track_name": "Catalog One", "duration_ms": 200000, "album_name": "Alb",
         "album_images": ["img1"], "artists_ids": ["a1"]},
        {"track_id": "t2", "track_name": "", "duration_ms": 0, "artists_ids": ["a2"]},
    ])
    put_rows(cfg, "spotify_artists", [{"artist_id": "a1", "artist_name": "Artist One", "genres": ["rock", "pop"]},
                                      {"artist_id": "a2", "artist_name": "Artist Two", "genres": ["jazz"]}])


def test_silver_plays_fallbacks(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    put_rows(cfg, "spotify_plays_raw", [
        {"played_at": AS_OF - dt.timedelta(hours=3), "track_id": "t1", "track_name": "payload", "duration_ms": 1},
        {"played_at": AS_OF - dt.timedelta(hours=2), "track_id": "t2", "track_name": "Payload Two", "duration_ms": 90000,
         "artists_names": ["P2"], "album_images": ["pimg"]},
        {"played_at": AS_OF - dt.timedelta(hours=1), "track_id": "tx", "track_name": "Unknown", "duration_ms": 5000,
         "artists_ids": ["ax"], "artists_names": ["PX"]},
    ])
    # a second, newer version of the first play must not duplicate it
    put_rows(cfg, "spotify_plays_raw", [{"played_at": AS_OF - dt.timedelta(hours=3), "track_id": "t1",
                                         "track_name": "payload v2", "duration_ms": 1}],
             ingested_at=AS_OF + dt.timedelta(seconds=1))
    rows = {r["track_id"]: r for r in spotify.silver_spotify_plays(spark, cfg).collect()}
    assert len(rows) == 3
    assert rows["t1"]["track_name"] == "Catalog One" and rows["t1"]["duration_ms"] == 200000
    assert rows["t1"]["primary_artist_id"] == "a1" and rows["t1"]["genres"] == ["rock", "pop"]
    assert rows["t2"]["track_name"] == "Payload Two" and rows["t2"]["duration_ms"] == 90000
    assert rows["t2"]["primary_artist_id"] == "a2" and rows["t2"]["primary_artist_name"] == "Artist Two"
    assert rows["t2"]["album_art_url"] == "pimg"
    assert rows["tx"]["primary_artist_name"] == "PX" and rows["tx"]["genres"] == []


def _stream(cfg, put_rows, events):
    put_rows(cfg, "spotify_player_current", [
        {"captured_at": ts, "track_id": tid, "track_name": tid.upper(), "track_duration_ms": dur, "is_playing": True}
        for ts, tid, dur in events])


def test_merge_rules(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    T = AS_OF - dt.timedelta(minutes=30)
    put_rows(cfg, "spotify_plays_raw", [{"played_at": T, "track_id": "t1", "duration_ms": 200000}])
    s = lambda m: T + dt.timedelta(seconds=m)
    _stream(cfg, put_rows, [
        (s(-200), "t1", 200000),   # stream copy of T ends at T+3 s (next change) -> dropped by the ±120 s guard
        (s(3), "t2", 180000),      # a play after T -> kept; ends at its clamp (start + 180 s + 15 s)
        (s(603), "t1", 200000),    # genuine replay 10 min after T, ends at clamp -> kept
        (s(1000), "t3", 0),        # unknown duration, open tail ends at as_of
    ])
    merged = spotify.silver_spotify_plays_merged(spark, cfg).collect()
    stream_rows = sorted((r["track_id"], r["played_at"]) for r in merged if r["played_at"] > T)
    assert stream_rows == [("t1", s(603 + 200 + 15)), ("t2", s(3 + 180 + 15)), ("t3", AS_OF)]
    assert sum(1 for r in merged if r["played_at"] <= T) == 1


def test_merge_cold_start(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    _stream(cfg, put_rows, [(AS_OF - dt.timedelta(minutes=5), "t1", 200000)])
    assert spotify.silver_spotify_plays_merged(spark, cfg).count() == 0   # empty history disables the stream


def test_gold_spotify(spark, cfg, put_rows):
    _catalog(cfg, put_rows)
    plays = [{"played_at": AS_OF - dt.timedelta(days=d, hours=1), "track_id": "t1", "duration_ms": 200000}
             for d in range(0, 40, 3)]
    put_rows(cfg, "spotify_plays_raw", plays)
    dl = spotify.gold_spotify_daily_listening(spark, cfg).collect()
    assert len(dl) == 10 and all(r["hours"] == 0.1 for r in dl)
    top = spotify.gold_spotify_top_artists(spark, cfg).collect()
    assert top[0]["name"] == "Artist One" and top[0]["plays"] == 14
    n_weeks = (AS_OF.date() - cfg.kpi_start_date).days // 7 + 1
    assert len(top[0]["trend"]) == n_weeks and sum(top[0]["trend"]) == 14
    g = {r["name"]: r["value"] for r in spotify.gold_spotify_genres(spark, cfg).collect()}
    assert g == {"rock": 14, "pop": 14}
    k = spotify.gold_spotify_kpis_dashboard(spark, cfg).first()
    assert k["songs_streamed"] == "1" and k["total_time"] == "0.8 hrs"
    assert spotify.gold_spotify_kpis_summary(spark, cfg).first()["artists"] == 1
    assert spotify.gold_spotify_recent_tracks(spark, cfg).count() == 14


def test_current_track(spark, cfg, put_rows):
    put_rows(cfg, "spotify_player_current", [
        {"captured_at": AS_OF - dt.timedelta(minutes=2), "track_id": "old", "artists_ids": ["x"]},
        {"captured_at": AS_OF - dt.timedelta(minutes=1), "track_id": "new", "artists_ids": ["a9"], "artists_names": ["N"]}])
    r = spotify.gold_spotify_current_track(spark, cfg).first()
    assert r["track_id"] == "new" and r["artist_uri"] == "spotify:artist:a9" and r["artist_name"] == "N"


def test_catalogs_are_shuffled_not_collected_by_the_driver(spark, cfg, put_rows):
    """A catalog's files are much smaller than its rows in the driver's memory."""
    put_rows(cfg, "spotify_plays_raw", [{"played_at": dt.datetime(2025, 6, 1, 10), "track_id": "t1", "artists_ids": ["a1"]}])
    put_rows(cfg, "spotify_tracks", [{"track_id": "t1", "track_name": "One", "duration_ms": 1000}])
    put_rows(cfg, "spotify_artists", [{"artist_id": "a1", "artist_name": "A"}])
    put_rows(cfg, "spotify_saved_tracks", [{"added_at": dt.datetime(2025, 6, 1, 10), "track_id": "t1"}])
    plays = spotify.silver_spotify_plays(spark, cfg)
    assert [(r.track_name, r.primary_artist_name) for r in plays.collect()] == [("One", "A")]
    for df in (plays, spotify.silver_spotify_saved(spark, cfg)):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
