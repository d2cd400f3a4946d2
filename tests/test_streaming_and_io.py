"""Stream contract / routing / landing, transition state, snapshots and
record normalisers."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from daybook.sources import google, spotify as spsrc, snapshot
from daybook.streaming import now_playing
from daybook.sources.tables import read_table

AS_OF = dt.datetime(2025, 6, 30, 12, 0, 0)

GOOD = {"captured_at": "2025-06-30 11:00:00.123", "track_id": "t1", "track_name": "Song", "track_uri": "spotify:track:t1",
        "track_duration_ms": 200000, "progress_ms": 1000, "is_playing": True, "album_id": "al", "album_name": "Album",
        "album_uri": "spotify:album:al", "album_images": ["u1"], "artists_ids": ["a1"], "artists_names": ["A"],
        "device_id": "d1", "device_name": "Phone", "device_type": "Smartphone", "device_volume_percent": 50,
        "context_type": "playlist", "context_uri": "spotify:playlist:p"}


def _mutations():
    out = {}
    m = dict(GOOD); m["trackId"] = m.pop("track_id"); out["renamed"] = m
    m = dict(GOOD); m["captured_at"] = "2025-06-30T11:00:00.000Z"; out["iso_ts"] = m
    m = dict(GOOD); m["track_duration_ms"] = "200000"; out["retyped"] = m
    m = dict(GOOD); m["brand_new_field"] = 1; out["extra"] = m
    m = dict(GOOD); del m["is_playing"]; out["missing"] = m
    m = dict(GOOD); m["progress_ms"] = 2 ** 31; out["int32"] = m
    return {k: json.dumps(v) for k, v in out.items()} | {"good": json.dumps(GOOD), "not_object": "[1, 2]"}


def test_contract_rejects_each_mutation(spark):
    msgs = _mutations()
    df = now_playing.with_errors(spark.createDataFrame(list(msgs.items()), "name string, value string"))
    errs = {r["name"]: r["errors"] for r in df.collect()}
    assert errs["good"] == []
    for name in ("renamed", "iso_ts", "retyped", "extra", "missing", "int32", "not_object"):
        assert errs[name], name
    assert any("unexpected" in e for e in errs["extra"])
    assert any("missing required field is_playing" in e for e in errs["missing"])


def test_stream_routes_ok_and_dlq(spark, cfg):
    src = tempfile.mkdtemp(prefix="np-src-")
    with open(os.path.join(src, "batch1.jsonl"), "w") as f:
        for v in _mutations().values():
            f.write(v + "\n")
    q = now_playing.run(spark, cfg, src, os.path.join(cfg.root, "_ckpt_np"))
    assert sum(c["ok"] for c in q.counters) == 1 and sum(c["rejected"] for c in q.counters) == 7
    landed = read_table(spark, cfg, "spotify_player_current").first()
    assert landed["captured_at"] == dt.datetime(2025, 6, 30, 11, 0, 0, 123000) and landed["track_id"] == "t1"
    dlq = read_table(spark, cfg, "spotify_player_current_dlq")
    assert dlq.count() == 7 and dlq.filter(F.col("topic") == "spotify.player.current").count() == 7
    # a rerun over the same checkpoint processes nothing new
    q2 = now_playing.run(spark, cfg, src, os.path.join(cfg.root, "_ckpt_np"))
    assert sum(c["ok"] + c["rejected"] for c in q2.counters) == 0


def _streamed(spark, make, df, batches, name):
    """Rows of a stream over ``df`` given in ``batches`` (lists of row numbers),
    one after the other, with a restart of the query between them."""
    d = tempfile.mkdtemp(prefix="stream-")
    rows = df.collect()
    for k, batch in enumerate(batches):
        spark.createDataFrame([rows[i] for i in batch], df.schema).coalesce(1).write.mode("append").parquet(d + "/in")
        stream = spark.readStream.schema(df.schema).parquet(d + "/in")
        q = (make(stream).writeStream.format("parquet").option("path", d + "/out").outputMode("append")
             .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(d + "/out")


def test_transition_state_stream(spark):
    """Shuffled rows over several batches give what the ordered batch twin
    gives; the last rows wait for the watermark."""
    import random
    from daybook.operators.segments import transitions
    rnd = random.Random(5)
    t0 = dt.datetime(2025, 6, 30, 10)
    rows = [(f"d{rnd.randrange(3)}", t0 + dt.timedelta(seconds=7 * i), rnd.choice(["a", "b", None]), rnd.random() < 0.5) for i in range(240)]
    rows += [("d9", t0 + dt.timedelta(days=1), "z", True)]  # lets the watermark pass
    df = spark.createDataFrame(rows, "device_id string, captured_at timestamp, track_id string, is_playing boolean")
    # every batch is shuffled, and neighbours in time lie in different batches
    order = sorted(range(240), key=lambda i: i // 80 * 80 + rnd.randrange(-40, 40) + i % 80)
    batches = [order[:90], order[90:170], order[170:], [240]]
    got = _streamed(spark, lambda s: now_playing.transition_filter_stream(s, watermark="15 minutes"), df, batches, "trans")
    want = transitions(df, ["device_id"], "captured_at", ["track_id", "is_playing"], tiebreak=["track_id"])
    rows_of = lambda x: sorted(map(str, x.filter("device_id <> 'd9'").collect()))
    assert rows_of(got) == rows_of(want) and want.count() > 100


def test_snapshot_list_restore_prune(spark):
    root = tempfile.mkdtemp(prefix="snap-")
    t = {"a": spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")}
    m = snapshot.snapshot(spark, t, root, dt.date(2025, 6, 1))
    assert m["tables"]["a"]["rows"] == 2
    os.makedirs(os.path.join(root, "dt=2025-06-20", "a"))      # newer folder without a manifest: incomplete
    snaps = {r["dt"]: r["complete"] for r in snapshot.list_snapshots(spark, root).collect()}
    assert snaps == {"2025-06-01": True, "2025-06-20": False}
    assert snapshot.latest_complete(spark, root) == "2025-06-01"
    out = tempfile.mkdtemp(prefix="restored-")
    done = snapshot.restore(spark, root, lambda name: f"{out}/{name}" if name == "a" else None, tables=["bronze.a"])
    assert done == {"a": 2} and spark.read.parquet(f"{out}/a").count() == 2
    assert snapshot.restore(spark, root, lambda name: f"{out}/{name}", tables=["a"]) == {"a": 0}
    assert spark.read.parquet(f"{out}/a").count() == 2   # no version column, and still not doubled
    try:
        snapshot.restore(spark, root, lambda n: f"{out}/{n}", tables=["missing"])
        raise AssertionError("expected a missing-table error")
    except FileNotFoundError:
        pass
    assert snapshot.prune(spark, root, 0, dt.date(2025, 7, 1)) == []
    assert snapshot.prune(spark, root, 15, dt.date(2025, 7, 1)) == ["2025-06-01"]   # cutoff 2025-06-16


def test_normalisers(spark):
    payload = spark.createDataFrame([{"captured_at": AS_OF, "payload": {
        "is_playing": True, "progress_ms": 5, "item": {"id": "t", "name": "N", "uri": "u", "duration_ms": 10,
                                                       "album": {"id": "al", "images": [{"url": "i1"}, {"url": "i2"}]},
                                                       "artists": [{"id": "a", "name": "A"}]},
        "device": None, "context": None}}, {"captured_at": AS_OF, "payload": {"item": None}}],
        f"captured_at timestamp, payload struct<{spsrc.NOW_PLAYING_DDL.replace(' struct', ':struct').replace('is_playing boolean', 'is_playing:boolean').replace('progress_ms bigint', 'progress_ms:bigint').replace('item struct', 'item:struct')}>")
    rows = spsrc.now_playing_rows(payload).collect()
    assert len(rows) == 1 and rows[0]["album_images"] == ["i1", "i2"] and rows[0]["device_id"] == ""
    hist = spark.createDataFrame([("2025-01-01T10:00:00Z", "spotify:track:abc", "S", "Art", "Alb", 1),
                                  ("2025-01-01T10:00:00Z", "spotify:episode:x", "E", "", "", 1),
                                  (None, "spotify:track:def", "S", "", "", 1)],
                                 "ts string, spotify_track_uri string, master_metadata_track_name string, "
                                 "master_metadata_album_artist_name string, master_metadata_album_album_name string, ms_played long")
    h = spsrc.extended_history_rows(hist).collect()
    assert len(h) == 1 and h[0]["artists_names"] == ["Art"] and h[0]["track_id"] == "abc"
    act = spark.createDataFrame([
        ("Maps", "Searched for ", "https://maps.google.com/?q=Louvre+Museum", "2025-01-01T10:00:00.123Z"),
        ("Maps", "Directions to Gare du Nord", "", "2025-01-01T11:00:00Z"),
        ("YouTube", "Watched x", "", "2025-01-01T11:00:00Z"),
        ("Maps", "Somewhere", "https://www.google.com/maps/place/@1,2/data=!3d48.1!4d2.2", "bad time")],
        "header string, title string, titleUrl string, time string")
    a = google.maps_activity_rows(act).orderBy("event_ts").collect()
    assert [r["activity_type"] for r in a] == ["view_place", "directions"]
    assert a[0]["place_name"] == "Searched for"          # trimmed title no longer has the prefix
    yt = spark.createDataFrame([
        ("Watched Cats", "https://www.youtube.com/watch?v=abcdefghijk", "2025-01-01T10:00:00Z",
         [{"name": "Chan", "url": "https://www.youtube.com/channel/UC1"}], [{"name": "From Google Ads"}]),
        ("Searched for dogs", "https://www.youtube.com/results?search_query=dogs", "2025-01-01T10:00:00Z", None, None)],
        "title string, titleUrl string, time string, subtitles array<struct<name:string,url:string>>, "
        "details array<struct<name:string>>")
    w, s = google.youtube_archive(yt)
    wr = w.first()
    assert (wr["video_title"], wr["channel_id"], wr["is_from_ads"]) == ("Cats", "UC1", True)
    assert s.first()["query"] == "dogs"
    cal = spark.createDataFrame([
        {"id": "e1", "summary": "T", "start": {"date": "2025-01-02"}, "end": {"date": "2025-01-03"}},
        {"id": "e2", "status": "tentative", "summary": "T2", "start": {"dateTime": "2025-01-02T10:00:00+02:00"}}],
        google.CALENDAR_EVENT_DDL)
    c = google.calendar_event_rows(cal, F.lit("cal"), F.lit("Cal")).collect()
    assert len(c) == 1 and c[0]["status"] == "confirmed" and c[0]["started_at"] == dt.datetime(2025, 1, 2)
    star = spark.createDataFrame([{"features": [{"geometry": {"coordinates": ["2.35", "48.85"]}},
                                                {"geometry": {"coordinates": ["0", "0"]}},
                                                {"geometry": {"coordinates": ["x"]}}]}], google.STARRED_DDL)
    st = google.starred_place_rows(star).collect()
    assert [(r["lat"], r["lng"], r["radius_m"]) for r in st] == [(48.85, 2.35, 100)]


def test_tolerant_read_keeps_bad_files(spark):
    from daybook.sources.archive import tolerant_read
    from daybook.sources.google import MY_ACTIVITY_DDL
    d = tempfile.mkdtemp(prefix="tol-")
    with open(os.path.join(d, "good.json"), "w") as f:
        json.dump([{"header": "Maps", "title": "Used Maps", "time": "2025-01-01T00:00:00Z"}], f)
    with open(os.path.join(d, "bad.json"), "w") as f:
        f.write("{not json")
    good, bad = tolerant_read(spark, d, spsrc.schema(MY_ACTIVITY_DDL))
    assert good.count() == 1 and good.first()["title"] == "Used Maps"
    b = bad.collect()
    assert len(b) == 1 and b[0]["_file"].endswith("bad.json") and "{not json" in b[0]["_corrupt_record"]


def test_speed_layer_stream_equals_batch_on_closed_segments(spark):
    import random
    from daybook.operators.segments import dwell_segments
    from daybook.streaming.speed_layer import plays_stream
    rnd = random.Random(11)
    t0 = dt.datetime(2025, 6, 30, 8)
    rows, t = [], t0
    for i in range(300):
        t += dt.timedelta(seconds=rnd.choice([2, 5, 20, 45, 90, 200, 400]))
        rows.append((rnd.choice(["d1", "d2"]), t, rnd.choice(["a", "b", "c", ""]), rnd.choice([0, 30000, 180000])))
    rows.append(("d3", t + dt.timedelta(days=1), "z", 0))
    df = spark.createDataFrame(rows, "device_id string, captured_at timestamp, track_id string, track_duration_ms long")
    order = sorted(range(300), key=lambda i: i + rnd.randrange(-6, 6))
    batches = [order[:120], order[120:200], order[200:], [300]]
    got = {tuple(r) for r in _streamed(spark, lambda s: plays_stream(s, watermark="2 hours", unknown_s=900), df, batches, "speed")
           .filter("device_id <> 'd3'").select("device_id", "track_id", "started_at", "played_at").collect()}
    batch = dwell_segments(df, ["device_id"], "captured_at", "track_id", "track_duration_ms",
                           t + dt.timedelta(days=2), unknown_s=900)
    want = {(r["device_id"], r["track_id"], r["captured_at"], r["played_at"]) for r in batch.collect() if r["device_id"] != "d3"}
    assert want == got and len(want) > 50  # the open tails are closed too


def test_now_playing_end_to_end(spark, cfg):
    """Wire messages → contract → landed bronze → streaming speed layer; the
    closed plays equal the batch speed-layer model over the same table."""
    from daybook.plans.spotify import silver_spotify_plays_stream
    from daybook.schemas import TABLES
    from daybook.streaming.speed_layer import plays_stream
    t0 = cfg.as_of - dt.timedelta(hours=3)
    seq = [("a", 0, 200000), ("a", 60, 200000), ("b", 240, 180000), ("c", 250, 100000), ("d", 600, 0), ("e", 900, 240000),
           ("z", 9000, 0)]
    rows = []
    for tid, sec, dur in seq:
        r = dict(GOOD)
        r.update(track_id=tid, track_duration_ms=dur, device_id="phone")
        rows.append((t0 + dt.timedelta(seconds=sec), r))
    df = spark.createDataFrame([{**r, "captured_at": ts} for ts, r in rows],
                               ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES["spotify_player_current"].schema.fields
                                         if f.name != "_ingested_at"))
    src = tempfile.mkdtemp(prefix="np-e2e-")
    df.select(now_playing.wire_json(df).alias("value")).coalesce(1).write.text(src + "/msgs")
    q = now_playing.run(spark, cfg, src + "/msgs", os.path.join(cfg.root, "_ck_e2e"))
    assert sum(c["ok"] for c in q.counters) == len(seq)
    landed_path = cfg.table_path("bronze", "spotify_player_current")
    stream = spark.readStream.schema(TABLES["spotify_player_current"].schema).parquet(landed_path)
    sq = (plays_stream(stream, watermark="1 minute").writeStream.format("memory").queryName("e2e_plays")
          .outputMode("append").option("checkpointLocation", src + "/ck2").trigger(availableNow=True).start())
    sq.awaitTermination()
    streamed = {(r["track_id"], r["played_at"]) for r in spark.table("e2e_plays").collect()}
    batch = {(r["track_id"], r["played_at"]) for r in silver_spotify_plays_stream(spark, cfg).collect()}
    s = lambda n: t0 + dt.timedelta(seconds=n)
    # 'a' (pause/resume folded) ends at its clamp 200 s + 15 s; 'b' lasted 10 s: dropped;
    # 'd' (unknown duration) ends at the next change; 'e' is the open tail
    closed = {("a", s(200 + 15)), ("c", s(250 + 100 + 15)), ("d", s(900))}
    assert closed <= batch and closed <= streamed and streamed <= batch


def test_warehouse_snapshot_restore_is_idempotent(spark, cfg, put_rows):
    from daybook.config import Cfg
    put_rows(cfg, "youtube_search_history", [{"searched_at": AS_OF, "query": "a"}, {"searched_at": AS_OF, "query": "b"}])
    put_rows(cfg, "youtube_search_history", [{"searched_at": AS_OF, "query": "a"}], ingested_at=AS_OF + dt.timedelta(1))
    put_rows(cfg, "spotify_artists", [{"artist_id": "x", "artist_name": "X"}])
    root = tempfile.mkdtemp(prefix="wh-snap-")
    m = snapshot.snapshot_warehouse(spark, cfg, root, dt.date(2025, 6, 30))
    assert m["tables"]["bronze.youtube_search_history"]["rows"] == 2          # deduplicated state
    os.makedirs(os.path.join(root, "dt=2025-06-30", "bronze.unknown_table"))  # not in the registry: skipped
    fresh = Cfg(as_of=cfg.as_of, root=tempfile.mkdtemp(prefix="wh-new-"))
    done = snapshot.restore_warehouse(spark, fresh, root)
    assert set(done) == {"bronze.youtube_search_history", "bronze.spotify_artists"}
    snapshot.restore_warehouse(spark, fresh, root, tables=["youtube_search_history"])   # bare name, second time
    assert read_table(spark, fresh, "youtube_search_history").count() == 2
    assert read_table(spark, fresh, "spotify_artists").first()["artist_name"] == "X"


def test_zip_members_come_one_at_a_time(spark, tmp_path):
    import io
    import zipfile

    import pandas as pd

    from daybook.sources import archive
    contents = []
    for k in range(3):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for i in range(4):
                z.writestr(f"m{i}.json", f"[{k}, {i}]")
            z.writestr("other.txt", "no")
        contents.append(held.getvalue())
        (tmp_path / f"a{k}.zip").write_bytes(held.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    frames = list(archive._members(".json", iter([pd.DataFrame({"path": ["a", "b", "c"], "content": contents})])))
    assert [len(f) for f in frames] == [1] * 12
    rows = archive.expand_zips(spark, str(tmp_path)).collect()
    assert sorted((r.archive.rsplit("/", 1)[1], r.member, r.text) for r in rows) == sorted(
        [(f"a{k}.zip", f"m{i}.json", f"[{k}, {i}]") for k in range(3) for i in range(4)] + [("bad.zip", "", None)],
        key=lambda x: x[:2])
