"""Stream health over restarts, late re-ingest, restore by checksums, archives in zips."""

import datetime as dt
import json
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from daybook.jobs import imports
from daybook.sources import snapshot
from daybook.streaming import health, now_playing
from tests.test_streaming_and_io import GOOD


def _messages(folder, name, good, bad):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as f:
        for i in range(good):
            f.write(json.dumps({**GOOD, "track_id": f"{name}{i}"}) + "\n")
        f.write("".join(b + "\n" for b in bad))


def test_health_survives_restarts_and_failures(spark, cfg, monkeypatch):
    base = tempfile.mkdtemp(prefix="health-")
    src, ck = base + "/in", base + "/ck"
    assert health.totals(spark, ck + "_health").first()["polls"] == 0
    _messages(src, "a", 3, ["not json", json.dumps({**GOOD, "progress_ms": "x"})])
    now_playing.run(spark, cfg, src, ck)
    first = health.totals(spark, ck + "_health").first()
    assert (first.ok, first.rejected, first.batches) == (3, 2, 1) and first.polls >= 1
    assert first.rejects == {"not a JSON object": 1, "is not of type": 1} and not first.errors

    _messages(src, "b", 2, [])
    with monkeypatch.context() as m:
        m.setattr(now_playing, "parse_valid", lambda *a, **k: (_ for _ in ()).throw(ConnectionError("sink away")))
        with pytest.raises(Exception):
            now_playing.run(spark, cfg, src, ck)
    failed = health.totals(spark, ck + "_health").first()
    assert failed.ok == 3 and sum(failed.errors.values()) == 1 and "ConnectionError" in failed.errors

    now_playing.run(spark, cfg, src, ck)  # the batch is retried
    now_playing.run(spark, cfg, src, ck)  # nothing new
    last = health.totals(spark, ck + "_health").first()
    assert (last.ok, last.rejected) == (5, 2) and sum(last.errors.values()) == 1 and last.runs >= 2
    assert last.last_ok == first.last_ok is not None


def test_error_kinds():
    assert health.error_kind("org.apache.spark.X: foo\nTraceback (most recent call last):\nValueError: bad") == "ValueError"
    assert health.error_kind("java.io.IOException: disk") == "IOException"
    assert health.error_kind("gone") == "unknown"


def _events(spark, days, extra=()):
    t0 = dt.datetime(2025, 3, 1)
    rows = [(d * 10 + i, t0 + dt.timedelta(days=d, hours=5 * i)) for d in range(days) for i in range(4)] + list(extra)
    return spark.createDataFrame(rows, "id int, ts timestamp")


def test_a_missed_fortnight_is_made_up(spark):
    base = tempfile.mkdtemp(prefix="ledger-")
    at = lambda d: dt.datetime(2025, 3, 1, 23, 59) + dt.timedelta(days=d)
    go = lambda e, d: imports.ingest_dates(spark, e, "ts", "src", base + "/t", base + "/ledger", at(d))
    seen = lambda: sorted((r.id, str(r.event_date)) for r in spark.read.parquet(base + "/t").collect())
    want = lambda e, d: sorted((r.id, str(r.ts.date())) for r in e.collect() if r.ts and r.ts <= at(d))
    assert imports.high_water(spark, base + "/ledger", "src") is None
    short = _events(spark, 5, [(999, None)])
    assert go(short, 3) is None and seen() == want(short, 3)
    late = _events(spark, 22, [(500, dt.datetime(2025, 3, 3, 1)), (501, dt.datetime(2025, 3, 4, 1))])
    assert go(late, 20) == dt.date(2025, 3, 1)  # from the mark, not from a fixed window
    assert seen() == want(late, 20)
    assert go(late, 20) == dt.date(2025, 3, 18) and seen() == want(late, 20)  # a rerun changes nothing
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(base + "/t") for f in fs if "2025-03-10" in d}
    go(late, 21)
    assert before == {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(base + "/t") for f in fs if "2025-03-10" in d}
    assert imports.high_water(spark, base + "/ledger", "other") is None


def test_restore_reads_what_differs(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="sums-")
    rows = [(i % 50, f"v{i % 7}", [i % 3], {"k": i % 2}) for i in range(400)] + [(None, None, None, None)] * 2
    df = spark.createDataFrame(rows, "k int, v string, a array<int>, m map<string,int>")
    manifest = snapshot.snapshot(spark, {"t": df}, base + "/snap", dt.date(2025, 6, 1))
    sums = manifest["tables"]["t"]["sums"]
    assert manifest["tables"]["t"]["rows"] == 402 and sums == snapshot.checksums(df.repartition(7)) and len(sums) > 10
    target = lambda n: f"{base}/out/{n}"
    seen = lambda: sorted(map(str, spark.read.schema(df.schema).parquet(base + "/out/t").collect()))
    assert snapshot.restore(spark, base + "/snap", target) == {"t": 402}
    whole = seen()
    with monkeypatch.context() as m:  # an untouched target is not read
        m.setattr(snapshot, "checksums", None)
        m.setattr(snapshot, "read_snapshot", None)
        assert snapshot.restore(spark, base + "/snap", target) == {"t": 0}
    # a target that lost some rows and has others of its own gets the lost ones back
    held = df.filter("k IS NULL OR k < 40").unionByName(spark.createDataFrame([(77, "own", [1], {"k": 9})], df.schema))
    rows = held.collect()
    spark.createDataFrame(rows, df.schema).write.mode("overwrite").parquet(base + "/out/t")
    assert snapshot.restore(spark, base + "/snap", target) == {"t": 80}
    assert seen() == sorted([*whole, str(rows[-1])])
    assert snapshot.restore(spark, base + "/snap", target) == {"t": 0}


def test_archive_import_takes_zips(spark, cfg):
    root = tempfile.mkdtemp(prefix="takeout-")
    entry = lambda **k: {"header": "YouTube", "time": "2025-06-01T11:00:00Z", **k}
    maps = [entry(header="Maps", title="Searched for pizza", titleUrl="https://www.google.com/maps/search/pizza")]
    watch = [entry(title="Watched X", titleUrl="https://www.youtube.com/watch?v=abcdefghijk")]
    search = [entry(title="Searched for cats"), entry(title="neither")]
    with zipfile.ZipFile(root + "/one.zip", "w") as z:
        z.writestr("Takeout/YouTube/watch.json", json.dumps(watch))
        z.writestr("Takeout/Maps/MyActivity.json", json.dumps(maps))
        z.writestr("Takeout/readme.html", "<p>no</p>")
    with open(root + "/two.zip", "w") as f:
        f.write("not a zip")
    with open(root + "/search.json", "w") as f:
        json.dump(search, f)
    got = imports.import_google_archive(spark, cfg, root)
    assert got["maps"] == 1 and got["watches"] == 1 and got["searches"] >= 1
    landed = spark.read.parquet(cfg.table_path("bronze", "youtube_watch_history"))
    assert [r.video_id for r in landed.select(F.col("video_id")).collect()] == ["abcdefghijk"]
