"""Operators against brute-force reference computations on small inputs."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from daybook.operators.islands import island_runs, run_mode
from daybook.operators.joins import band_anti_join, overlap_join, within_radius_flag
from daybook.operators.segments import dwell_segments, transitions
from daybook.operators.topn import top_n_plus_other
from daybook.operators.versioned import latest_by_version

D0 = dt.date(2024, 1, 1)
T0 = dt.datetime(2024, 1, 1)


def test_latest_by_version_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "p"), ("b", 5, "q")], "k string, v int, p string")
    got = {r["k"]: (r["v"], r["p"]) for r in latest_by_version(df, ["k"], "v").collect()}
    assert got == {"a": (2, "y"), "b": (5, "q")}


def test_overlap_join_matches_brute_force(spark):
    rnd = random.Random(1)
    left = [(i, D0 + dt.timedelta(days=rnd.randint(0, 60)), rnd.randint(0, 10)) for i in range(60)]
    left = [(i, s, s + dt.timedelta(days=n)) for i, s, n in left]
    right = [(j, D0 + dt.timedelta(days=rnd.randint(-5, 70)), rnd.randint(0, 6)) for j in range(300)]
    right = [(j, s, s + dt.timedelta(days=n)) for j, s, n in right]
    L = spark.createDataFrame(left, "i int, ls date, le date")
    R = spark.createDataFrame(right, "j int, rs date, re date")
    want = {(i, j) for i, ls, le in left for j, rs, re in right if rs <= le and re >= ls}
    for salt in (1, 3):
        got = {(r["i"], r["j"]) for r in overlap_join(L, R, "ls", "le", "rs", "re", salt=salt).collect()}
        assert got == want
    lj = overlap_join(L, R.filter("j < 3"), "ls", "le", "rs", "re", how="left")
    assert {r["i"] for r in lj.collect()} == {i for i, _, _ in left}


def test_band_anti_join_matches_brute_force(spark):
    rnd = random.Random(2)
    hist = [("k%d" % rnd.randint(0, 3), T0 + dt.timedelta(seconds=rnd.randint(0, 3000))) for _ in range(80)]
    strm = [(n, "k%d" % rnd.randint(0, 3), T0 + dt.timedelta(seconds=rnd.randint(0, 3000))) for n in range(120)]
    H = spark.createDataFrame(hist, "k string, ts timestamp")
    S = spark.createDataFrame(strm, "n int, k string, ts timestamp")
    want = {n for n, k, t in strm if not any(hk == k and abs((ht - t).total_seconds()) <= 120 for hk, ht in hist)}
    got = {r["n"] for r in band_anti_join(S, H, ["k"], "ts", "ts", 120).collect()}
    assert got == want


def _hav_m(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(x)) * 1000


def test_within_radius_grid_matches_brute_force(spark):
    rnd = random.Random(3)
    places = [(rnd.uniform(-85, 85), rnd.uniform(-180, 180), rnd.choice([100, 5000, 300000])) for _ in range(40)]
    places += [(89.9, 10.0, 50000), (0.0, 179.999, 20000)]       # polar cap, date line
    pts = []
    for i in range(400):
        if i % 2 and places:
            la, lo, r = rnd.choice(places)
            pts.append((i, la + rnd.uniform(-1, 1) * r / 111000, lo + rnd.uniform(-1, 1) * r / 80000))
        else:
            pts.append((i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)))
    pts += [(1000, 0.0, 0.0), (1001, 89.95, -170.0), (1002, 0.0, -179.999)]
    pts = [(i, la, ((lo + 180) % 360) - 180) for i, la, lo in pts]
    P = spark.createDataFrame(places, "lat double, lng double, radius_m int")
    Q = spark.createDataFrame(pts, "id int, lat double, lng double")
    want = {i: int(not (la == 0 and lo == 0) and any(_hav_m(la, lo, a, b) <= r for a, b, r in places))
            for i, la, lo in pts}
    got = {r["id"]: r["is_private"] for r in within_radius_flag(Q, P, "lat", "lng").collect()}
    assert got == want
    empty = within_radius_flag(Q, P.limit(0), "lat", "lng")
    assert empty.agg(F.sum("is_private")).first()[0] == 0


def test_within_radius_cells_are_not_collected_by_the_driver(spark, tmp_path):
    """Copies of places by cell grow beyond what Spark expects of the table, so
    they meet the positions in a shuffle, whatever the size it expects."""
    spark.createDataFrame([(float(i % 80), float(i % 170), 300) for i in range(50)],
                          "lat double, lng double, radius_m int").write.parquet(f"{tmp_path}/places")
    P = spark.read.parquet(f"{tmp_path}/places")  # files, whose size Spark knows
    Q = spark.createDataFrame([(i, float(i % 90), float(i % 170)) for i in range(200)], "id int, lat double, lng double")
    out = within_radius_flag(Q, P, "lat", "lng")
    got = {r["id"] for r in out.filter("is_private = 1").collect()}
    near = {(i % 80, i % 170) for i in range(50)}
    assert got == {i for i in range(200) if (i % 90, i % 170) in near and (i % 90, i % 170) != (0, 0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    assert not [x for x in plan.splitlines() if "Broadcast" in x and "LeftSemi" in x]


def test_islands_and_mode(spark):
    days = [D0 + dt.timedelta(days=d) for d in (0, 1, 4, 9, 10, 14)]   # gaps: 3 (same), 5 (split), 4 (same)
    df = spark.createDataFrame([("u", d, loc) for d, loc in zip(days, ["A", "B", "B", "C", "C", "A"])],
                               "u string, day date, loc string")
    r = island_runs(df, ["u"], "day", 3)
    runs = {row["day"]: row["run_id"] for row in r.collect()}
    assert [runs[d] for d in days] == [1, 1, 1, 2, 2, 2]
    m = {row["run_id"]: row["mode"] for row in run_mode(r, ["u", "run_id"], "loc", "day").collect()}
    assert m == {1: "B", 2: "C"}
    tie = spark.createDataFrame([("u", 1, D0 + dt.timedelta(days=1), "Z"), ("u", 1, D0, "Y")],
                                "u string, run_id long, day date, loc string")
    assert run_mode(tie, ["u", "run_id"], "loc", "day").first()["mode"] == "Y"   # first seen wins


def test_transitions(spark):
    rows = [("d", T0 + dt.timedelta(seconds=i), t, p) for i, (t, p) in
            enumerate([("a", True), ("a", True), ("a", False), ("b", False), ("b", False)])]
    df = spark.createDataFrame(rows, "dev string, ts timestamp, track string, playing boolean")
    got = [(r["track"], r["playing"]) for r in transitions(df, ["dev"], "ts", ["track", "playing"]).orderBy("ts").collect()]
    assert got == [("a", True), ("a", False), ("b", False)]


def test_dwell_segments_edge_cases(spark):
    s = lambda n: T0 + dt.timedelta(seconds=n)
    rows = [
        (s(0), "A", 200000), (s(60), "A", 200000),      # pause/resume folds into one segment
        (s(120), "B", 180000),                          # 5 s skip -> dropped
        (s(125), "", 0),                                # empty id never starts a segment
        (s(126), "C", 10000),                           # ends at clamp start+10+15 s = 25 s -> dropped (<30)
        (s(400), "D", 60000), (s(400), "E", 60000),     # same instant: ordered by id
        (s(1000), "F", 100000),                         # open tail, clamped to +115 s
    ]
    df = spark.createDataFrame([("u",) + r for r in rows], "u string, ts timestamp, track string, dur long")
    as_of = T0 + dt.timedelta(seconds=1050)
    got = {r["track"]: (r["ts"], r["played_at"]) for r in
           dwell_segments(df, ["u"], "ts", "track", "dur", as_of).collect()}
    assert set(got) == {"A", "C", "E", "F"} - {"C"} | {"E"}
    assert got["A"] == (s(0), s(120))
    assert got["E"] == (s(400), s(475))          # clamp 60 s + 15 s
    assert got["F"] == (s(1000), as_of)          # open tail ends at as_of (shorter than the track)


def test_top_n_plus_other(spark):
    c = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1)], "name string, value long")
    got = {r["name"]: r["value"] for r in top_n_plus_other(c, "name", "value", 2).collect()}
    assert got == {"a": 5, "b": 4, "Other": 5}


def test_chunked_scans_match_plain_windows(spark):
    """The two-level (chunked) lag/lead gives the same result as one window
    per entity, also when one entity holds most rows and chunks are sparse."""
    rnd = random.Random(5)
    rows = []
    for n in range(600):
        user = "hot" if n % 3 else "u%d" % rnd.randint(0, 4)
        rows.append((user, T0 + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)), rnd.choice("ab"),
                     rnd.choice([0, 20000, 200000])))
    df = spark.createDataFrame(rows, "u string, ts timestamp, track string, dur long")
    as_of = T0 + dt.timedelta(days=6)
    day = F.to_date("ts")
    key = lambda d: sorted(tuple(r) for r in d.collect())
    assert key(transitions(df, ["u"], "ts", ["track"], chunk=day)) == key(transitions(df, ["u"], "ts", ["track"]))
    assert key(dwell_segments(df, ["u"], "ts", "track", "dur", as_of, chunk=F.date_trunc("hour", "ts"))) == \
        key(dwell_segments(df, ["u"], "ts", "track", "dur", as_of))


def test_within_radius_of_crowded_cells(spark):
    rnd = random.Random(8)
    places = [(48.0 + rnd.uniform(-0.01, 0.01), 2.0 + rnd.uniform(-0.01, 0.01), 300) for _ in range(60)]
    pts = [(i, 48.0 + rnd.uniform(-0.02, 0.02), 2.0 + rnd.uniform(-0.02, 0.02)) for i in range(300)]
    P = spark.createDataFrame(places, "lat double, lng double, radius_m int")
    Q = spark.createDataFrame(pts, "id int, lat double, lng double")
    got = {r["id"]: r["is_private"] for r in within_radius_flag(Q, P, "lat", "lng").collect()}
    want = {i: int(any(_hav_m(la, lo, a, b) <= r for a, b, r in places)) for i, la, lo in pts}
    assert got == want and 0 < sum(want.values()) < len(want)


def test_attached_row_is_in_the_plan_once(spark):
    """Nested rows would double the driver's plan at each level."""
    from daybook.operators.merge import attach_scalar
    df = spark.range(3).withColumn("g", F.col("id") % 2)
    inner = attach_scalar(df.agg(F.max("id").alias("m")), df.agg(F.min("id").alias("n")))
    out = attach_scalar(df, inner.withColumn("none", F.lit(None).cast("string")))
    assert sorted(map(tuple, out.collect())) == [(0, 0, 2, 0, None), (1, 1, 2, 0, None), (2, 0, 2, 0, None)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery#") == 2
    assert attach_scalar(df, df.filter("id > 5").select("id").withColumnRenamed("id", "no").limit(1)).count() == 0
    nothing = attach_scalar(df, df.agg(F.max(F.when(F.col("id") > 5, F.col("id"))).alias("top")))
    assert [r.top for r in nothing.collect()] == [None, None, None]
