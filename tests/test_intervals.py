"""Interval joins against plain comparison."""

import datetime as dt
import random

from pyspark.sql import functions as F

from daybook.operators.intervals import dyadic_overlap_join, length_class, window_sums

DAY0 = dt.date(1969, 11, 20)  # days before the epoch too


def day(n):
    return DAY0 + dt.timedelta(days=n)


def spans(seed, n, longest):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a = rnd.randrange(400)
        out.append((i, day(a), day(a + rnd.choice([0, 1, 3, 7, 8, longest]))))
    return out


def test_length_class(spark):
    got = spark.range(0, 70).select("id", length_class(F.col("id")).alias("k")).collect()
    assert all(r.k == int(r.id).bit_length() for r in got)


def test_overlap_join_matches_comparison(spark):
    left = spans(1, 120, 40) + [(900, None, day(3)), (901, day(5), None), (902, day(-3000), day(9000))]
    right = spans(2, 150, 300) + [(800, day(0), day(0)), (801, None, None), (802, day(10), day(10))] * 2
    L = spark.createDataFrame(left, "i int, a date, b date").withColumn("__cell", F.lit(1))
    R = spark.createDataFrame(right, "j int, c date, d date")
    want = sorted((i, j) for i, a, b in left for j, c, d in right if None not in (a, b, c, d) and c <= b and d >= a)
    for salt in (1, 3):
        assert sorted((r.i, r.j) for r in dyadic_overlap_join(L, R, "a", "b", "c", "d", salt=salt).collect()) == want
    assert dyadic_overlap_join(L.limit(0), R, "a", "b", "c", "d").count() == 0


def test_a_long_interval_multiplies_nothing(spark):
    """Rows copied for the join: twice for each class of the other side."""
    from daybook.operators import intervals
    left = spark.createDataFrame([(i, day(i), day(i + 1)) for i in range(500)], "i int, a date, b date")
    right = spark.createDataFrame([(i, day(i), day(i)) for i in range(500)] + [(-1, day(0), day(4000))], "j int, c date, d date")
    placed = intervals._placed(left, "__l_", "a", "b")
    copies = intervals._copied(placed, "__l_", F.array(F.lit(0), F.lit(12)), ("__kl", "__kr")).count()
    assert copies <= 4 * 500
    assert dyadic_overlap_join(left, right, "a", "b", "c", "d").count() == 500 + 2 * 499 + 1


def test_window_sums_match_adding(spark):
    rnd = random.Random(4)
    points = [(rnd.randrange(5), day(rnd.randrange(200)), rnd.randrange(9)) for _ in range(900)] + [(1, None, 5), (None, day(30), 2)]
    windows = spans(7, 60, 150) + [(99, day(5), day(4)), (98, None, day(3)), (97, day(0), day(199))]
    got = window_sums(spark.createDataFrame(windows, "w int, s date, e date"), "s", "e",
                      spark.createDataFrame(points, "who int, at date, n int"), "at", ["who"], ["n"]).collect()
    want = {}
    for s, e in {(s, e) for _, s, e in windows if s and e}:
        for who, at, n in points:
            if at and s <= at <= e:
                want[s, e, who] = want.get((s, e, who), 0) + n
    assert {(r.s, r.e, r.who): r.n for r in got} == want and len(got) == len(want)
