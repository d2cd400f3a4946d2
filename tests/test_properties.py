"""Property tests against plain-Python references."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions.timefn import readable_delta
from daybook.operators.versioned import latest_by_version


def _readable(s: int) -> str:
    if s <= 0:
        return "0 seconds"
    parts = []
    for size, word in ((365 * 86400, "year"), (2635200, "month"), (86400, "day"), (3600, "hour"), (60, "minute"),
                       (1, "second")):
        n, s = divmod(s, size)
        if n:
            parts.append(f"{n} {word}{'' if n == 1 else 's'}")
    return parts[0] if len(parts) == 1 else ", ".join(parts[:-1]) + " and " + parts[-1]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10 ** 10), min_size=1, max_size=40))
def test_readable_delta_matches_reference(spark, secs):
    got = [r[0] for r in spark.createDataFrame([(s,) for s in secs], "s long")
           .select(readable_delta(F.col("s"))).collect()]
    assert got == [_readable(s) for s in secs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 5), st.text("xyz", max_size=2)),
                min_size=1, max_size=60))
def test_latest_by_version_matches_reference(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, t int, p string")
    got = {r["k"]: tuple(r) for r in latest_by_version(df, ["k"], "v", tiebreak=["t"]).collect()}
    want = {}
    for r in rows:   # greatest (version, tiebreak, rest) per key
        if r[0] not in want or (r[1], r[2], r[3]) > (want[r[0]][1], want[r[0]][2], want[r[0]][3]):
            want[r[0]] = r
    assert got == want
