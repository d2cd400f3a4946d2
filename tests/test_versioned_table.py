"""Latest versions from a table laid out by key."""

import random
import tempfile

from pyspark.sql import functions as F

from daybook.operators.versioned import latest_by_version
from daybook.sources import versioned_table as V

SCHEMA = "k string, part int, v timestamp, x string, tags array<string>"


def rows_of(seed, n):
    import datetime as dt
    rnd = random.Random(seed)
    t0 = dt.datetime(2025, 1, 1)
    out = []
    for i in range(n):
        key = rnd.choice(["hot"] * 5 + ["a", "b", None, "", *map(str, range(20))])
        out.append((key, rnd.choice([1, 2, None]), rnd.choice([None, *(t0 + dt.timedelta(hours=h) for h in range(6))]), f"x{rnd.randrange(4)}",
                    [f"t{i % 3}"]))
    return out


def seen(df):
    return sorted(map(str, df.collect()))


def test_latest_over_several_runs(spark):
    path = tempfile.mkdtemp(prefix="versions-") + "/t"
    V.create(spark, path, SCHEMA, ["k", "part"], "v", 4)
    assert V.latest(spark, path).count() == 0
    every = []
    for run in range(4):
        rows = rows_of(run, 150)
        every += rows
        V.append(spark, path, spark.createDataFrame(rows, SCHEMA))
        got = V.latest(spark, path)
        assert seen(got) == seen(latest_by_version(spark.createDataFrame(every, SCHEMA), ["k", "part"], "v").select(*got.columns))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortAggregate" not in plan and "Bucketed: true" in plan
    assert V.read_versions(spark, path).count() == len(every)


def test_compact_keeps_the_latest(spark):
    base = tempfile.mkdtemp(prefix="versions-")
    V.create(spark, base + "/t", SCHEMA, ["k", "part"], "v", 3)
    for run in range(3):
        V.append(spark, base + "/t", spark.createDataFrame(rows_of(run, 100), SCHEMA))
    want = seen(V.latest(spark, base + "/t"))
    V.compact(spark, base + "/t", base + "/new")
    assert seen(V.latest(spark, base + "/new")) == want == seen(V.read_versions(spark, base + "/new"))


def test_joins_by_key_need_no_exchange_of_the_table(spark):
    base = tempfile.mkdtemp(prefix="versions-")
    V.create(spark, base + "/t", SCHEMA, ["k", "part"], "v", 4)
    V.append(spark, base + "/t", spark.createDataFrame(rows_of(1, 50), SCHEMA))
    counts = V.read_versions(spark, base + "/t").groupBy("k", "part").agg(F.count("*").alias("n"))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
