"""The stand-in warehouse: a model query writes the tables that its model
reads, each whole, and no others."""

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

import __spark_entry__
from daybook.plans import standin
from daybook.plans.registry import build_landed, tables_of


@pytest.fixture()
def driver_tables(spark, tmp_path):
    """Small driver tables, written to two folders: each has a warehouse of its own."""
    t0 = dt.datetime(2024, 1, 3, 10)
    kinds = ("view", "click", "purchase", "signup", "error")
    rows = {
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
                   [(i, t0 + dt.timedelta(hours=5 * i), i % 4, kinds[i % 5], float(7 * i % 200), f'{{"k": {i % 6}}}')
                    for i in range(120)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"part {i}", "b", "t", 3 * i, 1.0) for i in range(6)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"customer {i}", 0, 100.0 * i, "AUTO") for i in range(4)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
                     [(i, f"supplier {i}", i % 2, 50.0 + i) for i in range(6)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "ITALY", 0), (1, "JAPAN", 1)]),
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE"), (1, "ASIA")])}
    dirs = [str(tmp_path / x) for x in ("one", "two")]
    for name, (ddl, values) in rows.items():
        for d in dirs:
            spark.createDataFrame(values, T._parse_datatype_string(ddl)).write.parquet(f"{d}/{name}.parquet")
    return dirs


def _written(spark, d):
    root = standin._BUILT[(d, standin.ensure_checkpoint_dir(spark).rstrip("/"))][0].root.removeprefix("file:")
    return {f"{layer}/{t}": sorted(os.listdir(f"{root}/{layer}/{t}")) for layer in os.listdir(root) for t in os.listdir(f"{root}/{layer}")}


def test_a_model_query_writes_the_tables_that_it_reads(spark, driver_tables):
    """F5-F10, F12, F13, F16, F19-F22: all thirteen tables and the trip job went
    through the driver for every model, a calendar histogram too."""
    one, two = driver_tables
    found = __spark_entry__.queries()
    standin.standin_warehouse(spark, two)
    names = {t.split("/")[1] for t in _written(spark, two)}
    assert names == set(standin._frames(spark, two)) | {"maps_trips"}
    had = {}
    for name, new in (("gold_calendar_kpis", {"calendar_events"}), ("gold_spotify_current_track", {"spotify_player_current"}),
                      ("gold_maps_hourly_activity_dashboard", {"maps_activity", "maps_place_catalog", "maps_private_places"}),
                      ("gold_maps_trips", {"maps_trips"}), ("gold_calendar_categories", set())):
        got = found[f"model_{name}"](spark, one)
        now = _written(spark, one)
        assert {t.split("/")[1] for t in set(now) - set(had)} == new, name
        assert {t: now[t] for t in had} == had, name               # written once
        had = now
        want = found[f"model_{name}"](spark, two)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), name
    assert found["model_gold_calendar_kpis"](spark, one).first()[0] > 0


def test_the_rest_of_the_warehouse_follows(spark, driver_tables):
    """Queries over the whole warehouse get every table, whatever was written before."""
    one, two = driver_tables
    __spark_entry__.queries()["model_gold_maps_trips"](spark, one)
    assert {t.split("/")[1] for t in _written(spark, one)} == {"maps_activity", "maps_place_catalog", "maps_private_places", "maps_trips"}
    a, b = (standin.standin_warehouse(spark, d) for d in (one, two))
    assert set(_written(spark, one)) == set(_written(spark, two))
    for name in ("silver_events_unified", "gold_home_overview_stats"):
        got, want = (sorted(map(str, build_landed(spark, c, name).collect())) for c in (a, b))
        assert got == want != [], name


def test_tables_are_noted_without_jobs(spark):
    spark.sparkContext.setJobGroup("tables-of", "tables")
    assert "maps_trips" in tables_of(spark, "gold_home_overview_stats")
    assert tables_of(spark, "silver_youtube_searches") == {"youtube_search_history"}
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("tables-of") == []
