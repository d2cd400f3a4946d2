"""Column helpers against hand-computed values (SEM-*, STR-*, DAT-*)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from daybook.functions.categories import category_name, kind_label
from daybook.functions.geo import haversine_km
from daybook.functions.maps import classify_title, url_latlng, url_query
from daybook.functions.numeric import fmt_num, pct, quantize_level, safe_div
from daybook.functions.text import (first_nonblank, is_geocodable, join_nonblank, text_key, track_id_from_uri,
                                    truncate_ellipsis, video_id)
from daybook.functions.timefn import age_label, iso_dow, minutes_between, readable_delta, seconds_between
from daybook.sources.google import iso_duration_seconds
from daybook.sources.spotify import release_date


def one(spark, col, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


def test_text_key(spark):
    assert one(spark, text_key(F.col("x")), "  Café   DE\tla\nPaix ") == "q:café de la paix"
    assert one(spark, text_key(F.col("x")), "   ") == ""
    assert one(spark, text_key(F.col("x")), None) == ""


def test_readable_delta(spark):
    cases = {0: "0 seconds", 1: "1 second", 100: "1 minute and 40 seconds",
             12345: "3 hours, 25 minutes and 45 seconds", 3600: "1 hour",
             432546534: "13 years, 8 months, 17 days, 7 hours, 48 minutes and 54 seconds"}
    for sec, text in cases.items():
        assert one(spark, readable_delta(F.col("x")), sec, "x long") == text


def test_minute_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1)),
                                (dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1))], "a timestamp, b timestamp")
    r = df.select(minutes_between("a", "b").alias("m"), seconds_between("a", "b").alias("s")).collect()
    assert [x["m"] for x in r] == [1, 2]
    assert r[0]["s"] == 2


def test_iso_dow_monday_first(spark):
    assert one(spark, iso_dow(F.col("x")), dt.date(2024, 1, 1), "x date") == 1   # Monday
    assert one(spark, iso_dow(F.col("x")), dt.date(2024, 1, 7), "x date") == 7   # Sunday


def test_haversine_matches_python(spark):
    def hv(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(x))
    got = one(spark, haversine_km(F.lit(52.52), F.lit(13.405), F.lit(48.8566), F.lit(2.3522)), 1, "x int")
    assert abs(got - hv(52.52, 13.405, 48.8566, 2.3522)) < 1e-9


def test_numeric_helpers(spark):
    assert one(spark, fmt_num(F.col("x")), 12.0, "x double") == "12"
    assert one(spark, fmt_num(F.col("x")), 12.34, "x double") == "12.3"
    assert one(spark, safe_div(F.lit(1), F.col("x")), 0, "x int") is None
    assert one(spark, pct(F.lit(1), F.col("x")), 0, "x int") == 0.0
    assert one(spark, quantize_level(F.col("x"), F.lit(10)), 0, "x int") == 0.0
    assert one(spark, quantize_level(F.col("x"), F.lit(10)), 10, "x int") == 1.0


def test_category_map(spark):
    assert one(spark, category_name(F.col("x")), "") == ""
    assert one(spark, category_name(F.col("x")), "999") == "Other"
    assert one(spark, category_name(F.col("x")), "23") == "Comedy"
    assert one(spark, category_name(F.col("x")), "34") == "Comedy"
    assert one(spark, kind_label(F.col("x")), "meeting") == "Event"
    assert one(spark, kind_label(F.col("x")), "new_kind") == "new_kind"


def test_title_classifier(spark):
    rows = {
        "Searched for coffee": ("search", "coffee", "", "", ""),
        "Directions to Louvre": ("directions", "", "", "", "Louvre"),
        "Directions from Home to Work to Gym": ("directions", "", "", "Home", "Work to Gym"),
        "Directions from Station": ("directions", "", "", "Station", ""),
        "Viewed area around Paris": ("view_place", "", "Paris", "", ""),
        "Used Maps": ("other", "", "", "", ""),
        "African Queen": ("view_place", "", "African Queen", "", ""),
        "   ": ("other", "", "", "", ""),
    }
    df = spark.createDataFrame([(k,) for k in rows], "x string").select("x", classify_title("x").alias("c"))
    for r in df.collect():
        assert tuple(r["c"]) == rows[r["x"]], r["x"]


def test_url_helpers(spark):
    u = "https://maps.google.com/maps?q=Caf%C3%A9+de+Flore&ftid=0x1:0x2"
    assert one(spark, url_query(F.col("x")), u) == "Café de Flore"
    ll = one(spark, url_latlng(F.col("x")), "https://www.google.com/maps/place/X/@1,2/data=!3d48.85!4d2.33")
    assert (ll["lat"], ll["lng"]) == (48.85, 2.33)
    assert one(spark, video_id(F.col("x")), "https://www.youtube.com/watch?v=abcdefghijk&t=1") == "abcdefghijk"
    assert one(spark, video_id(F.col("x")), "https://youtu.be/abcdefghijk?t=3") == "abcdefghijk"
    assert one(spark, video_id(F.col("x")), "https://youtu.be/short") == ""
    assert one(spark, track_id_from_uri(F.col("x")), "spotify:track:abc") == "abc"
    assert one(spark, track_id_from_uri(F.col("x")), "spotify:episode:abc") is None


def test_geocodable(spark):
    ok = {"Eiffel Tower": True, "x": False, "https://a.b": False, "restaurants": False,
          "pizza near me": False, "12345": False, "Zoom Meeting room": False, "Köln": True}
    for text, want in ok.items():
        assert one(spark, is_geocodable(F.col("x")), text) == want, text


def test_strings(spark):
    assert one(spark, truncate_ellipsis(F.col("x"), 5), "abcdefgh") == "abcde..."
    assert one(spark, join_nonblank(F.col("x"), F.lit("  ")), "Song") == "Song"
    assert one(spark, first_nonblank(F.col("x"), F.lit("b")), "") == "b"


def test_age_label(spark):
    assert one(spark, age_label(F.col("x")), 45, "x long") == "45s ago"
    assert one(spark, age_label(F.col("x")), 5400, "x long") == "2h ago"
    assert one(spark, age_label(F.col("x")), 172800, "x long") == "2d ago"


def test_iso_duration_and_release_date(spark):
    assert one(spark, iso_duration_seconds(F.col("x")), "PT1H2M3S") == 3723
    assert one(spark, iso_duration_seconds(F.col("x")), "PT45S") == 45
    assert one(spark, iso_duration_seconds(F.col("x")), "P1DT1M") == 86460
    assert one(spark, release_date(F.col("x")), "1965") == dt.date(1965, 1, 1)
    assert one(spark, release_date(F.col("x")), "1999-07") == dt.date(1999, 7, 1)
    assert one(spark, release_date(F.col("x")), "1850") is None
    assert one(spark, release_date(F.col("x")), "not a date") is None
