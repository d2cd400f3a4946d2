"""Place normalisers (SRC-20..24) and catalog row helpers."""

from pyspark.sql import functions as F

from daybook.sources import places


def test_geocoder_rows(spark):
    df = spark.createDataFrame([
        {"key": "q:a", "place_id": "p1", "name": "", "address_line1": "1 Rue X", "category": "catering.cafe.coffee",
         "result_type": "amenity", "lat": 1.0, "lon": 2.0, "neighbourhood": "", "suburb": "", "district": "D",
         "city": "Paris", "country": "France", "country_code": "fr", "rank": {"confidence": 0.8}},
        {"key": "q:b", "place_id": "p2", "name": "Town", "category": None, "result_type": "city", "lat": 3.0,
         "lon": 4.0, "suburb": "S", "country_code": "de", "rank": None}], places.GEOCODE_RESULT_DDL)
    r = {x["lookup_key"]: x for x in places.geocoder_rows(df).collect()}
    assert (r["q:a"]["place_name"], r["q:a"]["primary_type"], r["q:a"]["neighborhood"]) == ("1 Rue X", "coffee", "D")
    assert r["q:a"]["country_code"] == "FR" and abs(r["q:a"]["match_confidence"] - 0.8) < 1e-6
    assert (r["q:a"]["sublocality"], r["q:a"]["match_type"], r["q:a"]["place_types"]) == ("D", "amenity", ["catering.cafe.coffee"])
    assert (r["q:b"]["primary_type"], r["q:b"]["neighborhood"], r["q:b"]["match_confidence"]) == ("city", "S", 0.0)


def test_components_primary_type_fallback(spark):
    df = spark.createDataFrame([([{"long_name": "Paris", "types": ["locality", "political"]},
                                  {"long_name": "FR", "types": ["country"]}],
                                 ["point_of_interest", "establishment", "food", "museum"]),
                                ([], ["establishment"]), ([], [])],
                               "components array<struct<long_name:string,types:array<string>>>, types array<string>")
    out = df.select(places.address_component("components", "locality").alias("loc"),
                    places.primary_type("types").alias("pt")).collect()
    assert [(o["loc"], o["pt"]) for o in out] == [("Paris", "museum"), ("", "establishment"), ("", "")]
    prim = spark.createDataFrame([("k1", "A")], "lookup_key string, place_name string")
    sec = places.secondary_scored(spark.createDataFrame([("k1", "B"), ("k2", "")], "lookup_key string, place_name string"))
    both = {r["lookup_key"]: r for r in places.provider_fallback(
        prim.withColumn("match_confidence", F.lit(0.9).cast("float")).withColumn("match_type", F.lit("poi")), sec).collect()}
    assert both["k1"]["place_name"] == "A" and both["k2"]["match_type"] == "area"
    assert abs(both["k2"]["match_confidence"] - 0.7) < 1e-6
