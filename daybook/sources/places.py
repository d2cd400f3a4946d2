"""Place resolution rows (SRC-20..24) and the catalog merge (PIP-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import is_geocodable

# fixed values: place types too generic to be the primary type
GENERIC_TYPES = ["point_of_interest", "establishment", "place_of_worship", "food", "premise", "subpremise",
                 "political", "geocode", "street_address", "route"]
GEOCODE_RESULT_DDL = ("key string, place_id string, name string, address_line1 string, category string, "
                      "result_type string, lat double, lon double, formatted string, neighbourhood string, "
                      "suburb string, district string, city string, state string, country string, "
                      "country_code string, rank struct<confidence:double>")


def _s(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def nz(c: Column) -> Column:
    return F.nullif(_s(c), F.lit(""))


def geocoder_rows(results: DataFrame) -> DataFrame:
    """Geocoder results → place rows (SRC-20): primary type = last dotted
    segment of the category (when there is one), else the result type;
    neighbourhood ← suburb ← district; sublocality ← district ← suburb;
    upper-case country code; confidence from the rank; match type = result
    type."""
    cat = _s(F.col("category"))
    return results.select(
        F.col("key").alias("lookup_key"), _s(F.col("place_id")).alias("place_id"),
        F.coalesce(nz(F.col("name")), nz(F.col("address_line1")), F.lit("")).alias("place_name"),
        F.when(cat != "", F.array(cat)).otherwise(F.array().cast("array<string>")).alias("place_types"),
        F.when(cat != "", F.element_at(F.split(cat, "\\."), -1)).otherwise(_s(F.col("result_type"))).alias("primary_type"),
        F.coalesce(F.col("lat"), F.lit(0.0)).alias("lat"), F.coalesce(F.col("lon"), F.lit(0.0)).alias("lng"),
        _s(F.col("formatted")).alias("formatted_address"),
        F.coalesce(nz(F.col("neighbourhood")), nz(F.col("suburb")), nz(F.col("district")), F.lit("")).alias("neighborhood"),
        F.coalesce(nz(F.col("district")), nz(F.col("suburb")), F.lit("")).alias("sublocality"),
        _s(F.col("city")).alias("locality"), _s(F.col("state")).alias("admin_area_1"), _s(F.col("country")).alias("country"),
        F.upper(_s(F.col("country_code"))).alias("country_code"),
        F.coalesce(F.col("rank.confidence"), F.lit(0.0)).cast("float").alias("match_confidence"),
        _s(F.col("result_type")).alias("match_type"))


def address_component(components, kind: str, field: str = "long_name") -> Column:
    """First component having ``kind`` among its types (SRC-21)."""
    c = F.col(components) if isinstance(components, str) else components
    return _s(F.get(F.filter(c, lambda x: F.array_contains(x["types"], kind)), 0)[field])


def primary_type(types) -> Column:
    """First non-generic type, else the first, else '' (SRC-22)."""
    t = F.col(types) if isinstance(types, str) else types
    return F.coalesce(F.get(F.filter(t, lambda x: ~x.isin(*GENERIC_TYPES)), 0), F.get(t, 0), F.lit(""))


def secondary_scored(rows: DataFrame) -> DataFrame:
    """The alternative provider's rows get a fixed confidence 0.7 and type
    poi/area (SRC-23)."""
    return rows.withColumn("match_confidence", F.lit(0.7).cast("float")).withColumn(
        "match_type", F.when(F.col("place_name") != "", "poi").otherwise("area"))


def provider_fallback(primary: DataFrame, secondary: DataFrame, key: str = "lookup_key") -> DataFrame:
    """Primary result per key, else the secondary one (SRC-24)."""
    return primary.unionByName(secondary.join(primary.select(key), key, "left_anti"))


def sentinel(keys: DataFrame, key: str = "lookup_key") -> DataFrame:
    """'unresolved' catalog rows: empty name, 0/0 — a negative cache entry."""
    return keys.select(
        F.col(key).alias("place_id"), F.col(key).alias("lookup_key"), F.lit("").alias("place_name"),
        F.array().cast("array<string>").alias("place_types"), F.lit("").alias("primary_type"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"), *[F.lit("").alias(c) for c in (
            "formatted_address", "neighborhood", "sublocality", "locality", "admin_area_1", "country",
            "country_code")], F.lit(0.0).cast("float").alias("match_confidence"), F.lit("unresolved").alias("match_type"))


def resolve_places(worklist: DataFrame, results: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog rows to append for a work list (PIP-07).

    Keys already in the catalog (hits, including negative hits) add
    nothing; junk texts and keys whose result is missing or at 0/0 become
    'unresolved' sentinels; resolved results become rows keyed by the work
    list key. ``worklist`` has (geo_key, text)."""
    todo = worklist.join(catalog.select(F.col("place_id").alias("geo_key")), "geo_key", "left_anti")
    junk = todo.filter(~is_geocodable(F.col("text")))
    ok = todo.filter(is_geocodable(F.col("text")))
    r = results.withColumn("__ok", ~((F.col("lat") == 0) & (F.col("lng") == 0)))
    hit = ok.join(r.filter("__ok").drop("__ok"), ok.geo_key == r.lookup_key).drop("lookup_key", "text")
    hit = hit.withColumn("lookup_key", F.col("geo_key")).withColumn("place_id", F.col("geo_key")).drop("geo_key")
    if "place_types" not in hit.columns:
        hit = hit.withColumn("place_types", F.array(F.col("primary_type")))
    miss = ok.join(r.filter("__ok").select("lookup_key"), ok.geo_key == F.col("lookup_key"), "left_anti")
    sent = sentinel(junk.select(F.col("geo_key").alias("lookup_key")).unionByName(
        miss.select(F.col("geo_key").alias("lookup_key"))))
    cols = sent.columns
    return hit.select(*cols).unionByName(sent)
