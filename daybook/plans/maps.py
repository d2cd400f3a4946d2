"""Maps models: keyed activity, enrichment with the privacy flag, home
base, daily location, trips and the gold dashboards (§2.K)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.geo import haversine_km, haversine_m
from daybook.functions.numeric import round_half, safe_div
from daybook.functions.text import text_key
from daybook.functions.timefn import iso_utc, readable_delta
from daybook.operators.merge import attach_scalar
from daybook.operators.spine import densify, int_spine
from daybook.operators.joins import within_radius_flag
from daybook.operators.topn import top_n
from daybook.plans.base import floor_date, place_label, s, today
from daybook.plans.common import degrees_of, distinct_counts, mean_degrees, micro_degrees, place_weight
from daybook.sources.tables import read_table


def maps_activity_keyed(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """best_text precedence and the catalog key: place_id, else the text key."""
    a = read_table(spark, cfg, "maps_activity")
    t = F.col("activity_type")
    best = (F.when(s("place_name") != "", F.col("place_name"))
            .when((t == "search") & (s("query") != ""), F.col("query"))
            .when((t == "directions") & (s("destination") != ""), F.col("destination"))
            .when(s("query") != "", F.col("query")).when(s("destination") != "", F.col("destination"))
            .otherwise(F.lit("")))
    a = a.withColumn("best_text", best)
    return a.withColumn("geo_key", F.when(s("place_id") != "", F.col("place_id")).otherwise(text_key("best_text")))


def silver_maps_activity_enriched(spark: SparkSession, cfg: Cfg, strict_defaults: bool | None = None) -> DataFrame:
    """Activity ⟕ place catalog on the shared key, plus ``is_private``.

    ``strict_defaults=False`` (default) falls back to the activity's own
    name and coordinates when the catalog has no row (the documented
    intent, SEM-2); ``True`` reproduces the type-default behaviour ('' and
    0/0 on a miss). Sentinel 'unresolved' rows match either way (SEM-3)."""
    strict = cfg.extra.get("strict_defaults", False) if strict_defaults is None else strict_defaults
    a = maps_activity_keyed(spark, cfg)
    c = read_table(spark, cfg, "maps_place_catalog").select(
        F.col("place_id").alias("geo_key"), F.col("place_name").alias("c_name"), "primary_type", "place_types",
        F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"), "neighborhood", "sublocality", "locality",
        "country", "country_code", "match_confidence", "match_type", F.lit(True).alias("c_hit"))
    j = a.join(c.hint("merge"), "geo_key", "left")
    hit = F.coalesce("c_hit", F.lit(False))
    if strict:
        name = F.when(hit, s("c_name")).otherwise(F.lit(""))
        lat = F.when(hit, F.coalesce("c_lat", F.lit(0.0))).otherwise(F.lit(0.0))
        lng = F.when(hit, F.coalesce("c_lng", F.lit(0.0))).otherwise(F.lit(0.0))
    else:
        name = F.when(hit, s("c_name")).otherwise(s("place_name"))
        lat = F.when(hit, F.coalesce("c_lat", F.lit(0.0))).otherwise(F.coalesce("lat", F.lit(0.0)))
        lng = F.when(hit, F.coalesce("c_lng", F.lit(0.0))).otherwise(F.coalesce("lng", F.lit(0.0)))
    e = j.select(
        "event_ts", s("activity_type").alias("activity_type"), s("query").alias("query"), name.alias("place_name"),
        s("place_id").alias("place_id"), s("primary_type").alias("primary_type"),
        F.coalesce("place_types", F.array().cast("array<string>")).alias("place_types"),
        lat.alias("lat"), lng.alias("lng"), s("neighborhood").alias("neighborhood"),
        s("sublocality").alias("sublocality"), s("locality").alias("locality"), s("country").alias("country"),
        s("country_code").alias("country_code"),
        F.coalesce("match_confidence", F.lit(0.0)).cast("float").alias("match_confidence"),
        s("match_type").alias("match_type"), s("origin").alias("origin"), s("destination").alias("destination"),
        F.to_date("event_ts").alias("event_date"), F.hour("event_ts").alias("hour_of_day"))
    private = read_table(spark, cfg, "maps_private_places")
    return within_radius_flag(e, private, "lat", "lng", zero_rule="either")


def public_activity(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None) -> DataFrame:
    """The privacy gate every consumer goes through (FLT-07)."""
    e = enriched if enriched is not None else silver_maps_activity_enriched(spark, cfg)
    return e.filter(F.col("is_private") == 0)


def _gated(spark, cfg, enriched=None):
    return public_activity(spark, cfg, enriched).filter(
        (F.col("locality") != "") & (F.col("match_confidence") >= cfg.home_confidence_min))


def silver_home_base(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None) -> DataFrame:
    """The place with the largest weighted activity; ties → (locality, country)."""
    loc = _gated(spark, cfg, enriched).groupBy("locality", "country").agg(
        mean_degrees("lat").alias("lat"), mean_degrees("lng").alias("lng"), place_weight().alias("weight"))
    return _heaviest(loc)


def _heaviest(loc: DataFrame) -> DataFrame:
    top = top_n(loc, 1, [F.col("weight").desc(), F.col("locality"), F.col("country")])
    return top.select(F.col("locality").alias("home_locality"), F.col("country").alias("home_country"),
                      F.col("lat").alias("home_lat"), F.col("lng").alias("home_lng"))


def place_days(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None) -> DataFrame:
    """Sums per day and place, coordinates in whole micro-degrees: the daily
    series and the home base both follow from them, a few rows a day."""
    return _gated(spark, cfg, enriched).groupBy("event_date", "locality", "country").agg(
        *[f(micro_degrees(c)).alias(f"{c}_{k}") for c in ("lat", "lng") for k, f in (("sum", F.sum), ("n", F.count))],
        F.count(F.lit(1)).alias("n"), place_weight().alias("weight"),
        F.count_if(F.col("activity_type") == "directions").alias("directions"))


def silver_geo_daily(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None,
                     days: DataFrame | None = None) -> DataFrame:
    """Dominant place per day (tie-safe struct max, SEM-10), distance to
    home and the away rule. ``days``: written ``place_days`` to read."""
    sums = days if days is not None else place_days(spark, cfg, enriched)
    day_loc = sums.select("event_date", "locality", "country", *[degrees_of(F.col(f"{c}_sum"), F.col(f"{c}_n")).alias(c)
                                                                 for c in ("lat", "lng")], "n", "weight", "directions")
    home = _heaviest(sums.groupBy("locality", "country").agg(
        *[degrees_of(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(c) for c in ("lat", "lng")], F.sum("weight").alias("weight")))
    best = F.max(F.struct("weight", "n", "locality", "country", "lat", "lng")).alias("b")
    day = day_loc.groupBy("event_date").agg(best, F.sum("n").alias("activity_count"),
                                            F.sum("directions").alias("directions_count"))
    p = attach_scalar(day.select("event_date", "b.locality", "b.country", "b.lat", "b.lng", "activity_count",
                                 "directions_count"), home)
    m = haversine_m("lat", "lng", "home_lat", "home_lng")
    away = (F.when(F.col("country") != F.col("home_country"), 1)
            .when((F.col("locality") != F.col("home_locality")) & (m > cfg.away_km * 1000), 1).otherwise(0))
    return p.select("event_date", "locality", "country", "lat", "lng", F.col("activity_count").cast("long"),
                    F.col("directions_count").cast("long"), "home_locality", "home_country", "home_lat", "home_lng",
                    round_half(m / 1000.0, 1).alias("km_from_home"), away.cast("int").alias("away")
                    ).orderBy("event_date")


def trip_key(start, end):
    """``<start>_<end>`` (STR-21); must equal the enrichers' key."""
    return F.concat_ws("_", F.col(start).cast("string"), F.col(end).cast("string"))


def gold_maps_trips(spark: SparkSession, cfg: Cfg, trips: DataFrame | None = None) -> DataFrame:
    """Trips ⟕ model verdicts ⟕ human labels ⟕ weather; human > model >
    geometric precedence; verdict gate (JON-04, PRJ-06, FLT-08)."""
    t = trips if trips is not None else read_table(spark, cfg, "maps_trips")
    t = t.withColumn("trip_key", trip_key("started_at", "ended_at"))
    e = read_table(spark, cfg, "maps_trips_enriched").select(
        "trip_key", F.lit(1).alias("enriched_present"), F.col("is_trip").alias("e_is_trip"),
        F.col("confidence").alias("e_confidence"), F.col("trip_type").alias("e_trip_type"),
        F.col("title").alias("e_title"), F.col("destination_label").alias("e_destination"),
        F.col("destination_country").alias("e_country"), F.col("summary").alias("e_summary"))
    lab = read_table(spark, cfg, "maps_trip_labels").select("trip_key", "label", "edited_title",
                                                            "edited_destination", "edited_trip_type")
    w = read_table(spark, cfg, "maps_trip_weather").select("trip_key", "temp_mean", "precip_mm",
                                                           F.col("summary").alias("weather"))
    m = t.join(e, "trip_key", "left").join(lab, "trip_key", "left").join(w, "trip_key", "left")
    present = F.coalesce("enriched_present", F.lit(0)) == 1

    def pick(human, model, geo):
        return (F.when(s(human) != "", F.col(human)).when(present & (s(model) != ""), F.col(model))
                .otherwise(geo))
    gate = (F.when(F.col("label") == "reject", 0).when(F.col("label") == "confirm", 1)
            .when(present, F.col("e_is_trip")).otherwise(1))
    return m.filter(gate == 1).orderBy(F.col("started_at").desc()).select(
        F.col("started_at").cast("string").alias("start"), F.col("ended_at").cast("string").alias("end"),
        pick("edited_destination", "e_destination", F.col("destination")).alias("destination"),
        pick("edited_title", "e_title", F.col("destination")).alias("title"),
        pick("edited_trip_type", "e_trip_type", F.lit("")).alias("trip_type"),
        F.when(present & (s("e_country") != ""), F.col("e_country")).otherwise(s("destination_country")).alias("country"),
        F.when(present, s("e_summary")).otherwise(F.lit("")).alias("summary"),
        F.when(present, F.col("e_confidence")).otherwise(F.lit(0.0)).cast("float").alias("confidence"),
        "days", "km", "localities", "countries", "max_km",
        round_half("temp_mean", 1).alias("temp_mean"), round_half("precip_mm", 0).alias("precip_mm"),
        s("weather").alias("weather"), "trip_key")


def gold_maps_kpis_dashboard(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None,
                             trips: DataFrame | None = None) -> DataFrame:
    """One KPI row: activity counts, cities/countries with a directions row,
    trip KPIs floored by start, new places this year, home.

    The activity part is one scan, summed once by (date, locality, country,
    place). Totals and the distinct counts are small aggregates over that
    table; no activity row is expanded."""
    e = enriched if enriched is not None else silver_maps_activity_enriched(spark, cfg)
    a = public_activity(spark, cfg, e).filter(F.col("event_date") >= floor_date(cfg))
    t = F.col("activity_type")
    per = a.groupBy("event_date", "locality", "country", "place_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(t == "directions").alias("dirs"), F.count_if(t == "search").alias("searches"),
        F.count_if(t == "view_place").alias("views"))
    k = per.agg(F.sum("n").alias("total_activities"), F.sum("dirs").alias("total_directions"), F.sum("searches").alias("total_searches"),
                F.sum("views").alias("total_explorations"), F.min("event_date").alias("__min"), F.max("event_date").alias("__max"))
    went = F.col("dirs") > 0
    k = attach_scalar(k, distinct_counts(
        per, days_with_activity=F.col("event_date"), unique_destinations=F.nullif(F.col("place_name"), F.lit("")),
        cities_visited=F.when(went, F.nullif(F.col("locality"), F.lit(""))),
        countries_visited=F.when(went, F.nullif(F.col("country"), F.lit("")))))
    gt = gold_maps_trips(spark, cfg, trips)
    recent = gt.filter(F.to_date("start") >= floor_date(cfg))
    tk = recent.agg(F.coalesce(F.sum("days"), F.lit(0)).cast("long").alias("days_away_from_home"),
                    F.coalesce(F.max("days"), F.lit(0)).cast("long").alias("longest_trip_days"),
                    F.coalesce(F.sum("km"), F.lit(0)).cast("int").alias("kilometers_traveled"))
    newp = (gt.groupBy("destination").agg(F.min(F.year(F.to_date("start"))).alias("fy"))
            .filter(F.col("fy") == cfg.as_of.year).agg(F.count(F.lit(1)).alias("new_places_this_year")))
    home = silver_home_base(spark, cfg, e).agg(F.coalesce(F.first("home_locality"), F.lit("")).alias("home_locality"),
                                               F.coalesce(F.first("home_country"), F.lit("")).alias("home_country"))
    one = k
    for part in (tk, newp, home):
        one = attach_scalar(one, part)
    n = F.col("total_activities")
    return one.select(
        F.coalesce(n, F.lit(0)).alias("total_activities"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total_directions", "total_searches", "total_explorations")],
        F.coalesce(F.col("total_explorations"), F.lit(0)).alias("total_likely_visits"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("days_with_activity", "unique_destinations")],
        "cities_visited", "countries_visited",
        F.coalesce(F.col("__min"), F.lit(dt.date(1970, 1, 1))).cast("string").alias("first_activity"),
        F.coalesce(F.col("__max"), F.lit(dt.date(1970, 1, 1))).cast("string").alias("last_activity"),
        F.coalesce(F.datediff("__max", "__min"), F.lit(0)).cast("int").alias("days_tracked"),
        F.coalesce(round_half(safe_div(n, F.col("days_with_activity")), 1), F.lit(0.0)).alias("avg_activities_per_day"),
        F.coalesce(round_half(safe_div(F.col("total_directions"), n) * 100.0, 1), F.lit(0.0)).alias("directions_pct"),
        F.coalesce(round_half(safe_div(F.col("total_searches"), n) * 100.0, 1), F.lit(0.0)).alias("search_pct"),
        F.coalesce(round_half(safe_div(F.col("total_explorations"), n) * 100.0, 1), F.lit(0.0)).alias("explore_pct"),
        "days_away_from_home", "longest_trip_days", "kilometers_traveled", "new_places_this_year",
        "home_locality", "home_country")


def gold_maps_locations_dashboard(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None,
                                  trips: DataFrame | None = None) -> DataFrame:
    e = enriched if enriched is not None else silver_maps_activity_enriched(spark, cfg)
    a = public_activity(spark, cfg, e).filter(
        (F.col("event_date") >= floor_date(cfg)) & (F.col("lat") != 0) & (F.col("lng") != 0)
        & (F.col("match_confidence") >= cfg.home_confidence_min)
        & ~F.col("match_type").isin("country", "state", "unresolved"))
    gate = (silver_home_base(spark, cfg, e).select(F.col("home_country").alias("country"))
            .union(gold_maps_trips(spark, cfg, trips).filter(F.col("country") != "").select("country")).distinct())
    a = a.join(gate, "country", "left_semi")
    g = a.groupBy(place_label().alias("name")).agg(
        mean_degrees("lat").alias("lat"), mean_degrees("lng").alias("lng"), F.count(F.lit(1)).alias("__n"),
        F.count_if(F.col("activity_type") == "directions").alias("__d"))
    g = top_n(g.filter("__d > 0"), 500, [F.col("__d").desc(), F.col("__n").desc(), F.col("name")])
    return g.select("name", "lat", "lng", readable_delta(F.col("__n") * 60).alias("duration"),
                    F.lit("aggregated").alias("dwell_time_category"), F.lit(0.0).alias("distance_to_next_km"))


def gold_maps_destinations_dashboard(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None) -> DataFrame:
    a = public_activity(spark, cfg, enriched).filter(F.col("event_date") >= floor_date(cfg))
    countries = a.filter((F.col("activity_type") == "directions") & (F.col("country") != "")).select("country").distinct()
    g = a.join(countries, "country", "left_semi").groupBy(place_label().alias("destination")).agg(
        F.count(F.lit(1)).alias("count"), F.mode("primary_type", deterministic=True).alias("type"))
    return top_n(g.filter(F.col("destination") != "Unknown"), 10, [F.col("count").desc(), F.col("destination")])


def gold_maps_hourly_activity_dashboard(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None) -> DataFrame:
    c = (public_activity(spark, cfg, enriched).filter(F.col("event_date") >= floor_date(cfg))
         .groupBy(F.col("hour_of_day").cast("long").alias("h")).agg(F.count(F.lit(1)).alias("activities")))
    d = densify(int_spine(spark, "h", 24), c, ["h"], {"activities": 0})
    return d.orderBy("h").select(F.col("h").cast("string").alias("hour"), F.col("activities").cast("long"))


def gold_maps_daily_activity_dashboard(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None) -> DataFrame:
    t = F.col("activity_type")
    a = public_activity(spark, cfg, enriched).filter(
        F.col("event_date").between(F.date_sub(today(cfg), 29), today(cfg)))
    return a.groupBy(F.col("event_date").alias("date")).agg(
        F.count_if(t == "directions").alias("directions"), F.count_if(t == "search").alias("searches"),
        F.count_if(t == "view_place").alias("explorations"),
        F.count_if(~t.isin("directions", "search", "view_place")).alias("other")).orderBy("date")


def gold_maps_recent_activities(spark: SparkSession, cfg: Cfg, enriched: DataFrame | None = None) -> DataFrame:
    """10 newest public activities at neighbourhood level only (privacy)."""
    a = top_n(public_activity(spark, cfg, enriched), 10, [F.col("event_ts").desc()])
    t, pt = F.col("activity_type"), F.col("primary_type")
    typ = (F.when(t == "directions", "directions")
           .when((t == "search") & (pt != ""), F.concat(F.lit("search · "), pt))
           .when(t == "search", "search").when(pt != "", pt).otherwise("view"))
    return a.select(iso_utc("event_ts").alias("time"), place_label().alias("location"), typ.alias("type"))


def km_between(a_lat, a_lng, b_lat, b_lng):
    return haversine_km(a_lat, a_lng, b_lat, b_lng)
