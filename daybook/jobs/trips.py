"""Trip jobs: segmentation (PIP-01), evidence (PIP-02), verdict rows
(PIP-03), destination centroid + weather reduction (PIP-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.text import clamp01, clip, enum_normalise
from daybook.operators.islands import island_runs, run_mode, run_path_km
from daybook.operators.joins import overlap_join
from daybook.operators.topn import top_n_per_group
from daybook.plans.maps import place_days, public_activity, silver_geo_daily, trip_key

# fixed values: accepted trip types of a verdict (anything else becomes 'other')
TRIP_TYPES = ["leisure", "business", "weekend", "day_trip", "relocation", "visiting", "other"]


# the tables that ``segment_trips`` reads
TRIP_TABLES = ("maps_activity", "maps_place_catalog", "maps_private_places")


def segment_trips(spark: SparkSession, cfg: Cfg, geo_daily: DataFrame | None = None) -> DataFrame:
    """Away days → runs (a gap of more than ``gap_days + 1`` days between
    away days splits; a short return home does not) → one candidate per run
    with ≥ 1 directions day and a destination. Rows of ``maps_trips``.

    The series is one row per day, so the run window is bounded by the
    calendar, not by event volume. The sums per day and place are written first:
    the series reads them twice, and the driver would hold the plan of the whole
    enrichment for each reading."""
    from daybook.session import materialize
    g = geo_daily if geo_daily is not None else silver_geo_daily(spark, cfg, days=materialize(place_days(spark, cfg)))
    g = g.filter(F.col("away") == 1)
    r = materialize(island_runs(g, [], "event_date", cfg.gap_days))   # read by four branches below
    keys = ["run_id"]
    ne = lambda c: F.when(F.col(c) != "", F.col(c))
    agg = r.groupBy(*keys).agg(
        F.min("event_date").alias("started_at"), F.max("event_date").alias("ended_at"),
        F.sum("directions_count").alias("dirs"), F.countDistinct(ne("locality")).alias("localities"),
        F.countDistinct(ne("country")).alias("countries"),
        F.coalesce(F.floor(F.max("km_from_home")), F.lit(0)).cast("long").alias("max_km"))
    dest = run_mode(r, keys, "locality", "event_date", "destination")
    dc = (r.join(dest, keys).filter((F.col("locality") == F.col("destination")) & (F.col("country") != ""))
          .groupBy(*keys).agg(F.min_by("country", "event_date").alias("destination_country")))
    km = run_path_km(r, keys, "event_date", "lat", "lng", "home_lat", "home_lng")
    out = (agg.join(dest, keys, "left").join(dc, keys, "left").join(km, keys, "left")
           .filter((F.col("dirs") > 0) & (F.coalesce("destination", F.lit("")) != "")))
    return out.select(
        "started_at", "ended_at", (F.datediff("ended_at", "started_at") + 1).cast("int").alias("days"),
        "destination", F.coalesce("destination_country", F.lit("")).alias("destination_country"),
        F.floor(F.coalesce("km", F.lit(0.0))).cast("long").alias("km"), F.col("localities").cast("int"),
        F.col("countries").cast("int"), "max_km")


def trip_evidence(spark: SparkSession, cfg: Cfg, trips: DataFrame, enriched: DataFrame,
                  calendar_geo: DataFrame | None = None) -> DataFrame:
    """Per trip: totals, top-10 localities, top-12 places and up to 25
    travel-relevant calendar events within ±buffer days, rendered as
    ordered text lines below a header of the candidate's dates, guess and
    distances. One distributed job for all trips (range joins), every list
    bounded by its rank limit. Activity is counted per day and place before
    the joins, and a day's counts are spread over ``cfg.salt_buckets`` tasks,
    so a day holding a large share of all rows doesn't meet in one."""
    given = {"days": "int", "destination": "string", "destination_country": "string", "localities": "int",
             "countries": "int", "max_km": "long", "km": "long"}
    t = trips.select("started_at", "ended_at", trip_key("started_at", "ended_at").alias("trip_key"))
    heads = trips.select(trip_key("started_at", "ended_at").alias("trip_key"),
                         *[(F.col(c) if c in trips.columns else F.lit(None)).cast(k).alias(f"h_{c}") for c, k in given.items()])
    a = public_activity(spark, cfg, enriched).filter(
        (F.col("match_confidence") >= cfg.home_confidence_min))
    a = a.groupBy("event_date", "locality", "country", "activity_type", "place_name", "primary_type").agg(
        F.count(F.lit(1)).alias("rows"))
    ta = overlap_join(t, a, "started_at", "ended_at", "event_date", salt=cfg.salt_buckets)
    rows = F.sum("rows")
    kind = lambda k: F.coalesce(F.sum(F.when(F.col("activity_type") == k, F.col("rows"))), F.lit(0))
    loc = ta.filter(F.col("locality") != "")
    totals = loc.groupBy("trip_key").agg(
        rows.alias("n"), kind("directions").alias("n_dir"), kind("search").alias("n_search"),
        F.countDistinct("country").alias("n_countries"))
    lg = loc.groupBy("trip_key", "locality", "country").agg(
        kind("directions").alias("dir"), rows.alias("n"))
    lg = top_n_per_group(lg, ["trip_key"], [F.col("dir").desc(), F.col("n").desc(), F.col("locality")], 10)
    loc_lines = lg.groupBy("trip_key").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "locality", "country", "dir", "n"))),
        lambda x: F.concat(F.lit("  - "), x["locality"], F.lit(", "), x["country"], F.lit(": "),
                           x["dir"].cast("string"), F.lit(" navigations / "), x["n"].cast("string"),
                           F.lit(" activities"))), "\n").alias("loc_lines"))
    pg = ta.filter(F.col("place_name") != "").groupBy("trip_key", "place_name").agg(
        F.min("primary_type").alias("ptype"), rows.alias("n"))
    pg = top_n_per_group(pg, ["trip_key"], [F.col("n").desc(), F.col("place_name")], 12)
    place_lines = pg.groupBy("trip_key").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "place_name", "ptype", "n"))),
        lambda x: F.concat(F.lit("  - "), x["place_name"],
                           F.when(x["ptype"] != "", F.concat(F.lit(" ("), x["ptype"], F.lit(")"))).otherwise(F.lit("")),
                           F.lit(" x"), x["n"].cast("string"))), "\n").alias("place_lines"))
    out = t.join(heads, "trip_key").join(totals, "trip_key", "left").join(loc_lines, "trip_key", "left").join(place_lines, "trip_key", "left")
    cal_lines = None
    if calendar_geo is not None:
        b = cfg.evidence_buffer_days
        tw = t.select("trip_key", F.date_sub("started_at", b).alias("w_s"), F.date_add("ended_at", b).alias("w_e"))
        c = calendar_geo.filter((F.col("corroborates_travel") == 1) | (F.col("is_multi_day") == 1)).select(
            F.to_date("started_at").alias("c_s"), F.to_date("ended_at").alias("c_e"), "started_at", "title",
            "location", "geo_locality", "geo_country", "km_from_home", "is_all_day", "is_multi_day", "is_travel_title")
        tc = overlap_join(tw, c, "w_s", "w_e", "c_s", "c_e", salt=cfg.salt_buckets)
        tc = top_n_per_group(tc, ["trip_key"], [F.col("started_at"), F.col("title")], 25)
        tags = F.concat_ws(", ", F.when(F.col("is_all_day") == 1, F.lit("all-day")),
                           F.when(F.col("is_multi_day") == 1, F.lit("multi-day")),
                           F.when(F.col("is_travel_title") == 1, F.lit("travel-title")))
        line = F.concat(F.lit("  - "), F.col("c_s").cast("string"), F.lit(" "), F.col("title"),
                        F.when(F.col("location") != "", F.concat(F.lit(" @ "), F.col("location"))).otherwise(F.lit("")),
                        F.when((F.coalesce("geo_locality", F.lit("")) != "") | (F.coalesce("geo_country", F.lit("")) != ""),
                               F.concat(F.lit(" [geo: "), F.coalesce("geo_locality", F.lit("")), F.lit(", "),
                                        F.coalesce("geo_country", F.lit("")), F.lit(", "),
                                        F.col("km_from_home").cast("string"), F.lit(" km from home]")))
                        .otherwise(F.lit("")),
                        F.when(tags != "", F.concat(F.lit(" ("), tags, F.lit(")"))).otherwise(F.lit("")))
        cal_lines = tc.groupBy("trip_key").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))), lambda x: x["l"]), "\n").alias("cal_lines"))
        out = out.join(cal_lines, "trip_key", "left")
    else:
        out = out.withColumn("cal_lines", F.lit(None).cast("string"))
    shown = lambda c, none: F.coalesce(F.when(F.col(c).cast("string") != "", F.col(c).cast("string")), F.lit(none))
    text = F.concat_ws("\n",
                       F.concat(F.lit("trip "), F.col("trip_key")),
                       F.concat(F.lit("dates: "), F.col("started_at").cast("date").cast("string"), F.lit(" to "),
                                F.col("ended_at").cast("date").cast("string"), F.lit(" ("),
                                F.coalesce("h_days", F.datediff("ended_at", "started_at") + 1).cast("string"), F.lit(" days)")),
                       F.concat(F.lit("geometric guess: "), shown("h_destination", "?"), F.lit(", "),
                                shown("h_destination_country", "?")),
                       F.concat(F.lit("distinct: "), shown("h_localities", "0"), F.lit(" localities, "),
                                shown("h_countries", "0"), F.lit(" countries")),
                       F.concat(F.lit("distances: at most "), shown("h_max_km", "0"), F.lit(" km from home, round trip about "),
                                shown("h_km", "0"), F.lit(" km")),
                       F.concat(F.lit("activity: "), F.coalesce("n", F.lit(0)).cast("string"), F.lit(" rows, "),
                                F.coalesce("n_dir", F.lit(0)).cast("string"), F.lit(" navigations, "),
                                F.coalesce("n_search", F.lit(0)).cast("string"), F.lit(" searches, "),
                                F.coalesce("n_countries", F.lit(0)).cast("string"), F.lit(" countries")),
                       F.when(F.col("loc_lines").isNotNull(), F.concat(F.lit("localities:\n"), F.col("loc_lines"))),
                       F.when(F.col("place_lines").isNotNull(), F.concat(F.lit("places:\n"), F.col("place_lines"))),
                       F.concat(F.lit("calendar:\n"), F.coalesce(F.col("cal_lines"), F.lit("  (none)"))))
    return out.select("trip_key", "started_at", "ended_at", F.coalesce("n", F.lit(0)).alias("n"),
                      F.coalesce("n_dir", F.lit(0)).alias("n_dir"), F.coalesce("n_search", F.lit(0)).alias("n_search"),
                      F.coalesce("n_countries", F.lit(0)).alias("n_countries"), text.alias("evidence"))


def normalise_verdicts(verdicts: DataFrame, done: DataFrame | None = None, force: bool = False,
                       split_chars: int | None = None) -> DataFrame:
    """Externally supplied verdict rows → ``maps_trips_enriched`` rows
    (PIP-03, STR-20, JSN-02, JSN-04): the JSON object is taken from the first
    '{' to the last '}' of the raw answer; trip type trimmed, clipped to 32,
    lower-cased, '-'/' ' → '_', unknown → 'other'; confidence clamped to
    [0, 1]; texts trimmed and clipped (title and label 200, country 100,
    summary 1000, evidence 500); a non-empty split list becomes JSON text
    (', ' separators), otherwise ''; with ``split_chars`` items that would
    make it longer are left out whole, so it stays JSON. Keys already
    enriched are skipped unless ``force`` (JON-17)."""
    raw = F.regexp_extract(F.coalesce(F.col("raw"), F.lit("")), "(?s)(\\{.*\\})", 1)
    schema = ("is_trip boolean, confidence double, trip_type string, title string, destination_label string, "
              "destination_country string, summary string, evidence string, suggested_split array<string>")
    v = verdicts.withColumn("j", F.from_json(raw, schema))
    split = F.col("j.suggested_split")
    split_items = F.transform(split, lambda x: F.regexp_extract(F.to_json(F.array(x)), "^\\[(.*)\\]$", 1))
    joined = F.array_join(split_items, ", ") if split_chars is None else F.aggregate(
        split_items, F.lit(""), lambda held, x: F.when(F.length(held) + F.length(x) + 4 - F.when(held == "", 2).otherwise(0)
                                                       > split_chars, held)
        .otherwise(F.concat(held, F.when(held == "", "").otherwise(", "), x)))
    split_text = F.when(F.coalesce(F.size(split), F.lit(0)) > 0, F.concat(F.lit("["), joined, F.lit("]")))
    out = v.select(
        "trip_key", "started_at", "ended_at", (F.datediff("ended_at", "started_at") + 1).cast("int").alias("days"),
        F.coalesce(F.col("j.is_trip"), F.lit(False)).cast("int").alias("is_trip"),
        clamp01(F.col("j.confidence")).cast("float").alias("confidence"),
        enum_normalise(clip(F.col("j.trip_type"), 32), TRIP_TYPES).alias("trip_type"),
        clip(F.col("j.title"), 200).alias("title"), clip(F.col("j.destination_label"), 200).alias("destination_label"),
        clip(F.col("j.destination_country"), 100).alias("destination_country"),
        clip(F.col("j.summary"), 1000).alias("summary"), clip(F.col("j.evidence"), 500).alias("evidence"),
        F.coalesce(split_text, F.lit("")).alias("suggested_split"),
        F.substring(F.coalesce("model", F.lit("")), 1, 64).alias("model"))
    if done is not None and not force:
        out = out.join(done.select("trip_key").distinct(), "trip_key", "left_anti")
    return out


def destination_centroid(trips: DataFrame, enriched_public: DataFrame) -> DataFrame:
    """Centroid of the trip's destination locality inside its window, else
    of the whole window (PIP-04); trips without coordinates get none."""
    t = trips.select("trip_key", "started_at", "ended_at", "destination")
    a = enriched_public.filter((F.col("lat") != 0) & (F.col("lng") != 0)).select(
        "event_date", "locality", "lat", "lng")
    j = overlap_join(t, a, "started_at", "ended_at", "event_date")
    c = j.groupBy("trip_key").agg(
        F.avg(F.when(F.col("locality") == F.col("destination"), F.col("lat"))).alias("dlat"),
        F.avg(F.when(F.col("locality") == F.col("destination"), F.col("lng"))).alias("dlng"),
        F.avg("lat").alias("alat"), F.avg("lng").alias("alng"))
    return c.select("trip_key", F.coalesce("dlat", "alat").alias("lat"), F.coalesce("dlng", "alng").alias("lng"))


def weather_summary(trips: DataFrame, centroids: DataFrame, daily_weather: DataFrame,
                    done: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Reduce a supplied daily weather table over each trip window (SRC-25):
    mean of daily means/max/min skipping NULLs, summed precipitation; max
    and min default to the mean; no daily means → no row (retry later).
    Weather rows are matched by coordinates rounded to 2 decimals and by day:
    a trip is one row per day, so one city's trips and days meet by equality."""
    t = trips.select("trip_key", "started_at", "ended_at").join(centroids, "trip_key")
    if done is not None and not force:
        t = t.join(done.select("trip_key"), "trip_key", "left_anti")
    t = t.withColumn("cell", F.concat_ws(",", F.round("lat", 2).cast("string"), F.round("lng", 2).cast("string")))
    w = daily_weather.withColumn("cell", F.concat_ws(",", F.round("lat", 2).cast("string"),
                                                     F.round("lng", 2).cast("string"))).drop("lat", "lng")
    t = t.withColumn("day", F.explode(F.sequence(F.to_date("started_at"), F.to_date("ended_at"))))
    j = t.join(w.withColumn("day", F.to_date("day")), ["cell", "day"])
    g = j.groupBy("trip_key", "lat", "lng").agg(
        F.avg("temperature_2m_mean").alias("temp_mean"), F.avg("temperature_2m_max").alias("tmax"),
        F.avg("temperature_2m_min").alias("tmin"), F.coalesce(F.sum("precipitation_sum"), F.lit(0.0)).alias("precip_mm"))
    g = g.filter(F.col("temp_mean").isNotNull())
    # fixed format of the window summary; whole numbers round half to even
    label = F.concat(F.bround("temp_mean", 0).cast("long").cast("string"), F.lit("°C avg · "),
                     F.bround("precip_mm", 0).cast("long").cast("string"), F.lit("mm rain"))
    one = lambda c: F.bround(c, 1)
    return g.select("trip_key", "lat", "lng", one("temp_mean").alias("temp_mean"),
                    one(F.coalesce("tmax", "temp_mean")).alias("temp_max"),
                    one(F.coalesce("tmin", "temp_mean")).alias("temp_min"), one("precip_mm").alias("precip_mm"),
                    label.alias("summary"))
