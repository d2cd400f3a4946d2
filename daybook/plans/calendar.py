"""Calendar models: silver events and geo evidence, gold KPIs, histograms,
categories, grid, upcoming (§2.K)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.geo import haversine_m
from daybook.functions.numeric import round_half, safe_div
from daybook.functions.text import text_key
from daybook.functions.timefn import DAY_NAMES, iso_dow, iso_utc, minutes_between
from daybook.operators.merge import attach_scalar
from daybook.operators.spine import densify, int_spine
from daybook.operators.topn import top_n
from daybook.plans.base import floor_date, now, s, today
from daybook.sources.tables import read_table

# fixed value: title keywords that mark travel
TRAVEL_TITLE_RE = ("(flight|fly to|airport|boarding|layover|✈|hotel|airbnb|hostel|check[ -]?in|check[ -]?out|"
                   "trip to|travel to|vacation|holiday|getaway|cruise|train to|ferry|road trip)")


def silver_calendar_events(spark: SparkSession, cfg: Cfg) -> DataFrame:
    """Latest version first, then drop cancelled (SEM-22); category from the
    alias table, else 'Personal' for '@' names, else the calendar name."""
    e = read_table(spark, cfg, "calendar_events").filter(F.col("status") != "cancelled")
    al = read_table(spark, cfg, "calendar_category_aliases").select("calendar_name", "display_category")
    j = e.join(al, "calendar_name", "left")
    mins = minutes_between("started_at", "ended_at")
    st = F.col("started_at")
    category = (F.when(s("display_category") != "", F.col("display_category"))
                .when(F.instr(s("calendar_name"), "@") > 0, F.lit("Personal")).otherwise(s("calendar_name")))
    all_day = (F.hour(st) == 0) & (F.minute(st) == 0) & (mins >= 1440) & (mins % 1440 == 0)
    return j.select(
        "event_id", "calendar_id", "calendar_name", category.alias("category"), "started_at", "ended_at",
        s("title").alias("title"), s("description").alias("description"), s("location").alias("location"),
        "status", F.coalesce("attendee_count", F.lit(0)).alias("attendee_count"),
        s("recurrence_id").alias("recurrence_id"), F.to_date(st).alias("event_date"),
        F.hour(st).alias("hour_of_day"), mins.alias("duration_minutes"), iso_dow(st).cast("int").alias("day_of_week"),
        (iso_dow(st) >= 6).cast("int").alias("is_weekend"), all_day.cast("int").alias("is_all_day"))


def silver_calendar_geo(spark: SparkSession, cfg: Cfg, events: DataFrame | None = None,
                        home: DataFrame | None = None) -> DataFrame:
    """Events keyed with the same text key as Maps, joined to the resolved
    catalog (sentinels dropped), with distance to home and travel signals."""
    from daybook.plans.maps import silver_home_base
    e = events if events is not None else silver_calendar_events(spark, cfg)
    e = e.withColumn("loc_key", F.when(F.col("location") != "", text_key("location")).otherwise(F.lit("")))
    c = read_table(spark, cfg, "maps_place_catalog").filter(F.col("match_type") != "unresolved").select(
        F.col("place_id").alias("loc_key"), F.col("locality").alias("geo_locality"),
        F.col("country").alias("geo_country"), F.col("country_code").alias("geo_country_code"),
        F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"), F.col("match_confidence").alias("c_conf"))
    h = home if home is not None else silver_home_base(spark, cfg)
    j = attach_scalar(e.join(c, "loc_key", "left"), h.select("home_country", "home_lat", "home_lng"))
    lat, lng = F.coalesce("c_lat", F.lit(0.0)), F.coalesce("c_lng", F.lit(0.0))
    dist = haversine_m(lat, lng, F.col("home_lat"), F.col("home_lng"))
    travel = F.lower(F.col("title")).rlike(TRAVEL_TITLE_RE)
    foreign = (s("geo_country") != "") & (s("geo_country") != F.col("home_country"))
    far = (lat != 0) & (lng != 0) & (dist > cfg.far_km * 1000)
    return j.select(
        "event_id", "calendar_id", "calendar_name", "category", "started_at", "ended_at", "event_date", "title",
        "location", "attendee_count", "duration_minutes", "is_all_day", s("geo_locality").alias("geo_locality"),
        s("geo_country").alias("geo_country"), s("geo_country_code").alias("geo_country_code"),
        lat.alias("lat"), lng.alias("lng"), F.coalesce("c_conf", F.lit(0.0)).cast("float").alias("match_confidence"),
        "home_country",
        F.when((lat != 0) | (lng != 0), round_half(dist / 1000.0, 1)).otherwise(F.lit(0.0)).alias("km_from_home"),
        (F.to_date("ended_at") > F.to_date("started_at")).cast("int").alias("is_multi_day"),
        travel.cast("int").alias("is_travel_title"), foreign.cast("int").alias("is_foreign"),
        far.cast("int").alias("is_far"), (travel | foreign | far).cast("int").alias("corroborates_travel"))


def _timed_past(spark, cfg, events=None):
    e = events if events is not None else silver_calendar_events(spark, cfg)
    return e.filter((F.col("is_all_day") == 0) & (F.col("started_at") <= now(cfg))
                    & (F.col("event_date") >= floor_date(cfg)))


def gold_calendar_kpis(spark: SparkSession, cfg: Cfg, events=None) -> DataFrame:
    ev = _timed_past(spark, cfg, events)
    k = ev.agg(F.count_if(F.col("attendee_count") > 0).alias("plansCount"), F.count(F.lit(1)).alias("totalEvents"),
               F.sum("duration_minutes").alias("__mins"), F.countDistinct("event_date").alias("__days"))
    ws = ev.groupBy("day_of_week").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    busiest = ws.agg(F.max(F.struct("n", (-F.col("day_of_week")).alias("d"))).alias("b")).select(
        F.coalesce(F.get(names, -F.col("b.d") - 1), F.lit("Mon")).alias("busiestDay"))
    span = (cfg.as_of.date() - cfg.kpi_start_date).days
    one = attach_scalar(k, busiest)
    return one.select(
        "plansCount", F.greatest(F.lit(0), F.lit(span) - F.col("__days")).cast("long").alias("freeDays"),
        "totalEvents", F.coalesce(round_half(F.col("__mins") / 60.0, 0), F.lit(0.0)).cast("long").alias("meetingHours"),
        F.coalesce(round_half(safe_div(F.col("totalEvents"), F.col("__days")), 1), F.lit(0.0)).alias("avgDaily"),
        "busiestDay")


def gold_calendar_busy_hours(spark: SparkSession, cfg: Cfg, events=None) -> DataFrame:
    c = _timed_past(spark, cfg, events).groupBy(F.col("hour_of_day").cast("long").alias("h")).agg(
        F.count(F.lit(1)).alias("events"))
    d = densify(int_spine(spark, "h", 24), c, ["h"], {"events": 0})
    return d.orderBy("h").select(F.concat(F.col("h").cast("string"), F.lit(":00")).alias("hour"),
                                 F.col("events").cast("long"))


def gold_calendar_categories(spark: SparkSession, cfg: Cfg, events=None) -> DataFrame:
    e = events if events is not None else silver_calendar_events(spark, cfg)
    b = e.filter((F.col("started_at") <= now(cfg)) & (F.col("event_date") >= floor_date(cfg)))
    g = b.groupBy(F.col("category").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    tot = F.sum("value").over(Window.partitionBy())  # over per-category rows only
    return g.select("name", "value", F.coalesce(round_half(safe_div(F.col("value"), tot) * 100.0, 0), F.lit(0.0))
                    .alias("percentage")).orderBy(F.col("value").desc())


def gold_calendar_weekday_breakdown(spark: SparkSession, cfg: Cfg, events=None) -> DataFrame:
    days = spark.createDataFrame([(i + 1, n) for i, n in enumerate(DAY_NAMES)], "dow int, day string")
    c = _timed_past(spark, cfg, events).groupBy(F.col("day_of_week").alias("dow")).agg(F.count(F.lit(1)).alias("events"))
    return densify(days, c, ["dow"], {"events": 0}).orderBy("dow").select("day", F.col("events").cast("long"))


def gold_calendar_daily_events(spark: SparkSession, cfg: Cfg, events=None) -> DataFrame:
    e = events if events is not None else silver_calendar_events(spark, cfg)
    e = e.filter(F.col("event_date").between(F.date_sub(today(cfg), 371), today(cfg)))
    return e.groupBy(F.col("event_date").alias("date")).agg(F.count(F.lit(1)).alias("events")).orderBy("date")


def gold_calendar_week_grid(spark: SparkSession, cfg: Cfg, events=None) -> DataFrame:
    """168 slots, intensity = slot count / busiest slot (rounded to 2)."""
    grid = spark.range(168, numPartitions=1).select((F.col("id") / 24).cast("int").alias("day"),
                                                    (F.col("id") % 24).cast("int").alias("hour"))
    c = _timed_past(spark, cfg, events).groupBy((F.col("day_of_week") - 1).alias("day"),
                                                F.col("hour_of_day").alias("hour")).agg(F.count(F.lit(1)).alias("c"))
    g = grid.join(c, ["day", "hour"], "left")
    mx = F.max("c").over(Window.partitionBy())  # over the fixed 168 rows
    return g.select("day", "hour", F.coalesce(round_half(safe_div(F.col("c"), mx), 2), F.lit(0.0)).alias("intensity")) \
        .orderBy("day", "hour")


def gold_calendar_upcoming_events(spark: SparkSession, cfg: Cfg, events=None) -> DataFrame:
    e = events if events is not None else silver_calendar_events(spark, cfg)
    up = top_n(e.filter((F.col("started_at") >= now(cfg)) & (F.col("is_all_day") == 0)), 8,
               [F.col("started_at"), F.col("event_id")])
    return up.select("title", "category", iso_utc("started_at").alias("time"),
                     F.col("duration_minutes").alias("durationMinutes"))


def gap_kpis(spark: SparkSession, cfg: Cfg, events=None, by: Sequence[str] = ()) -> DataFrame:
    """Per day: longest unscheduled span between timed events and a
    fragmentation count (gaps between consecutive events) (WIN-09, an
    extension the design documents). A gap runs from the latest end so far to
    the next start, so an event inside a longer one makes none. With
    ``by=["calendar_id"]`` the spans are those of each calendar; without it a
    day holds all calendars: free time is free of any of them. Events of the
    same start are summed first, so the window holds the distinct starts of a
    day, however many calendars share them."""
    ev = _timed_past(spark, cfg, events).groupBy(*by, "event_date", "started_at").agg(
        F.max("ended_at").alias("ended_at"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by, "event_date").orderBy("started_at")
    busy = F.max("ended_at").over(w.rowsBetween(Window.unboundedPreceding, 0))
    g = ev.withColumn("__next", F.lead("started_at").over(w)).withColumn("__busy", busy).withColumn(
        "__gap", F.when(F.col("__next") > F.col("__busy"), minutes_between("__busy", "__next")))
    return g.groupBy(*by, "event_date").agg(F.coalesce(F.max("__gap"), F.lit(0)).alias("longest_gap_minutes"),
                                            F.count("__gap").alias("fragments"), F.sum("__n").alias("events"))
