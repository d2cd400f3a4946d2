"""Human inputs as validated appends: trip labels (SNK-11) and home
anchors (SNK-17, JON-16, WIN-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.config import Cfg
from daybook.functions.text import clip
from daybook.sources.tables import append, read_table

# fixed values: accepted label verbs, the trip key pattern and clip lengths
LABELS = ["confirm", "reject", "edit"]
TRIP_KEY_RE = "^\\d{4}-\\d{2}-\\d{2}_\\d{4}-\\d{2}-\\d{2}$"
EDIT_CLIP = {"edited_title": 200, "edited_destination": 200, "edited_trip_type": 32}
NOTE_CLIP = 500


def validate_labels(posted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with a reason). Key pattern and label
    set are checked; edit fields are blanked unless the label is ``edit``;
    texts are clipped."""
    reason = (F.when(~F.coalesce(F.col("trip_key"), F.lit("")).rlike(TRIP_KEY_RE), F.lit("bad trip_key"))
              .when(~F.coalesce(F.col("label"), F.lit("")).isin(*LABELS), F.lit("bad label")))
    p = posted.withColumn("reason", reason)
    is_edit = F.col("label") == "edit"
    ok = p.filter(F.col("reason").isNull()).select(
        "trip_key", "label",
        *[F.when(is_edit, clip(F.col(c), n)).otherwise(F.lit("")).alias(c) for c, n in EDIT_CLIP.items()],
        clip(F.col("note"), NOTE_CLIP).alias("note"))
    return ok, p.filter(F.col("reason").isNotNull())


def post_labels(spark: SparkSession, cfg: Cfg, posted: DataFrame) -> DataFrame:
    ok, bad = validate_labels(posted)
    append(ok, cfg, "maps_trip_labels")
    return bad


def set_home(spark: SparkSession, cfg: Cfg, anchors: DataFrame) -> None:
    """Append home anchors (valid_from, lat, lng, radius_km, label)."""
    append(anchors, cfg, "maps_home_locations")


def home_on_date(spark: SparkSession, cfg: Cfg, days: DataFrame, day: str = "event_date") -> DataFrame:
    """The home anchor valid on each date (as-of lookup): the anchor of the
    latest ``valid_from`` up to that date; dates before the first have none.

    The lookup runs over the distinct dates (bounded by the calendar, not by
    the rows) merged with the anchors in date order; the rows then meet it by
    equality on the date."""
    home = F.struct(F.col("lat").alias("home_lat"), F.col("lng").alias("home_lng"), F.col("label").alias("home_label"))
    anchors = read_table(spark, cfg, "maps_home_locations").select(
        F.to_date("valid_from").alias("__day"), F.lit(0).alias("__asked"), F.col("valid_from").alias("__from"),
        home.alias("__home"))
    asked = days.select(F.to_date(F.col(day)).alias("__day")).filter("__day IS NOT NULL").distinct().select(
        "__day", F.lit(1).alias("__asked"), F.lit(None).cast(anchors.schema["__from"].dataType).alias("__from"),
        F.lit(None).cast(anchors.schema["__home"].dataType).alias("__home"))
    w = Window.orderBy("__day", "__asked", "__from").rowsBetween(Window.unboundedPreceding, 0)
    known = anchors.unionByName(asked).withColumn("__home", F.last("__home", ignorenulls=True).over(w)) \
        .filter("__asked = 1").select("__day", "__home.*")
    return days.withColumn("__day", F.to_date(F.col(day))).join(known, "__day", "left").drop("__day")
