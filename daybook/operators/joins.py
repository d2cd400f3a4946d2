"""Join helpers for the joins Spark has no single operator for.

* ``overlap_join``      interval-overlap / point-in-window join (JON-14/15)
* ``band_anti_join``    same key within ±N seconds, anti form (JON-10)
* ``within_radius_flag`` spatial theta semi-join flag (JON-09)
* ``valid_intervals``   piecewise validity from the next start (JON-16, WIN-08)

All of them turn the theta condition into an equi-join on a bucket (a day,
a time slice, a grid cell) plus an exact residual predicate, so Spark can
hash-partition the work; none of them compares all pairs within a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.geo import haversine_m
from daybook.operators.intervals import dyadic_overlap_join

KM_PER_DEGREE = 6371.0 * 3.141592653589793 / 180.0


def _epoch_s(c: Column) -> Column:
    """Seconds since the epoch for a timestamp or timestamp_ntz column."""
    return F.unix_micros(c.cast("timestamp")) / 1_000_000


def overlap_join(left: DataFrame, right: DataFrame, l_start: str, l_end: str,
                 r_start: str, r_end: str | None = None, how: str = "inner", salt: int = 1) -> DataFrame:
    """Pairs whose day ranges overlap: ``r_start <= l_end AND r_end >= l_start``
    (a point in a window when ``r_end`` is left out).

    Works on dates (or timestamps truncated to dates), by dyadic cells
    (``intervals.dyadic_overlap_join``): every pair is produced exactly once,
    and no side is copied by the length of an interval. With ``salt > 1`` a
    cell holding a large share of the right rows is spread over ``salt`` tasks.
    ``how`` may be ``inner`` or ``left`` (left rows without a partner kept).
    """
    lcols, rcols = left.columns, right.columns
    joined = dyadic_overlap_join(left, right, l_start, l_end, r_start, r_end or r_start, salt)
    if how == "inner":
        return joined
    if how == "left":
        met = joined.select(*[F.col(f"`{c}`").alias(f"__m{i}") for i, c in enumerate(lcols)]).distinct()
        missing = left.join(met, [F.col(f"`{c}`").eqNullSafe(F.col(f"__m{i}")) for i, c in enumerate(lcols)], "left_anti")
        for c in rcols:
            missing = missing.withColumn(c, F.lit(None).cast(right.schema[c].dataType))
        return joined.unionByName(missing)
    raise ValueError(how)


def band_anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str], l_ts: str, r_ts: str,
                   window_s: int) -> DataFrame:
    """Rows of ``left`` with no ``right`` row of the same keys within
    ±``window_s`` seconds (inclusive, on second boundaries).

    Time is cut into slices of ``window_s`` seconds; each right row is copied
    to its own slice and both neighbours, so a left row only meets right rows
    of its own key and slice. The hash join on (keys, slice) keeps the work
    linear even when one key holds most rows.
    """
    width = max(int(window_s), 1)
    rk = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col(r_ts).alias("__r_ts"))
    rk = rk.withColumn("__slice", F.explode(F.array(
        *[F.floor(_epoch_s(F.col("__r_ts")) / width) + d for d in (-1, 0, 1)])))
    lk = left.withColumn("__slice", F.floor(_epoch_s(F.col(l_ts)) / width))
    diff = F.abs(F.timestamp_diff("SECOND", F.date_trunc("second", lk[l_ts]),
                                 F.date_trunc("second", rk["__r_ts"])))
    cond = [lk[k] == rk[f"__r_{k}"] for k in keys] + [lk["__slice"] == rk["__slice"], diff <= window_s]
    return lk.join(rk, cond, "left_anti").drop("__slice")


def within_radius_flag(points: DataFrame, places: DataFrame, lat: str, lng: str,
                       flag: str = "is_private", p_lat: str = "lat", p_lng: str = "lng",
                       p_radius_m: str = "radius_m", zero_rule: str = "both") -> DataFrame:
    """Add ``flag`` = 1 when a point lies within the radius of any place.

    Nested grids, one for each class of radii (powers of two): a place is
    copied to the cells of its own class's grid that its radius reaches, a few
    at most (the longitude span widened by 1/cos(latitude), wrapping at ±180°,
    all cells near the poles), and a position is looked up once in each class
    that occurs. A large place among small ones keeps their cells small.
    Candidates meet by an equi-join on (class, cell) and are confirmed with the
    exact haversine. They always meet in a shuffle: Spark judges the cells by the
    size of the place table before the copies, and would collect and broadcast
    the copies of a large list through the driver.

    Distinct positions are looked up, and their flags joined back: every point
    appears exactly once, no pair list is materialised, and a crowded cell or
    position is split by Spark's skew handling.
    Points without coordinates never match: ``zero_rule="both"`` treats
    only 0/0 as missing, ``"either"`` any zero coordinate (the Maps model's
    rule). An empty place list gives 0.
    """
    P = (places.select(F.col(p_lat).cast("double").alias("__plat"),
                       F.col(p_lng).cast("double").alias("__plng"),
                       F.col(p_radius_m).cast("double").alias("__prad"))
         .filter("__plat IS NOT NULL AND __plng IS NOT NULL AND __prad > 0").distinct())
    # class k: radii up to 2**k metres; its cells are a whole number around the globe, at least that wide
    P = P.withColumn("__pk", F.least(F.ceil(F.log2(F.greatest("__prad", F.lit(16.0)))), F.lit(25)).cast("int"))
    kinds = P.agg(F.collect_set("__pk").alias("k")).scalar()  # at most 22 of them

    def ncells(k: Column) -> Column:
        width = F.pow(F.lit(2.0), k) / 1000.0 / KM_PER_DEGREE
        return F.greatest(F.floor(360.0 / width), F.lit(1)).cast("long")

    around = ncells(F.col("__pk"))
    cell = 360.0 / around
    dlat = F.col("__prad") / 1000.0 / KM_PER_DEGREE
    band = F.least(F.abs(F.col("__plat")) + dlat, F.lit(90.0))
    cosb = F.cos(F.radians(band))
    dlng = F.when(cosb < 1e-6, F.lit(360.0)).otherwise(dlat / cosb)
    lat_cells = F.sequence(F.floor((F.col("__plat") + 90.0 - dlat) / cell).cast("long"),
                           F.floor((F.col("__plat") + 90.0 + dlat) / cell).cast("long"))
    # where a span would take very many cells of one row of the grid (near a pole), the row is one cell
    wide = dlng * 2 >= F.least(F.lit(360.0), 64 * cell)
    lng_cells = F.when(wide, F.array(F.lit(-1).cast("long")))\
        .otherwise(F.array_distinct(F.transform(
            F.sequence(F.floor((F.col("__plng") + 180.0 - dlng) / cell).cast("long"),
                       F.floor((F.col("__plng") + 180.0 + dlng) / cell).cast("long")),
            lambda j: F.pmod(j, around))))
    Pc = P.withColumn("__pcy", F.explode(lat_cells)).withColumn("__pcx", F.explode(lng_cells))
    x, y = F.col(lat).cast("double"), F.col(lng).cast("double")
    has_xy = (~((x == 0) & (y == 0)) if zero_rule == "both" else ((x != 0) & (y != 0)))
    spots = points.filter(has_xy).select(x.alias("__x"), y.alias("__y")).distinct()
    n = ncells(F.col("__k"))
    seen = spots.withColumn("__k", F.explode(kinds)).withColumn("__cy", F.floor((F.col("__x") + 90.0) / (360.0 / n)).cast("long")) \
        .withColumn("__cx", F.explode(F.array(F.pmod(F.floor((F.col("__y") + 180.0) / (360.0 / n)).cast("long"), n), F.lit(-1).cast("long"))))
    near = [F.col("__k") == F.col("__pk"), F.col("__cy") == F.col("__pcy"), F.col("__cx") == F.col("__pcx"),
            haversine_m(F.col("__x"), F.col("__y"), F.col("__plat"), F.col("__plng")) <= F.col("__prad")]
    hits = seen.join(Pc.hint("merge"), near, "left_semi").select("__x", "__y").distinct().withColumn(flag, F.lit(1))
    return points.join(hits, [x == hits["__x"], y == hits["__y"]], "left").select(
        *[points[c] for c in points.columns if c != flag], F.coalesce(hits[flag], F.lit(0)).cast("int").alias(flag))


def valid_intervals(anchors: DataFrame, entity: Sequence[str], valid_from: str,
                    until: str = "valid_until", open_end=None) -> DataFrame:
    """``valid_until`` = next ``valid_from`` of the same entity (WIN-08);
    the last anchor stays open (``open_end`` or NULL)."""
    w = Window.partitionBy(*entity).orderBy(F.col(valid_from))
    nxt = F.lead(F.col(valid_from), 1).over(w)
    if open_end is not None:
        nxt = F.coalesce(nxt, F.lit(open_end).cast(anchors.schema[valid_from].dataType))
    return anchors.withColumn(until, nxt)
