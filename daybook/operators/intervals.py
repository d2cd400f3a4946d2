"""Joins of intervals by dyadic decomposition (JON-14, JON-15).

An interval of n days has the length class k with 2**k > n, the least such:
on the grid of cells of 2**k days it touches two cells at most. Two intervals
of classes k and m meet on the grid of the larger class, where both touch two
cells at most. So a row is copied at most twice for each class that occurs on
the other side (some ten), however long the intervals are, and one long
interval among short ones multiplies nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_day(c: Column) -> Column:
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))


def length_class(days: Column) -> Column:
    """The least k with 2**k > days (0 for a single day)."""
    return F.when(days <= 0, F.lit(0)).otherwise(F.length(F.conv(days.cast("string"), 10, 2))).cast("int")


def _cell(day: Column, level: Column | int) -> Column:
    return F.call_function("shiftright", day, F.lit(level) if isinstance(level, int) else level)


def _placed(df: DataFrame, prefix: str, start: str, end: str) -> DataFrame:
    """``df`` with its columns prefixed, and its first and last day and class."""
    out = df.toDF(*[f"{prefix}{c}" for c in df.columns])
    a, b = epoch_day(F.col(f"{prefix}{start}")), epoch_day(F.col(f"{prefix}{end}"))
    out = out.withColumn(f"{prefix}_lo", F.least(a, b)).withColumn(f"{prefix}_hi", F.greatest(a, b))
    return out.withColumn(f"{prefix}_k", length_class(F.col(f"{prefix}_hi") - F.col(f"{prefix}_lo")))


def _copied(df: DataFrame, own: str, others: Column, names: tuple[str, str]) -> DataFrame:
    """A row for each class of the other side and each cell touched on the
    grid of the larger class."""
    mine, theirs = names
    out = df.withColumn(theirs, F.explode(others)).withColumn(mine, F.col(f"{own}_k"))
    level = F.greatest(F.col(mine), F.col(theirs))
    return out.withColumn("__cell", F.explode(F.sequence(_cell(F.col(f"{own}_lo"), level), _cell(F.col(f"{own}_hi"), level))))


def dyadic_overlap_join(left: DataFrame, right: DataFrame, l_start: str, l_end: str, r_start: str, r_end: str,
                        salt: int = 1) -> DataFrame:
    """Pairs of rows whose day ranges overlap (``r_start <= l_end AND r_end >=
    l_start``), each once: in the cell where the later of both starts lies.

    ``salt`` spreads the right rows of one cell over so many tasks, against as
    many copies of the left ones; rows without a start or end meet nothing.
    """
    lcols, rcols = left.columns, right.columns
    L, R = _placed(left, "__l_", l_start, l_end), _placed(right, "__r_", r_start, r_end)
    L, R = L.filter("__l__k IS NOT NULL AND __l__hi IS NOT NULL"), R.filter("__r__k IS NOT NULL AND __r__hi IS NOT NULL")
    # which classes occur: at most 32, a scalar subquery for each side
    classes = {side: df.agg(F.array_sort(F.collect_set(f"{side}_k")).alias("k")).scalar() for side, df in (("__l_", L), ("__r_", R))}
    L = _copied(L, "__l_", classes["__r_"], ("__kl", "__kr"))
    R = _copied(R, "__r_", classes["__l_"], ("__kr", "__kl"))
    keys = ["__kl", "__kr", "__cell"]
    if salt > 1:
        L = L.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        R = R.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`__r_{c}`") for c in rcols]), F.lit(salt)).cast("int"))
        keys.append("__salt")
    later = F.greatest("__l__lo", "__r__lo")
    met = L.join(R, keys).filter(
        (F.col("__cell") == _cell(later, F.greatest("__kl", "__kr")))
        & (epoch_day(F.col(f"`__r_{r_start}`")) <= epoch_day(F.col(f"`__l_{l_end}`")))
        & (epoch_day(F.col(f"`__r_{r_end}`")) >= epoch_day(F.col(f"`__l_{l_start}`"))))
    return met.select(*[F.col(f"`__l_{c}`").alias(c) for c in lcols], *[F.col(f"`__r_{c}`").alias(c) for c in rcols])


def window_sums(windows: DataFrame, start: str, end: str, points: DataFrame, day: str, by: Sequence[str],
                sums: Sequence[str]) -> DataFrame:
    """For every distinct window of days [``start``, ``end``] and every ``by``
    that has points in it, the sums of ``sums`` over the window.

    Points are summed per ``by`` and dyadic block of days, once for each block
    size up to the longest window; a window is the union of at most twice as
    many blocks as its length has binary digits, and meets those. There is no
    row per window and day, and sums of sums are exact for whole numbers.
    """
    w = windows.select(epoch_day(F.col(start)).alias("__a"), (epoch_day(F.col(end)) + 1).alias("__b"),
                       F.col(start), F.col(end)).distinct().filter("__a < __b")
    top = F.coalesce(w.select(F.max(length_class(F.col("__b") - F.col("__a"))).alias("k")).scalar(), F.lit(0))
    # halve [a, b) level by level; an odd edge is a block of its own
    step = """aggregate(sequence(0, 31),
        named_struct('a', __a, 'b', __b, 'out', cast(array() as array<struct<k:int,cell:int>>)),
        (s, k) -> if(s.a >= s.b, s, named_struct(
            'a', shiftright(s.a + (s.a & 1), 1), 'b', shiftright(s.b - (s.b & 1), 1),
            'out', concat(s.out, if(s.a & 1 = 1, array(named_struct('k', k, 'cell', s.a)), array()),
                          if(s.b & 1 = 1 and s.b - 1 >= s.a + (s.a & 1), array(named_struct('k', k, 'cell', s.b - 1)), array())))),
        s -> s.out)"""
    pieces = w.select(start, end, F.explode(F.expr(step)).alias("x")).select(start, end, "x.k", "x.cell")
    daily = points.groupBy(*by, epoch_day(F.col(day)).alias("__day")).agg(*[F.sum(c).alias(c) for c in sums]).filter("__day IS NOT NULL")
    blocks = (daily.withColumn("k", F.explode(F.sequence(F.lit(0), top)))
              .groupBy(*by, "k", _cell(F.col("__day"), F.col("k")).alias("cell")).agg(*[F.sum(c).alias(c) for c in sums]))
    return pieces.join(blocks, ["k", "cell"]).groupBy(start, end, *by).agg(*[F.sum(c).alias(c) for c in sums])
