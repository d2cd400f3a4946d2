"""Numeric helpers (SEM-6, SEM-7, SEM-8, SEM-14, AGG-17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def round_half(x, n: int = 0) -> Column:
    """The one rounding helper (SEM-6): half away from zero. Switch to
    ``F.bround`` here for half-even."""
    return F.round(_c(x), n)


def safe_div(num, den) -> Column:
    """Division that yields NULL instead of raising on a zero divisor (SEM-7)."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def finite_or_zero(x) -> Column:
    """NaN / NULL / ±inf → 0.0 (SEM-8, ``ifNotFinite``)."""
    v = _c(x).cast("double")
    return (F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0))
            .otherwise(v))


def pct(part, total, digits: int = 1) -> Column:
    """Percent of total with a zero guard, rounded (AGG-17)."""
    return round_half(F.coalesce(safe_div(part, total) * 100.0, F.lit(0.0)), digits)


def fmt_num(x, digits: int = 1) -> Column:
    """Number text without a trailing ``.0`` (SEM-14): 12.0 → '12', 12.5 → '12.5'."""
    s = round_half(_c(x).cast("double"), digits).cast("string")
    return F.regexp_replace(s, r"\.0$", "")


def quantize_level(v, vmax, levels: int = 5) -> Column:
    """Quantise a ratio to ``levels`` steps, 0 for empty (MTH-07)."""
    ratio = safe_div(v, vmax)
    lvl = F.least(F.floor(ratio * levels) + 1, F.lit(levels)) / levels
    return F.when(_c(v) <= 0, F.lit(0.0)).otherwise(F.coalesce(lvl, F.lit(0.0)))
