"""Small helpers shared by the model modules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.config import Cfg


def now(cfg: Cfg) -> Column:
    """``now()`` of the reference = the configured ``as_of`` (SEM-12/13)."""
    return F.lit(cfg.as_of).cast("timestamp")


def today(cfg: Cfg) -> Column:
    return F.lit(cfg.as_of.date())


def floor_ts(cfg: Cfg) -> Column:
    """The shared KPI date floor as a timestamp (FLT-02)."""
    return F.lit(dt.datetime.combine(cfg.kpi_start_date, dt.time())).cast("timestamp")


def floor_date(cfg: Cfg) -> Column:
    return F.lit(cfg.kpi_start_date)


def s(c) -> Column:
    """String column with '' for NULL (SEM-1 output default)."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def first_or_empty(arr) -> Column:
    """``arr[1]`` with the safe-index rule: '' when absent (SEM-11)."""
    return F.coalesce(F.get(F.col(arr) if isinstance(arr, str) else arr, 0), F.lit(""))


def not_empty(arr) -> Column:
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.coalesce(F.size(a), F.lit(0)) > 0


def place_label(prefix: str = "") -> Column:
    """'neighbourhood, locality' / locality / country / 'Unknown'."""
    n, lo, c = (F.col(prefix + x) for x in ("neighborhood", "locality", "country"))
    return (F.when((n != "") & (lo != ""), F.concat(n, F.lit(", "), lo))
            .when(lo != "", lo).when(c != "", c).otherwise(F.lit("Unknown")))
