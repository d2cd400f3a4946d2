"""Date/time helpers (SEM-4, SEM-5, SEM-15, SEM-16, DAT-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: unit lengths used by the readable time-delta text
SECONDS_IN_YEAR = 365 * 86400
SECONDS_IN_MONTH = 2635200  # 30.5 days
SECONDS_IN_DAY = 86400
SECONDS_IN_HOUR = 3600
SECONDS_IN_MINUTE = 60
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def minutes_between(start, end) -> Column:
    """Minute *boundaries* crossed from start to end (SEM-5), as a long.

    00:00:59 → 00:01:01 is 1 (elapsed-time difference would say 0)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _c(start)),
                           F.date_trunc("minute", _c(end)))


def seconds_between(start, end) -> Column:
    """Second boundaries crossed from start to end (SEM-5), as a long."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", _c(start)),
                           F.date_trunc("second", _c(end)))


def iso_dow(ts) -> Column:
    """ISO day of week, Monday = 1 … Sunday = 7 (SEM-4)."""
    return (F.weekday(_c(ts)) + 1).cast("long")


def day_name(ts) -> Column:
    """Three-letter English day name, from the ISO day number."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.get(names, F.weekday(_c(ts)))


def is_weekend(ts) -> Column:
    return F.weekday(_c(ts)) >= 5


def iso_utc(ts) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` (SEM-15); session time zone is UTC."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def wire_ms(ts) -> Column:
    """``YYYY-MM-DD HH:MM:SS.mmm`` wire form (DAT-09)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSS")


def _unit(n: Column, word: str) -> Column:
    return F.when(n > 0, F.concat(n.cast("string"), F.lit(" " + word),
                                  F.when(n == 1, F.lit("")).otherwise(F.lit("s"))))


def readable_delta(seconds) -> Column:
    """Human text such as ``3 hours, 25 minutes and 45 seconds`` (SEM-16).

    Whole seconds; years of 365 days and months of 30.5 days; ``0 seconds``
    for zero. Built from arithmetic and ``concat_ws`` — no UDF."""
    s = F.floor(_c(seconds)).cast("long")
    y = F.floor(s / SECONDS_IN_YEAR)
    r = s - y * SECONDS_IN_YEAR
    mo = F.floor(r / SECONDS_IN_MONTH)
    r = r - mo * SECONDS_IN_MONTH
    d = F.floor(r / SECONDS_IN_DAY)
    r = r - d * SECONDS_IN_DAY
    h = F.floor(r / SECONDS_IN_HOUR)
    r = r - h * SECONDS_IN_HOUR
    mi = F.floor(r / SECONDS_IN_MINUTE)
    sec = r - mi * SECONDS_IN_MINUTE
    parts = F.concat_ws(", ", _unit(y, "year"), _unit(mo, "month"), _unit(d, "day"),
                        _unit(h, "hour"), _unit(mi, "minute"), _unit(sec, "second"))
    joined = F.regexp_replace(parts, ", ([^,]*)$", " and $1")
    return F.when(s <= 0, F.lit("0 seconds")).otherwise(joined)


def age_label(seconds) -> Column:
    """``45s ago`` / ``5m ago`` / ``3h ago`` / ``2d ago`` (STR-19): under 90 s in
    seconds, under 90 min in minutes, under 2 days in hours, else days;
    rounded half up; negative or NULL → ``—``."""
    s = _c(seconds).cast("double")
    def r(x):
        return F.floor(x + 0.5).cast("long").cast("string")
    return (F.when(s.isNull() | (s < 0), F.lit("\u2014"))
            .when(s < 90, F.concat(r(s), F.lit("s ago")))
            .when(s < 5400, F.concat(r(s / 60), F.lit("m ago")))
            .when(s < 172800, F.concat(r(s / 3600), F.lit("h ago")))
            .otherwise(F.concat(r(s / 86400), F.lit("d ago"))))


def day_label(d, as_of_date) -> Column:
    """``Today`` / ``Yesterday`` / ISO date (DAT-14)."""
    diff = F.datediff(F.lit(as_of_date), _c(d))
    return (F.when(diff == 0, F.lit("Today")).when(diff == 1, F.lit("Yesterday"))
            .otherwise(F.date_format(_c(d), "yyyy-MM-dd")))


def as_timestamp(x) -> Column:
    """Drift-proof time column: accepts string or timestamp (DAT-16)."""
    c = _c(x)
    return F.coalesce(F.try_to_timestamp(c.cast("string")), c.cast("timestamp"))


def parse_iso(x) -> Column:
    """ISO-8601 with optional fraction and ``Z``/offset → timestamp or NULL (DAT-08)."""
    s = F.regexp_replace(_c(x), "Z$", "+00:00")
    return F.coalesce(
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss.SSS")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss")),
    )
