"""String helpers (STR-*). Pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace class used by the join-key normaliser: space, \t, \n, \v, \f, \r.
WS_CLASS = "[ \\t\\n\\x0B\\f\\r]"

# fixed values: texts that cannot resolve to a public place (FLT-11)
GEO_JUNK_EXACT = [
    "weather", "time", "news", "translate", "calculator",
    "maps", "google", "home", "work", "directions", "settings",
    "restaurant", "restaurants", "restaurantes", "bar", "bars",
    "cafe", "cafes", "hotel", "hotels", "supermarket", "atm",
    "pharmacy", "parking",
    "zoom", "google meet", "meet", "teams", "microsoft teams", "webex",
    "skype", "phone", "call", "online", "tbd", "n/a",
]
# fixed values: substrings that mark a non-place text (FLT-11)
GEO_JUNK_SUBSTR = [
    "near me", "explored on google maps", "notification",
    "zoom.us", "meet.google", "teams.microsoft", "webex.com", "zoom meeting",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x) -> Column:
    """Trim all leading/trailing whitespace (not only spaces)."""
    return F.regexp_replace(_c(x), "^\\s+|\\s+$", "")


def nonblank(x) -> Column:
    """NULL for NULL / '' (after trimming), else the value."""
    return F.when(F.length(strip_ws(_c(x))) > 0, _c(x))


def first_nonblank(*cols) -> Column:
    """First argument that is neither NULL nor '' (PRJ-05/06, STR-08)."""
    return F.coalesce(*[nonblank(c) for c in cols], F.lit(""))


def text_key(x) -> Column:
    """Join-key normaliser (STR-05): ``'q:' + trim(collapse_ws(lower(x)))``, '' when empty.

    Used by every pipeline that keys places by text so keys cannot drift."""
    norm = F.trim(F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), WS_CLASS + "+", " "))
    return F.when(norm == "", F.lit("")).otherwise(F.concat(F.lit("q:"), norm))


def truncate_ellipsis(x, n: int) -> Column:
    """Clip to ``n`` characters and append ``...`` when clipped (STR-16)."""
    return F.when(F.length(_c(x)) > n, F.concat(F.substring(_c(x), 1, n), F.lit("...")))\
        .otherwise(_c(x))


def join_nonblank(*cols, sep: str = " - ") -> Column:
    """Join the non-blank trimmed parts with ``sep`` (STR-17)."""
    return F.concat_ws(sep, *[F.nullif(F.trim(F.coalesce(_c(c), F.lit(""))), F.lit("")) for c in cols])


def clip(x, n: int) -> Column:
    """Trim and clip to ``n`` characters (STR-20)."""
    return F.substring(strip_ws(F.coalesce(_c(x), F.lit(""))), 1, n)


def enum_normalise(x, allowed: list[str], default: str = "other") -> Column:
    """lower, ``-``/space → ``_``; values outside ``allowed`` → ``default`` (STR-20)."""
    v = F.regexp_replace(F.lower(strip_ws(F.coalesce(_c(x), F.lit("")))), "[- ]", "_")
    return F.when(v.isin(*allowed), v).otherwise(F.lit(default))


def clamp01(x) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(_c(x).cast("double"), F.lit(0.0))))


def url_decode_plus(x) -> Column:
    """Percent-decode including ``+`` → space (STR-10); undecodable → input."""
    return F.coalesce(F.try_url_decode(_c(x)), _c(x))


def url_param(url, name: str) -> Column:
    """Raw value of query parameter ``name`` (``?name=`` or ``&name=``), '' if absent (STR-09)."""
    return F.regexp_extract(_c(url), f"[?&]{name}=([^&#]+)", 1)


def video_id(url) -> Column:
    """11-character id from ``v=`` or ``youtu.be/<id>`` (STR-13); '' if none."""
    u = F.coalesce(_c(url), F.lit(""))
    from_v = F.regexp_extract(u, "[?&]v=([A-Za-z0-9_-]{11})", 1)
    short = F.substring_index(F.substring_index(u, "youtu.be/", -1), "?", 1)
    short_ok = F.when(u.contains("youtu.be/") & (F.length(short) == 11), short)
    return F.coalesce(F.nullif(from_v, F.lit("")), short_ok, F.lit(""))


def channel_id(url) -> Column:
    """Text after ``/channel/`` (STR-14); '' if absent."""
    u = F.coalesce(_c(url), F.lit(""))
    return F.when(u.contains("/channel/"), F.substring_index(u, "/channel/", -1)).otherwise(F.lit(""))


def track_id_from_uri(uri) -> Column:
    """``spotify:track:<id>`` → id; NULL for other URIs (STR-15)."""
    parts = F.split(F.coalesce(_c(uri), F.lit("")), ":")
    ok = (F.size(parts) == 3) & (F.get(parts, 0) == "spotify") & (F.get(parts, 1) == "track") \
        & (F.length(F.get(parts, 2)) > 0)
    return F.when(ok, F.get(parts, 2))


def is_geocodable(x) -> Column:
    """Worth a geocoding lookup at all (FLT-11)."""
    t = F.lower(strip_ws(F.coalesce(_c(x), F.lit(""))))
    junk_sub = None
    for s in GEO_JUNK_SUBSTR:
        cond = t.contains(s)
        junk_sub = cond if junk_sub is None else (junk_sub | cond)
    return ((F.length(t) >= 2)
            & ~t.rlike("^(https?://|www\\.)")
            & ~t.isin(*GEO_JUNK_EXACT)
            & ~junk_sub
            & t.rlike("\\p{L}"))


def stable_id(*cols) -> Column:
    """Deterministic event id (UID-01): sha256 of the ':'-joined parts."""
    return F.sha2(F.concat_ws(":", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]), 256)
