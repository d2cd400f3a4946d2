"""Maps activity text rules (STR-09..12, SRC-12)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.text import strip_ws, url_decode_plus, url_param

# fixed values: title prefixes of Maps activity exports
P_SEARCH = "Searched for "
P_DIR_FROM = "Directions from "
P_DIR_TO = "Directions to "
P_VIEW = "Viewed area around "
P_USED = ("Used Maps", "Used the ")


def _after(t: Column, prefix: str) -> Column:
    return F.regexp_replace(t, "^" + re.escape(prefix), "")


def classify_title(title) -> Column:
    """Struct (activity_type, query, place_name, origin, destination) of a title.

    Trimmed title; first matching prefix wins; ``Directions from X to Y``
    splits on the first `` to ``; any other non-empty title is a viewed
    place."""
    t = strip_ws(F.coalesce(F.col(title) if isinstance(title, str) else title, F.lit("")))
    rest_from = _after(t, P_DIR_FROM)
    has_to = F.instr(rest_from, " to ") > 0
    from_origin = F.when(has_to, strip_ws(F.substring_index(rest_from, " to ", 1))).otherwise(strip_ws(rest_from))
    from_dest = F.when(has_to, strip_ws(F.regexp_extract(rest_from, "(?s)^.*? to (.*)$", 1))).otherwise(F.lit(""))
    is_empty = t == ""
    is_search = t.startswith(P_SEARCH)
    is_from = t.startswith(P_DIR_FROM)
    is_to = t.startswith(P_DIR_TO)
    is_view = t.startswith(P_VIEW)
    is_used = t.startswith(P_USED[0]) | t.startswith(P_USED[1])
    e = F.lit("")
    atype = (F.when(is_empty, "other").when(is_search, "search").when(is_from, "directions")
             .when(is_to, "directions").when(is_view, "view_place").when(is_used, "other")
             .otherwise("view_place"))
    query = F.when(~is_empty & is_search, strip_ws(_after(t, P_SEARCH))).otherwise(e)
    place = (F.when(is_empty | is_search | is_from | is_to | is_used, e)
             .when(is_view, strip_ws(_after(t, P_VIEW))).otherwise(t))
    origin = F.when(~is_empty & ~is_search & is_from, from_origin).otherwise(e)
    dest = (F.when(is_empty | is_search, e).when(is_from, from_dest)
            .when(is_to, strip_ws(_after(t, P_DIR_TO))).otherwise(e))
    return F.struct(atype.alias("activity_type"), query.alias("query"), place.alias("place_name"),
                    origin.alias("origin"), dest.alias("destination"))


def url_query(url) -> Column:
    """Decoded ``q=`` parameter of a Maps URL, '' when absent (STR-09/10)."""
    raw = url_param(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), "q")
    return F.when(raw == "", F.lit("")).otherwise(url_decode_plus(raw))


def url_ftid(url) -> Column:
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    return F.regexp_extract(u, "[?&]ftid=([0-9a-fA-Fx:]+)", 1)


def url_latlng(url) -> Column:
    """Struct(lat, lng) from ``!3d<lat>!4d<lng>`` in the URL path, 0/0 if absent (STR-11)."""
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    pat = "!3d(-?\\d+\\.\\d+)!4d(-?\\d+\\.\\d+)"
    lat = F.regexp_extract(u, pat, 1).try_cast("double")
    lng = F.regexp_extract(u, pat, 2).try_cast("double")
    ok = lat.isNotNull() & lng.isNotNull()
    return F.struct(F.when(ok, lat).otherwise(F.lit(0.0)).alias("lat"),
                    F.when(ok, lng).otherwise(F.lit(0.0)).alias("lng"))
