"""Great-circle distance (MTH-03/04, SEM-18). R = 6371 km."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Haversine distance in km between (lat1, lng1) and (lat2, lng2), degrees."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlng = F.radians(_c(lng2) - _c(lng1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    return haversine_km(lat1, lng1, lat2, lng2) * 1000.0


def has_coords(lat, lng) -> Column:
    """lat = 0 AND lng = 0 means "no coordinates" (SEM-19)."""
    return ~((F.coalesce(_c(lat), F.lit(0.0)) == 0) & (F.coalesce(_c(lng), F.lit(0.0)) == 0))
