"""Great-circle distance and distance bands as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used by the distance formula.
EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km; any argument may be a column name, Column or number."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(radius_km) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def distance_band(col, near: float = 50.0, far: float = 100.0) -> Column:
    """``< near`` Near, ``near..far`` (inclusive) Medium, otherwise (also null) Far."""
    c = _c(col)
    return (F.when(c < near, "Near")
            .when((c >= near) & (c <= far), "Medium")
            .otherwise("Far"))
