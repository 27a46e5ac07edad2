"""Great-circle distance on (lon, lat)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_M = 6372797.560856
#: Metres in each unit (fixed values).
UNITS = {"m": 1.0, "km": 1000.0, "mi": 1609.344, "ft": 0.3048}


def lon_lat(c: Column, kind: T.DataType | None) -> tuple[Column, Column]:
    """Longitude and latitude of a struct column or of a "lon,lat" string."""
    if isinstance(kind, T.StringType):
        parts = F.split(c, ",")
        return F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    return c["lon"].cast("double"), c["lat"].cast("double")


def haversine(lon: Column, lat: Column, lon0: float, lat0: float) -> Column:
    """Metres to a constant point."""
    a = F.pow(F.sin((F.radians(lat) - math.radians(lat0)) / 2), F.lit(2.0)) + math.cos(math.radians(lat0)) * F.cos(F.radians(lat)) * F.pow(
        F.sin((F.radians(lon) - math.radians(lon0)) / 2), F.lit(2.0)
    )
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within(lon: Column, lat: Column, lon0: float, lat0: float, metres: float) -> Column:
    """Inside the radius; a band of latitudes, cheap and easy to push down, comes first."""
    band = math.degrees(metres / EARTH_M) + 1e-9
    return lat.between(lat0 - band, lat0 + band) & (haversine(lon, lat, lon0, lat0) <= metres)
