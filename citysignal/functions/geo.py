"""Great-circle distance and radius tests as plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from citysignal.config import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), F.lit(2.0))
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def bounding_box(lat: float, lon: float, radius_km: float) -> tuple[float, float, float, float]:
    """``(south, north, west, east)`` in degrees around a circle, slightly enlarged.

    Longitudes are left open (-180..180) where the circle touches a pole or the
    date line.
    """
    angle = radius_km / EARTH_RADIUS_KM
    slack = 1e-9
    dlat = math.degrees(angle) + slack
    south, north = lat - dlat, lat + dlat
    if south <= -90 or north >= 90:
        return max(south, -90.0), min(north, 90.0), -180.0, 180.0
    dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + slack
    if lon - dlon < -180 or lon + dlon > 180:
        return south, north, -180.0, 180.0
    return south, north, lon - dlon, lon + dlon


def within_km(
    lat: Column, lon: Column, centre: tuple[float, float], radius_km: float
) -> Column:
    """Points within the radius; the box comparisons reach the Parquet scan."""
    south, north, west, east = bounding_box(*centre, radius_km)
    near = haversine_km(F.lit(centre[0]), F.lit(centre[1]), lat, lon) <= F.lit(radius_km)
    return lat.between(south, north) & lon.between(west, east) & near
