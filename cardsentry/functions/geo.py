"""Great-circle distance and travel speed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean earth radius in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points in degrees; null when a coordinate is null."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = (half_lat * half_lat
             + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def km_per_hour(km: Column, gap_ms: Column) -> Column:
    """Speed over a gap; null for a gap that is not positive."""
    return F.when(gap_ms > 0, km / (gap_ms / F.lit(3600000.0)))
