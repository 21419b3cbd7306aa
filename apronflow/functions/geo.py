"""Distances, nearest airport, angles and dead reckoning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
#: The airports' reference points.
AIRPORTS = {"KJFK": (40.6413, -73.7781), "KLGA": (40.7769, -73.8740), "KEWR": (40.6895, -74.1745)}


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon))


def nearest_airport(lat: Column, lon: Column) -> Column:
    """A struct (dist_km, airport) of the nearest reference point; null without a position."""
    near = F.array(*[F.struct(haversine_km(lat, lon, F.lit(a), F.lit(b)).alias("dist_km"), F.lit(code).alias("airport")) for code, (a, b) in AIRPORTS.items()])
    return F.when(lat.isNotNull() & lon.isNotNull(), F.array_min(near))


def track_delta(a: Column, b: Column) -> Column:
    """Signed shortest turn from a to b in degrees, over (-180, 180]."""
    d = F.pmod(b - a + 180.0, F.lit(360.0)) - 180.0
    return F.when(d == -180.0, 180.0).otherwise(d)


def dead_reckon(lat: Column, lon: Column, track_deg: Column, velocity_ms: Column, elapsed_s: Column, most_s: float = 45.0) -> tuple[Column, Column]:
    """Latitude and longitude after elapsed_s (at most most_s) on the same course, over a flat earth.

    Without track or velocity, or at a standstill, the position stays.
    """
    moves = track_deg.isNotNull() & velocity_ms.isNotNull() & (velocity_ms > 0) & (elapsed_s > 0)
    turned = velocity_ms * F.least(elapsed_s.cast("double"), F.lit(most_s)) / (EARTH_KM * 1000)
    north = lat + F.degrees(turned * F.cos(F.radians(track_deg)))
    east = lon + F.degrees(turned * F.sin(F.radians(track_deg)) / F.cos(F.radians(lat)))
    return F.when(moves, north).otherwise(lat), F.when(moves, east).otherwise(lon)
