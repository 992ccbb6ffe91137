"""Grid snapping, coverage tests and great-circle distance as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from daygrid import fixed_values as fixed


@dataclass(frozen=True)
class Grid:
    """A regular latitude/longitude grid and the box it covers (inclusive)."""

    resolution: float = fixed.GRID_RESOLUTION_DEGREES
    decimals: int = fixed.GRID_DECIMALS
    min_lat: float = fixed.MIN_LATITUDE
    max_lat: float = fixed.MAX_LATITUDE
    min_lon: float = fixed.MIN_LONGITUDE
    max_lon: float = fixed.MAX_LONGITUDE

    def snap(self, coordinate: Column) -> Column:
        """Nearest grid line. The second rounding removes the float noise of ``n * resolution``."""
        steps = F.round(coordinate / F.lit(self.resolution), 0)
        return F.round(steps * F.lit(self.resolution), self.decimals)

    def covers(self, lat: Column, lon: Column) -> Column:
        return lat.between(self.min_lat, self.max_lat) & lon.between(self.min_lon, self.max_lon)


def cell_key(lat: Column, lon: Column) -> Column:
    """``lat,lon`` as text. A double prints without trailing zeros, so 148.60 becomes ``148.6``."""
    return F.concat(lat.cast("string"), F.lit(","), lon.cast("string"))


def cell_position(key: Column) -> list[Column]:
    """``lat`` and ``lon`` of a cell key; a double's text reads back as the same double."""
    degrees = F.split(key, ",")
    return [F.get(degrees, F.lit(i)).cast("double").alias(name) for i, name in enumerate(("lat", "lon"))]


def great_circle_km(
    lat_a: Column,
    lon_a: Column,
    lat_b: Column,
    lon_b: Column,
    radius_km: float = fixed.EARTH_RADIUS_KM,
    decimals: int = fixed.DISTANCE_DECIMALS,
) -> Column:
    """Haversine distance between two points given in degrees."""
    half_lat = (F.radians(lat_b) - F.radians(lat_a)) / 2
    half_lon = (F.radians(lon_b) - F.radians(lon_a)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(half_lon), 2)
    return F.round(F.lit(2 * radius_km) * F.asin(F.sqrt(chord)), decimals)
