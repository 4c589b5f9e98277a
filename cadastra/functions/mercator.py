"""Web-Mercator tile addresses and the two closed-form reprojections."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.functions.geometry import box, map_points

MAX_LAT = 85.0511287798066  # latitude where the square Mercator world ends
RADIUS = 6378137.0


def _clamp(value: Column, zoom: Column) -> Column:
    top = F.pow(F.lit(2.0), zoom) - 1
    return F.least(F.greatest(value, F.lit(0.0)), top).cast("int")


def tile_x(lon: Column, zoom: Column) -> Column:
    """Tile column of a longitude."""
    return _clamp(F.floor((lon + 180.0) / 360.0 * F.pow(F.lit(2.0), zoom)).cast("double"), zoom)


def tile_y(lat: Column, zoom: Column) -> Column:
    """Tile row of a latitude (row 0 is the north)."""
    phi = F.radians(F.least(F.greatest(lat, F.lit(-MAX_LAT)), F.lit(MAX_LAT)))
    north = (F.lit(1.0) - F.ln(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / math.pi) / 2.0
    return _clamp(F.floor(north * F.pow(F.lit(2.0), zoom)).cast("double"), zoom)


def tile_box(z: Column, x: Column, y: Column) -> Column:
    """Box of a tile in degrees."""
    n = F.pow(F.lit(2.0), z)

    def lat(row: Column) -> Column:
        return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (F.lit(1.0) - F.lit(2.0) * row / n))))

    return box(x / n * 360.0 - 180.0, lat(y + 1), (x + 1) / n * 360.0 - 180.0, lat(y))


def to_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:4326 -> EPSG:3857."""
    lat = F.least(F.greatest(y, F.lit(-MAX_LAT)), F.lit(MAX_LAT))
    return F.radians(x) * RADIUS, F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2.0)) * RADIUS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 -> EPSG:4326."""
    lat = F.lit(2.0) * F.atan(F.exp(y / RADIUS)) - math.pi / 2
    return F.degrees(x / RADIUS), F.degrees(lat)


# NAD83 and WGS84 agree to about a metre: at this accuracy the change of datum is the identity.
GEOGRAPHIC = {"EPSG:4326", "EPSG:4269"}


def reproject(geom: Column, source: str, target: str = "EPSG:4326") -> Column:
    """Reproject a multipolygon between geographic coordinates and web Mercator."""
    if source == target or {source, target} <= GEOGRAPHIC:
        return geom
    if source in GEOGRAPHIC and target == "EPSG:3857":
        step = to_mercator
    elif source == "EPSG:3857" and target in GEOGRAPHIC:
        step = from_mercator
    else:
        raise ValueError(f"no closed form for {source} -> {target}")

    def move(p: Column) -> Column:
        x, y = step(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return map_points(geom, move)
