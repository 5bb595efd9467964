"""Distances, headings and grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8

# Distance between rows of hexagons of width 1.
_HEX_ROW = math.sqrt(3) / 2


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; the sine argument is clamped so antipodes stay defined."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    clamped = F.when(chord.isNotNull(), F.least(F.lit(1.0), chord))
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(clamped))


def heading_change(previous: Column, current: Column) -> Column:
    """Signed turn in degrees, wrapped into [-180, 180)."""
    return F.pmod(current - previous + 540.0, F.lit(360.0)) - 180.0


def grid_row(latitude: Column, degrees: float = 1.0) -> Column:
    """Index of the grid row, counted north from the south pole."""
    return F.floor((latitude + 90.0) / degrees).cast("bigint")


def grid_column(longitude: Column, degrees: float = 1.0) -> Column:
    """Index of the grid column, counted east from the antimeridian."""
    return F.floor((longitude + 180.0) / degrees).cast("bigint")


def hex_cell(latitude: Column, longitude: Column, columns: int) -> Column:
    """The hexagon a position is in, as a struct (column, row).

    Hexagons of one size cover an equal-area cylinder: x is the longitude, y the sine of the latitude. ``columns`` of them
    make a row around the globe, so the row closes at the 180th meridian: -180 and 180 degrees are in the same hexagon. Rows are counted from
    the equator; those at the poles are cut off by the projection's edge. A longitude outside -180 to 180 counts as the one it is
    turned to, a latitude beyond a pole as the pole. Null, NaN and infinity have no cell.
    """
    finite = (F.abs(latitude) < float("inf")) & (F.abs(longitude) < float("inf"))
    north = F.sin(F.radians(F.greatest(F.lit(-90.0), F.least(F.lit(90.0), latitude.cast("double")))))
    x = F.pmod(longitude.cast("double") + 180.0, F.lit(360.0)) / 360.0 * columns
    y = north * (columns / (2 * math.pi))
    return F.when(finite, _hex_at(x, y, columns))


def _hex_at(x: Column, y: Column, columns: int) -> Column:
    """The hexagon whose centre is next to a point of the plane, in hexagon widths."""
    row = y / _HEX_ROW
    across = x - row / 2
    third = -across - row
    a, b, c = (F.floor(v + 0.5) for v in (across, row, third))
    off_a, off_b, off_c = F.abs(a - across), F.abs(b - row), F.abs(c - third)
    fixed_a = F.when((off_a > off_b) & (off_a > off_c), -b - c).otherwise(a)
    fixed_b = F.when(~((off_a > off_b) & (off_a > off_c)) & (off_b > off_c), -a - c).otherwise(b)
    return F.struct(F.pmod(fixed_a, F.lit(columns)).cast("bigint").alias("hex_column"), fixed_b.cast("bigint").alias("hex_row"))


def hex_centre(column: Column, row: Column, columns: int) -> Column:
    """Latitude and longitude of a hexagon's centre; the pole where the centre lies beyond the projection's edge."""
    north = row * (_HEX_ROW * 2 * math.pi / columns)
    latitude = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), north))))
    longitude = F.pmod((column + row / 2) / columns, F.lit(1.0)) * 360.0 - 180.0
    return F.struct(latitude.alias("latitude"), longitude.alias("longitude"))


def hex_parent(column: Column, row: Column, columns: int, coarser: int) -> Column:
    """The hexagon of a grid with ``coarser`` columns that has the centre of a finer one. Every hexagon has one parent, so counts of
    children add up to those of their parents."""
    scale = coarser / columns
    return _hex_at(F.pmod((column + row / 2) * scale, F.lit(float(coarser))), row * (_HEX_ROW * scale), coarser)
