"""Grid, distance and direction on 32-bit longitude/latitude columns.

Coordinates are FLOAT. Differences are taken in FLOAT and widened afterwards,
and `cos` is given degrees: both are part of the defined results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounding box, grid step and size, length of a degree in km.
LON_WEST, LON_EAST = -74.05, -73.7
LAT_SOUTH, LAT_NORTH = 40.5, 41.0
DELTA_LON, DELTA_LAT = 0.0014, 0.00125
GRID_X = 250
DEGREE_KM = 110.25
DIRECTION_BUCKETS = 8


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _wide(x: Column) -> Column:
    return x.cast("double")


def in_city(lon, lat, strict: bool = False) -> Column:
    """True inside the box. By default a point is rejected only when both its
    coordinates are outside; `strict` rejects it when either one is."""
    lon_ok = _wide(_c(lon)).between(LON_WEST, LON_EAST)
    lat_ok = _wide(_c(lat)).between(LAT_SOUTH, LAT_NORTH)
    return (lon_ok & lat_ok) if strict else (lon_ok | lat_ok)


def grid_x(lon) -> Column:
    return F.floor((F.lit(-LON_WEST) - F.abs(_wide(_c(lon)))) / F.lit(DELTA_LON)).cast("int")


def grid_y(lat) -> Column:
    return F.floor((F.lit(LAT_NORTH) - _wide(_c(lat))) / F.lit(DELTA_LAT)).cast("int")


def grid_cell(lon, lat) -> Column:
    """Row-major cell number from the north-west corner; not clamped to the box."""
    return grid_x(lon) + grid_y(lat) * F.lit(GRID_X)


def cell_center_lon(cell) -> Column:
    x = _c(cell) % F.lit(GRID_X)
    return -(F.lit(-LON_WEST) - x * F.lit(DELTA_LON) - F.lit(DELTA_LON / 2)).cast("float")


def cell_center_lat(cell) -> Column:
    x = _c(cell) % F.lit(GRID_X)
    y = ((_c(cell) - x) / F.lit(GRID_X)).cast("int")
    return (F.lit(LAT_NORTH) - y * F.lit(DELTA_LAT) - F.lit(DELTA_LAT / 2)).cast("float")


def distance_km(lon1, lat1, lon2, lat2) -> Column:
    dlat = _c(lat1) - _c(lat2)
    dlon = _wide(_c(lon1) - _c(lon2)) * F.cos(_wide(_c(lat2)))
    return F.lit(DEGREE_KM) * F.sqrt(_wide(dlat * dlat) + dlon * dlon)


def direction_angle(start_lon, start_lat, dest_lon, dest_lat) -> Column:
    """Whole degrees in [-1, 359], clockwise from east, truncated toward zero."""
    dlat = _wide(_c(dest_lat) - _c(start_lat))
    dlon = _wide(_c(dest_lon) - _c(start_lon)) * F.cos(_wide(_c(start_lat)))
    return F.degrees(F.atan2(dlat, dlon)).cast("int") + F.lit(179)


def direction_bucket(angle) -> Column:
    return (_c(angle) / F.lit(360 // DIRECTION_BUCKETS)).cast("int")


def path_cells(lon1, lat1, lon2, lat2) -> Column:
    """Cells on the straight line between two points, as an array: one step per
    cell along the longer axis, the other axis rounded to the nearest cell."""
    x1, y1 = grid_x(lon1), grid_y(lat1)
    dx, dy = grid_x(lon2) - x1, grid_y(lat2) - y1
    steps = F.greatest(F.abs(dx), F.abs(dy))
    span = F.greatest(steps, F.lit(1)).cast("double")

    def at(base: Column, delta: Column, i: Column) -> Column:
        return base + F.floor(delta * i / span + F.lit(0.5)).cast("int")

    return F.transform(F.sequence(F.lit(0), steps),
                       lambda i: at(x1, dx, i) + at(y1, dy, i) * F.lit(GRID_X))
