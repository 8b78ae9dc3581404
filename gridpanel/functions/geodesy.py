"""Column expressions for coordinates: unit conversion, weights, distances, projection.

All functions build JVM-side expressions (whole-stage codegen), no Python per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's results.
KELVIN_OFFSET = 273.15            # K -> degC
EARTH_RADIUS_KM = 6371.0088       # mean Earth radius used for haversine distances
# WGS84 ellipsoid, used by the EPSG:6933 (EASE-Grid 2.0 global) projection.
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
EASE_STANDARD_PARALLEL_DEG = 30.0

_E2 = WGS84_F * (2.0 - WGS84_F)
_E = math.sqrt(_E2)
_SIN_TS = math.sin(math.radians(EASE_STANDARD_PARALLEL_DEG))
K0 = math.cos(math.radians(EASE_STANDARD_PARALLEL_DEG)) / math.sqrt(1.0 - _E2 * _SIN_TS ** 2)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def kelvin_to_celsius(c) -> Column:
    return _c(c) - F.lit(KELVIN_OFFSET)


def area_weight(lat) -> Column:
    """cos(latitude): relative area of a regular lat/lon cell."""
    return F.cos(F.radians(_c(lat)))


def wrap_lon(lon) -> Column:
    """Map longitudes given in 0..360 to -180..180 (identity on -180..180)."""
    return F.pmod(_c(lon) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km on a sphere of radius EARTH_RADIUS_KM."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2.0), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2.0), 2)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def ease_x(lon) -> Column:
    """EPSG:6933 easting in metres (cylindrical equal-area, true scale at 30 deg)."""
    return F.lit(WGS84_A * K0) * F.radians(_c(lon))


def ease_y(lat) -> Column:
    """EPSG:6933 northing in metres: a * q(lat) / (2 k0), q = authalic function."""
    s = F.sin(F.radians(_c(lat)))
    es = F.lit(_E) * s
    q = F.lit(1.0 - _E2) * (
        s / (F.lit(1.0) - F.lit(_E2) * s * s)
        - F.log((F.lit(1.0) - es) / (F.lit(1.0) + es)) / F.lit(2.0 * _E)
    )
    return F.lit(WGS84_A / (2.0 * K0)) * q


def ease_xy_py(lon: float, lat: float) -> tuple[float, float]:
    """Same projection in plain Python, for small driver-side checks and tests."""
    x = WGS84_A * K0 * math.radians(lon)
    s = math.sin(math.radians(lat))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    return x, WGS84_A * q / (2 * K0)


def haversine_py(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
        math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(a))


def point_segment_distance2(px, py, x0, y0, x1, y1) -> Column:
    """Squared planar distance from point P to segment [A, B] (same units).

    Written with the clamped projection parameter used once per coordinate so the
    expression stays small inside filters (no common-subexpression elimination there)."""
    px, py, x0, y0, x1, y1 = map(_c, (px, py, x0, y0, x1, y1))
    dx, dy = x1 - x0, y1 - y0
    len2 = dx * dx + dy * dy
    t = F.when(len2 > 0, ((px - x0) * dx + (py - y0) * dy) / len2).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = px - x0 - t * dx, py - y0 - t * dy
    return F.pow(ex, 2) + F.pow(ey, 2)


_QP = (1 - _E2) * (1 / (1 - _E2) - math.log((1 - _E) / (1 + _E)) / (2 * _E))
_E4, _E6 = _E2 * _E2, _E2 * _E2 * _E2
_B2 = _E2 / 3 + 31 * _E4 / 180 + 517 * _E6 / 5040
_B4 = 23 * _E4 / 360 + 251 * _E6 / 3780
_B6 = 761 * _E6 / 45360


def ease_lat_of_y(y) -> Column:
    """Inverse of ``ease_y``: latitude in degrees (authalic-latitude series, ~1e-9 deg).

    Used only to bound candidate rows, never for an exact test."""
    q = F.lit(2.0 * K0 / WGS84_A) * _c(y)
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / F.lit(_QP))))
    phi = (beta + F.lit(_B2) * F.sin(beta * 2.0) + F.lit(_B4) * F.sin(beta * 4.0)
           + F.lit(_B6) * F.sin(beta * 6.0))
    return F.degrees(phi)
