"""UTM projection and distances as column expressions.

The projection is the Krueger series in the third flattening n (fourth order,
better than a tenth of a millimetre within the zone), as published by Karney
(2011), "Transverse Mercator with an accuracy of a few nanometers".
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import as_col

# WGS84 ellipsoid and UTM zone 31 north.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
CENTRAL_MERIDIAN = 3.0

N = FLATTENING / (2 - FLATTENING)
ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
RECTIFYING_RADIUS = SEMI_MAJOR / (1 + N) * (1 + N**2 / 4 + N**4 / 64)

# Series coefficients of the forward and inverse mapping.
ALPHA = (
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
    61 * N**3 / 240 - 103 * N**4 / 140,
    49561 * N**4 / 161280,
)
BETA = (
    N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360,
    N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440,
    17 * N**3 / 480 - 37 * N**4 / 840,
    4397 * N**4 / 161280,
)
DELTA = (
    2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45,
    7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45,
    56 * N**3 / 15 - 136 * N**4 / 35,
    4279 * N**4 / 630,
)

LONLAT = "EPSG:4258"
UTM31 = "EPSG:32631"


def finite(value: str | Column) -> Column:
    """A finite double; NaN becomes null, since NaN sorts above every number in Spark."""
    c = as_col(value).cast("double")
    return F.when(~F.isnan(c), c)


def _sphere(lat: str | Column) -> Column:
    """Tangent of the conformal latitude."""
    sin_phi = F.sin(F.radians(finite(lat)))
    return F.sinh(F.atanh(sin_phi) - ECCENTRICITY * F.atanh(ECCENTRICITY * sin_phi))


def _from_meridian(lon: str | Column) -> Column:
    return F.radians(finite(lon) - CENTRAL_MERIDIAN)


def _cylinder(t: Column, lam: Column) -> tuple[Column, Column]:
    return F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))


def _metres(xi: Column, eta: Column) -> tuple[Column, Column]:
    terms = list(enumerate(ALPHA, start=1))
    east = reduce(lambda s, p: s + p[1] * F.cos(2 * p[0] * xi) * F.sinh(2 * p[0] * eta), terms, eta)
    north = reduce(lambda s, p: s + p[1] * F.sin(2 * p[0] * xi) * F.cosh(2 * p[0] * eta), terms, xi)
    factor = SCALE * RECTIFYING_RADIUS
    return FALSE_EASTING + factor * east, factor * north


def to_utm31(lon: str | Column, lat: str | Column) -> tuple[Column, Column]:
    """Easting and northing (metres) of a longitude and latitude in degrees."""
    return _metres(*_cylinder(_sphere(lat), _from_meridian(lon)))


def with_utm31(df: DataFrame, lon: str, lat: str, east: str, north: str) -> DataFrame:
    """``df`` with easting and northing, in steps that the next step uses several times.

    Spark keeps such steps apart, where it would write the one expression of ``to_utm31`` out in an aggregate's
    results and work out its parts over and over.
    """
    turned = df.withColumns({"_t": _sphere(lat), "_lam": _from_meridian(lon)})
    xi, eta = _cylinder(F.col("_t"), F.col("_lam"))
    x, y = _metres(F.col("_xi"), F.col("_eta"))
    return turned.withColumns({"_xi": xi, "_eta": eta}).withColumns({east: x, north: y}).drop("_t", "_lam", "_xi", "_eta")


def from_utm31(easting: str | Column, northing: str | Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of a UTM 31N easting and northing."""
    factor = SCALE * RECTIFYING_RADIUS
    xi = finite(northing) / factor
    eta = (finite(easting) - FALSE_EASTING) / factor
    terms = list(enumerate(BETA, start=1))
    xi0 = reduce(lambda s, p: s - p[1] * F.sin(2 * p[0] * xi) * F.cosh(2 * p[0] * eta), terms, xi)
    eta0 = reduce(lambda s, p: s - p[1] * F.cos(2 * p[0] * xi) * F.sinh(2 * p[0] * eta), terms, eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    lat = reduce(lambda s, p: s + p[1] * F.sin(2 * p[0] * chi), enumerate(DELTA, start=1), chi)
    lon = F.atan2(F.sinh(eta0), F.cos(xi0))
    return CENTRAL_MERIDIAN + F.degrees(lon), F.degrees(lat)


def point_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance from a point to the segment between two others (which may coincide)."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, ((x - x1) * dx + (y - y1) * dy) / length2).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return point_distance(x, y, x1 + t * dx, y1 + t * dy)
