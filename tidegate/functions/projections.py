"""Coordinate systems by their numbers: longitude and latitude from projected coordinates and back, on arrays.

Known are geographic coordinates, the 60 UTM zones of both hemispheres, spherical Mercator, and the Dutch grid (oblique
stereographic on the Bessel ellipsoid with a datum shift of seven parameters). Formulas: Karney (2011) for UTM, the
public guidance note 7-2 on coordinate operations for the others. The shift of the Dutch datum is the published one for
the whole country; what a correction grid adds to it, at most 25 cm, is left out.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.geo import ALPHA, BETA, DELTA, ECCENTRICITY, FALSE_EASTING, RECTIFYING_RADIUS, SCALE, SEMI_MAJOR
from tidegate.functions.text import as_col

# Numbers of the systems.
GEOGRAPHIC = (4258, 4326, 4979, 4937)
MERCATOR = (3857, 900913, 3785)
DUTCH = (28992,)
SOUTH = 10_000_000.0

# Bessel ellipsoid, and origin, scale and false origin of the Dutch grid.
BESSEL_A, BESSEL_F = 6377397.155, 1 / 299.1528128
ORIGIN_LAT, ORIGIN_LON = 52 + 9 / 60 + 22.178 / 3600, 5 + 23 / 60 + 15.5 / 3600
GRID_SCALE, GRID_X, GRID_Y = 0.9999079, 155000.0, 463000.0
# The same ellipsoid as GPS uses, and the shift from the Dutch datum to it (metres, arc seconds, ppm).
GRS_F = 1 / 298.257222101
SHIFT = (565.4171, 50.3319, 465.5524)
TURN = (-0.398957388243134, 0.343987817378283, -1.87740163998045)
STRETCH = 4.0725


def number(crs: str | None) -> int | None:
    """The number in a system's name, such as ``EPSG:4258``, ``epsg 4258`` or ``urn:ogc:def:crs:EPSG::4258``."""
    found = re.fullmatch(r"\s*(?:urn:ogc:def:crs:)?epsg[\s:]*(?:[\d.]*:)?(\d+)\s*", crs or "", re.IGNORECASE)
    return int(found[1]) if found else None


def zone(code: int) -> tuple[int, bool] | None:
    """(UTM zone, southern) of a system's number."""
    for first, last, south in ((32601, 32660, False), (32701, 32760, True)):
        if first <= code <= last:
            return code - first + 1, south
    return (code - 25800, False) if 25828 <= code <= 25838 else None


def _utm(lon, lat, meridian):
    phi, lam = np.radians(lat), np.radians(lon - meridian)
    t = np.sinh(np.arctanh(np.sin(phi)) - ECCENTRICITY * np.arctanh(ECCENTRICITY * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    east, north = eta.copy(), xi.copy()
    for k, a in enumerate(ALPHA, start=1):
        east += a * np.cos(2 * k * xi) * np.sinh(2 * k * eta)
        north += a * np.sin(2 * k * xi) * np.cosh(2 * k * eta)
    return FALSE_EASTING + SCALE * RECTIFYING_RADIUS * east, SCALE * RECTIFYING_RADIUS * north


def _from_utm(x, y, meridian):
    xi, eta = y / (SCALE * RECTIFYING_RADIUS), (x - FALSE_EASTING) / (SCALE * RECTIFYING_RADIUS)
    xi0, eta0 = xi.copy(), eta.copy()
    for k, b in enumerate(BETA, start=1):
        xi0 -= b * np.sin(2 * k * xi) * np.cosh(2 * k * eta)
        eta0 -= b * np.cos(2 * k * xi) * np.sinh(2 * k * eta)
    chi = np.arcsin(np.sin(xi0) / np.cosh(eta0))
    lat = chi + sum(d * np.sin(2 * k * chi) for k, d in enumerate(DELTA, start=1))
    return meridian + np.degrees(np.arctan2(np.sinh(eta0), np.cos(xi0))), np.degrees(lat)


def _sphere():
    """Constants of the conformal sphere at the origin of the Dutch grid: (R, n, c, latitude of the origin on it)."""
    e2 = BESSEL_F * (2 - BESSEL_F)
    e, phi = np.sqrt(e2), np.radians(ORIGIN_LAT)
    w = 1 - e2 * np.sin(phi) ** 2
    radius = np.sqrt(BESSEL_A * (1 - e2) / w**1.5 * BESSEL_A / np.sqrt(w))
    n = np.sqrt(1 + e2 * np.cos(phi) ** 4 / (1 - e2))

    def grown(s):
        return ((1 + s) / (1 - s) * ((1 - e * s) / (1 + e * s)) ** e) ** n

    w1 = grown(np.sin(phi))
    sin_chi = (w1 - 1) / (w1 + 1)
    c = (n + np.sin(phi)) * (1 - sin_chi) / ((n - np.sin(phi)) * (1 + sin_chi))
    w2 = c * w1
    return radius, n, c, np.arcsin((w2 - 1) / (w2 + 1)), e, grown


def stereographic(lon, lat):
    """Dutch grid coordinates of degrees on the Dutch datum."""
    radius, n, c, chi0, _, grown = _sphere()
    turned = n * np.radians(lon - ORIGIN_LON)
    w = c * grown(np.sin(np.radians(lat)))
    chi = np.arcsin((w - 1) / (w + 1))
    b = 1 + np.sin(chi) * np.sin(chi0) + np.cos(chi) * np.cos(chi0) * np.cos(turned)
    x = 2 * radius * GRID_SCALE * np.cos(chi) * np.sin(turned) / b
    y = 2 * radius * GRID_SCALE * (np.sin(chi) * np.cos(chi0) - np.cos(chi) * np.sin(chi0) * np.cos(turned)) / b
    return GRID_X + x, GRID_Y + y


def from_stereographic(x, y):
    """Degrees on the Dutch datum of Dutch grid coordinates."""
    radius, n, c, chi0, e, _ = _sphere()
    e_, n_ = x - GRID_X, y - GRID_Y
    g = 2 * radius * GRID_SCALE * np.tan(np.pi / 4 - chi0 / 2)
    h = 4 * radius * GRID_SCALE * np.tan(chi0) + g
    i = np.arctan2(e_, h + n_)
    j = np.arctan2(e_, g - n_) - i
    chi = chi0 + 2 * np.arctan((n_ - e_ * np.tan(j / 2)) / (2 * radius * GRID_SCALE))
    lon = ORIGIN_LON + np.degrees((j + 2 * i) / n)
    psi = 0.5 * np.log((1 + np.sin(chi)) / (c * (1 - np.sin(chi)))) / n
    phi = 2 * np.arctan(np.exp(psi)) - np.pi / 2
    for _ in range(8):  # converges by a factor of about 150 a step
        phi = 2 * np.arctan(np.exp(psi + e * np.arctanh(e * np.sin(phi)))) - np.pi / 2
    return lon, np.degrees(phi)


def _geocentric(lon, lat, a, f):
    e2, phi, lam = f * (2 - f), np.radians(lat), np.radians(lon)
    v = a / np.sqrt(1 - e2 * np.sin(phi) ** 2)
    return v * np.cos(phi) * np.cos(lam), v * np.cos(phi) * np.sin(lam), v * (1 - e2) * np.sin(phi)


def _geographic(x, y, z, a, f):
    e2, p = f * (2 - f), np.hypot(x, y)
    phi = np.arctan2(z, p * (1 - e2))
    for _ in range(6):
        v = a / np.sqrt(1 - e2 * np.sin(phi) ** 2)
        phi = np.arctan2(z + e2 * v * np.sin(phi), p)
    return np.degrees(np.arctan2(y, x)), np.degrees(phi)


def _shifted(lon, lat, back: bool):
    """Degrees moved from the Dutch datum to that of GPS, or ``back``; points lie on the ellipsoid."""
    source, target = ((SEMI_MAJOR, GRS_F), (BESSEL_A, BESSEL_F)) if back else ((BESSEL_A, BESSEL_F), (SEMI_MAJOR, GRS_F))
    x, y, z = _geocentric(lon, lat, *source)
    rx, ry, rz = (np.radians(t / 3600) for t in TURN)
    turn = (1 + STRETCH * 1e-6) * np.array([[1, -rz, ry], [rz, 1, -rx], [-ry, rx, 1]])
    place = np.stack([x, y, z])
    if back:
        moved = np.linalg.solve(turn, place - np.array(SHIFT)[:, None])
    else:
        moved = turn @ place + np.array(SHIFT)[:, None]
    return _geographic(*moved, *target)


def known(code: int | None) -> bool:
    return code is not None and (code in (*GEOGRAPHIC, *MERCATOR, *DUTCH) or zone(code) is not None)


def lonlat(code: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Degrees of coordinates in a known system; others raise."""
    if code in GEOGRAPHIC:
        return x, y
    if code in MERCATOR:
        return np.degrees(x / SEMI_MAJOR), np.degrees(np.arctan(np.sinh(y / SEMI_MAJOR)))
    if code in DUTCH:
        return _shifted(*from_stereographic(x, y), back=False)
    if (utm := zone(code)) is not None:
        return _from_utm(x, y - SOUTH if utm[1] else y, 6.0 * utm[0] - 183)
    raise ValueError(f"unsupported coordinate system: {code}")


def from_lonlat(code: int, lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in a known system of degrees; others raise."""
    if code in GEOGRAPHIC:
        return lon, lat
    if code in MERCATOR:
        return SEMI_MAJOR * np.radians(lon), SEMI_MAJOR * np.arcsinh(np.tan(np.radians(lat)))
    if code in DUTCH:
        near_lon, near_lat = _shifted(lon, lat, back=True)
        # heights are left out, so the way there and back differs by millimetres; one step makes them agree
        again_lon, again_lat = _shifted(near_lon, near_lat, back=False)
        return stereographic(near_lon + lon - again_lon, near_lat + lat - again_lat)
    if (utm := zone(code)) is not None:
        x, y = _utm(lon, lat, 6.0 * utm[0] - 183)
        return x, y + SOUTH if utm[1] else y
    raise ValueError(f"unsupported coordinate system: {code}")


def by_system(crs: list, x: np.ndarray, y: np.ndarray, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``lonlat`` (or ``from_lonlat``) of coordinates in several systems, given by name for each; an unknown name raises."""
    names, which = np.unique(np.array([c or "" for c in crs], object).astype(str), return_inverse=True)
    out_x, out_y = x.astype(float), y.astype(float)
    with np.errstate(all="ignore"):
        for k, name in enumerate(names):
            mine = which == k
            if not known(number(name)):
                raise ValueError(f"unsupported coordinate system: {name or 'none'}")
            out_x[mine], out_y[mine] = (from_lonlat if back else lonlat)(number(name), out_x[mine], out_y[mine])
    return out_x, out_y


def _moved(crs: str | Column, x: str | Column, y: str | Column, back: bool, names: tuple[str, str]) -> Column:
    def move(systems: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        first, second = (c.to_numpy(zero_copy_only=False).astype(float) for c in (x, y))
        a, b = by_system(systems.to_pylist(), first, second, back)
        lost = ~(np.isfinite(a) & np.isfinite(b))
        return pa.StructArray.from_arrays([pa.array(v, mask=lost) for v in (a, b)], list(names))

    double = lambda c: as_col(c).cast("double")
    return F.arrow_udf(move, f"struct<{names[0]}:double,{names[1]}:double>")(as_col(crs), double(x), double(y))


def degrees(crs: str | Column, x: str | Column, y: str | Column) -> Column:
    """``lon, lat`` of coordinates in the system that each row names; both null if a coordinate is missing."""
    return _moved(crs, x, y, False, ("lon", "lat"))


def placed(crs: str | Column, lon: str | Column, lat: str | Column) -> Column:
    """``x, y`` in the system that each row names; both null if a coordinate is missing."""
    return _moved(crs, lon, lat, True, ("x", "y"))


# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
