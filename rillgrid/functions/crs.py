"""Longitude and latitude to the cities' metric systems and back, as column arithmetic.

UTM zones (25830, 25832; 3044 is 25832 with its axes told the other way) by Krüger's series to the third order, good to a
millimetre in a zone. Dutch RD (28992) by the seven-parameter shift of datum and the oblique stereographic double projection, both
in closed form but for the latitude of an isometric latitude, which is iterated; there and back agree to 1e-9 degrees. The correction grid
that the Dutch survey adds after the shift (up to 0.25 m) is not applied.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import asin, atanh, cos, radians, sin, sqrt

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ZONES = {25830: -3.0, 25832: 9.0, 3044: 9.0}
_A, _F = 6378137.0, 1 / 298.257222101
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_K0, _EAST = 0.9996, 500000.0
_ALPHA = (_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3, 13 / 48 * _N**2 - 3 / 5 * _N**3, 61 / 240 * _N**3)
_BETA = (_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3, 1 / 48 * _N**2 + 1 / 15 * _N**3, 17 / 480 * _N**3)
_DELTA = (2 * _N - 2 / 3 * _N**2 - 2 * _N**3, 7 / 3 * _N**2 - 8 / 5 * _N**3, 56 / 15 * _N**3)

#: Fixed values of the Dutch system: Bessel's ellipsoid, the projection's origin, scale and offsets, and the shift from ETRS89 (metres,
#: turns in radians about the axes, scale), which takes points to lie 43 m above the ETRS89 ellipsoid.
_BESSEL_A, _BESSEL_F = 6377397.155, 1 / 299.1528128
_RD_LAT0, _RD_LON0 = radians(52 + 9 / 60 + 22.178 / 3600), radians(5 + 23 / 60 + 15.500 / 3600)
_RD_K0, _RD_X0, _RD_Y0 = 0.9999079, 155000.0, 463000.0
_RD_SHIFT = (-565.7346, -50.4058, -465.2895)
_RD_TURN = (1.91514e-6, -1.60365e-6, 9.09546e-6)
_RD_SCALE = 1 - 4.07242e-6
_RD_HEIGHT = 43.0

_E2, _BESSEL_E2 = _F * (2 - _F), _BESSEL_F * (2 - _BESSEL_F)
_BESSEL_E = sqrt(_BESSEL_E2)
#: The sphere between ellipsoid and plane: its radius (doubled, with the scale), and what turns isometric latitudes into its own.
_RD_N = sqrt(1 + _BESSEL_E2 * cos(_RD_LAT0) ** 4 / (1 - _BESSEL_E2))
_RD_CHI0 = asin(sin(_RD_LAT0) / _RD_N)
_RD_M = atanh(sin(_RD_CHI0)) - _RD_N * (atanh(sin(_RD_LAT0)) - _BESSEL_E * atanh(_BESSEL_E * sin(_RD_LAT0)))
_RD_2R = 2 * _RD_K0 * _BESSEL_A * sqrt(1 - _BESSEL_E2) / (1 - _BESSEL_E2 * sin(_RD_LAT0) ** 2)
_LAT_STEPS = 7  # each leaves some 0.0067 of the error


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _geocentric(lat: Column, lon: Column, h: Column, a: float, e2: float) -> Column:
    """struct<x, y, z> in metres; angles in radians."""
    n = a / F.sqrt(1 - e2 * F.sin(lat) * F.sin(lat))
    r = (n + h) * F.cos(lat)
    return F.struct((r * F.cos(lon)).alias("x"), (r * F.sin(lon)).alias("y"), ((n * (1 - e2) + h) * F.sin(lat)).alias("z"))


def _geodetic(p: Column, a: float, f: float) -> Column:
    """struct<lat, lon, h> of a geocentric point near the ellipsoid, by Bowring's formula."""
    e2, b = f * (2 - f), a * (1 - f)

    def of(q: Column) -> Column:
        u = F.atan2(q["z"] * a, q["r"] * b)
        lat = F.atan2(q["z"] + e2 / (1 - e2) * b * F.pow(F.sin(u), F.lit(3.0)), q["r"] - e2 * a * F.pow(F.cos(u), F.lit(3.0)))
        return _let(lat, lambda t: F.struct(t.alias("lat"), q["lon"].alias("lon"), (q["r"] / F.cos(t) - a / F.sqrt(1 - e2 * F.sin(t) * F.sin(t))).alias("h")))

    return _let(F.struct(F.hypot(p["x"], p["y"]).alias("r"), F.atan2(p["y"], p["x"]).alias("lon"), p["z"].alias("z")), of)


def _to_bessel(p: Column) -> Column:
    (tx, ty, tz), (rx, ry, rz) = _RD_SHIFT, _RD_TURN
    x = tx + _RD_SCALE * (p["x"] - rz * p["y"] + ry * p["z"])
    y = ty + _RD_SCALE * (rz * p["x"] + p["y"] - rx * p["z"])
    z = tz + _RD_SCALE * (rx * p["y"] - ry * p["x"] + p["z"])
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def _from_bessel(p: Column) -> Column:
    """The exact inverse: the turn's matrix is solved, not turned back by negated angles."""
    rx, ry, rz = _RD_TURN
    rows = np.linalg.inv(_RD_SCALE * np.array([[1, -rz, ry], [rz, 1, -rx], [-ry, rx, 1]])).tolist()
    d = [p[c] - t for c, t in zip("xyz", _RD_SHIFT, strict=True)]
    return F.struct(*[_total([k * v for k, v in zip(row, d, strict=True)]).alias(c) for c, row in zip("xyz", rows, strict=True)])


def _rd_plane(lat: Column, lon: Column) -> Column:
    """Bessel's latitude and longitude on the plane: first on the sphere, angles kept, then from the point opposite the origin."""
    q = F.atanh(F.sin(lat)) - _BESSEL_E * F.atanh(_BESSEL_E * F.sin(lat))

    def of(t: Column) -> Column:
        across = t["c"] * F.sin(t["d"])
        up = t["s"] * cos(_RD_CHI0) - t["c"] * F.cos(t["d"]) * sin(_RD_CHI0)
        k = _RD_2R / (1 + t["s"] * sin(_RD_CHI0) + t["c"] * F.cos(t["d"]) * cos(_RD_CHI0))
        return F.struct((_RD_X0 + k * across).alias("x"), (_RD_Y0 + k * up).alias("y"))

    w = _RD_N * q + _RD_M
    return _let(w, lambda v: _let(F.struct(F.tanh(v).alias("s"), (1 / F.cosh(v)).alias("c"), (_RD_N * (lon - _RD_LON0)).alias("d")), of))


def _rd_unplane(x: Column, y: Column) -> Column:
    """The inverse of _rd_plane: struct<lat, lon>."""

    def on_sphere(t: Column) -> Column:
        r2 = t["u"] * t["u"] + t["v"] * t["v"]
        s = ((1 - r2) * sin(_RD_CHI0) + 2 * t["v"] * cos(_RD_CHI0)) / (1 + r2)
        d = F.atan2(2 * t["u"], (1 - r2) * cos(_RD_CHI0) - 2 * t["v"] * sin(_RD_CHI0))
        return F.struct(((F.atanh(s) - _RD_M) / _RD_N).alias("q"), (_RD_LON0 + d / _RD_N).alias("lon"))

    def of(t: Column) -> Column:
        s = reduce(lambda s, _: F.tanh(t["q"] + _BESSEL_E * F.atanh(_BESSEL_E * s)), range(_LAT_STEPS), F.tanh(t["q"]))
        return F.struct(F.asin(s).alias("lat"), t["lon"].alias("lon"))

    plane = F.struct(((x - _RD_X0) / _RD_2R).alias("u"), ((y - _RD_Y0) / _RD_2R).alias("v"))
    return _let(_let(plane, on_sphere), of)


def _rd_lonlat(x: Column, y: Column) -> Column:
    """struct<lon, lat>. Heights over Bessel's ellipsoid follow from those over ETRS89's, which are fixed: a first pass from height
    0 tells how far off that was."""

    def back(t: Column, h: Column) -> Column:
        return _let(_geocentric(t["lat"], t["lon"], h, _BESSEL_A, _BESSEL_E2), lambda p: _let(_from_bessel(p), lambda g: _geodetic(g, _A, _F)))

    def of(t: Column) -> Column:
        found = _let(back(t, F.lit(0.0)), lambda g: back(t, _RD_HEIGHT - g["h"]))
        return _let(found, lambda g: F.struct(F.degrees(g["lon"]).alias("lon"), F.degrees(g["lat"]).alias("lat")))

    return _let(_rd_unplane(x, y), of)


def _rd_from_lonlat(lon: Column, lat: Column) -> Column:
    p = _geocentric(F.radians(lat), F.radians(lon), F.lit(_RD_HEIGHT), _A, _E2)
    return _let(p, lambda p: _let(_to_bessel(p), lambda b: _let(_geodetic(b, _BESSEL_A, _BESSEL_F), lambda g: _rd_plane(g["lat"], g["lon"]))))


def from_lonlat(lon: Column, lat: Column, crs: int) -> Column:
    """struct<x, y> in a metric system."""
    if crs == 28992:
        return _rd_from_lonlat(lon, lat)
    s = F.sin(F.radians(lat))
    e = 2 * _N**0.5 / (1 + _N)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    d = F.radians(lon - ZONES[crs])
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    x = eta + _total([a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1)])
    y = xi + _total([a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1)])
    return F.struct((_EAST + _K0 * _RADIUS * x).alias("x"), (_K0 * _RADIUS * y).alias("y"))


def to_lonlat(x: Column, y: Column, crs: int) -> Column:
    """struct<lon, lat>."""
    if crs == 28992:
        return _rd_lonlat(x, y)
    xi, eta = y / (_K0 * _RADIUS), (x - _EAST) / (_K0 * _RADIUS)
    xi1 = xi - _total([b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1)])
    eta1 = eta - _total([b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1)])
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi + _total([d * F.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1)])
    return F.struct((F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + ZONES[crs]).alias("lon"), F.degrees(lat).alias("lat"))


def reproject(geom: Column, crs: int) -> Column:
    """A geometry in longitude and latitude, in a metric system."""
    return F.transform(geom, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: _named(from_lonlat(p["x"], p["y"], crs)))))


def _named(xy: Column) -> Column:
    return F.named_struct(F.lit("x"), xy["x"], F.lit("y"), xy["y"])
