"""Coordinate transforms as plain Column arithmetic.

Supported: 4326 (lon/lat degrees), 3857 (Web Mercator), 326zz / 327zz (UTM,
Krueger series to third order in n, below a millimetre inside a zone) and 3035
(Lambert azimuthal equal area for Europe). Formulas from the public guidance
notes on map projections. Every formula is written once, over a namespace of functions ``m``: ``COLUMNS`` (the default) for
columns, ``NUMPY`` for arrays inside a task. A value that several terms use is named by ``m.let``: as a plain
Python value a column would be computed anew at every use, as often as its uses multiply.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column, functions as F

from .geometry import _let, _pt, _struct

# Ellipsoid and projection parameters.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563  # WGS 84
FLATTENING_GRS80 = 1 / 298.257222101
UTM_SCALE, UTM_FALSE_EAST, UTM_FALSE_NORTH = 0.9996, 500000.0, 10000000.0
LAEA_LAT0, LAEA_LON0, LAEA_FE, LAEA_FN = 52.0, 10.0, 4321000.0, 3210000.0

SUPPORTED = "4326, 3857, 32601-32660, 32701-32760, 3035"


def _let_columns(body, **values: Column) -> Column:
    """``body`` of columns, each evaluated once for a row."""
    return _let(_struct(**values), lambda v: body(**{name: v[name] for name in values}))


#: The functions that the formulas use, over columns; a point is a struct. ``moved`` hands a point's coordinates to another formula, ``xy`` shows them.
COLUMNS = SimpleNamespace(**{
    name: getattr(F, name)
    for name in "lit sin cos tan asin atan atan2 sinh cosh atanh log sqrt hypot radians degrees greatest least try_divide coalesce".split()
}, let=_let_columns, point=_pt, moved=lambda point, body: _let(point, lambda p: body(p["x"], p["y"])), xy=lambda point: (point["x"], point["y"]))
#: The same over numpy arrays; a point is a pair. A task may get a copy of this namespace, so nothing may depend on its identity.
NUMPY = SimpleNamespace(
    lit=lambda v: v, sin=np.sin, cos=np.cos, tan=np.tan, asin=np.arcsin, atan=np.arctan, atan2=np.arctan2, sinh=np.sinh, cosh=np.cosh,
    atanh=np.arctanh, log=np.log, sqrt=np.sqrt, hypot=np.hypot, radians=np.radians, degrees=np.degrees, greatest=np.maximum, least=np.minimum,
    try_divide=lambda a, b: np.divide(a, b, out=np.full(np.broadcast(a, b).shape, np.nan), where=np.not_equal(b, 0)),
    coalesce=lambda a, b: np.where(np.isnan(a), b, a), let=lambda body, **values: body(**values), point=lambda x, y: (x, y),
    moved=lambda point, body: body(*point), xy=lambda point: point,
)


def _mercator_forward(lon, lat, m=COLUMNS):
    x = m.radians(lon) * m.lit(SEMI_MAJOR)
    y = m.log(m.tan(m.lit(math.pi / 4) + m.radians(lat) / 2)) * m.lit(SEMI_MAJOR)
    return m.point(x, y)


def _mercator_inverse(x, y, m=COLUMNS):
    lon = m.degrees(x / m.lit(SEMI_MAJOR))
    lat = m.degrees(m.atan(m.sinh(y / m.lit(SEMI_MAJOR))))
    return m.point(lon, lat)


def _utm_parts(srid: int):
    zone = srid % 100
    if srid // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"unsupported srid {srid}; supported: {SUPPORTED}")
    return math.radians(zone * 6 - 183), (UTM_FALSE_NORTH if srid // 100 == 327 else 0.0)


_N = FLATTENING / (2 - FLATTENING)
_RECT = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)


def _utm_forward(srid: int):
    lon0, north = _utm_parts(srid)
    k = 2 * math.sqrt(_N) / (1 + _N)

    def fn(lon, lat, m=COLUMNS):
        def conformal(s, lam):
            return m.let(sphere, t=m.sinh(m.atanh(s) - m.lit(k) * m.atanh(m.lit(k) * s)), lam=lam)

        def sphere(t, lam):
            return m.let(series, xi=m.atan2(t, m.cos(lam)), eta=m.atanh(m.sin(lam) / m.sqrt(m.lit(1.0) + t * t)))

        def series(xi, eta):
            east, up = eta, xi
            for j, a in enumerate(_ALPHA, 1):
                east = east + m.lit(a) * m.cos(xi * m.lit(2.0 * j)) * m.sinh(eta * m.lit(2.0 * j))
                up = up + m.lit(a) * m.sin(xi * m.lit(2.0 * j)) * m.cosh(eta * m.lit(2.0 * j))
            scale = m.lit(UTM_SCALE * _RECT)
            return m.point(m.lit(UTM_FALSE_EAST) + scale * east, m.lit(north) + scale * up)

        return m.let(conformal, s=m.sin(m.radians(lat)), lam=m.radians(lon) - m.lit(lon0))

    return fn


def _utm_inverse(srid: int):
    lon0, north = _utm_parts(srid)

    def fn(x, y, m=COLUMNS):
        def series(xi, eta):
            xi1, eta1 = xi, eta
            for j, b in enumerate(_BETA, 1):
                xi1 = xi1 - m.lit(b) * m.sin(xi * m.lit(2.0 * j)) * m.cosh(eta * m.lit(2.0 * j))
                eta1 = eta1 - m.lit(b) * m.cos(xi * m.lit(2.0 * j)) * m.sinh(eta * m.lit(2.0 * j))
            return m.let(sphere, xi1=xi1, eta1=eta1)

        def sphere(xi1, eta1):
            lon = m.lit(lon0) + m.atan2(m.sinh(eta1), m.cos(xi1))
            return m.let(geodetic, lon=lon, chi=m.asin(m.sin(xi1) / m.cosh(eta1)))

        def geodetic(lon, chi):
            lat = chi
            for j, d in enumerate(_DELTA, 1):
                lat = lat + m.lit(d) * m.sin(chi * m.lit(2.0 * j))
            return m.point(m.degrees(lon), m.degrees(lat))

        scale = m.lit(UTM_SCALE * _RECT)
        return m.let(series, xi=(y - m.lit(north)) / scale, eta=(x - m.lit(UTM_FALSE_EAST)) / scale)

    return fn


_E2 = FLATTENING_GRS80 * (2 - FLATTENING_GRS80)
_E = math.sqrt(_E2)


def _q_of(sin_lat: float) -> float:
    return (1 - _E2) * (
        sin_lat / (1 - _E2 * sin_lat**2)
        - math.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E)
    )


_QP = _q_of(1.0)
_RQ = SEMI_MAJOR * math.sqrt(_QP / 2)
_BETA1 = math.asin(_q_of(math.sin(math.radians(LAEA_LAT0))) / _QP)
_M1 = math.cos(math.radians(LAEA_LAT0)) / math.sqrt(1 - _E2 * math.sin(math.radians(LAEA_LAT0)) ** 2)
_D = SEMI_MAJOR * _M1 / (_RQ * math.cos(_BETA1))


def _laea_forward(lon, lat, m=COLUMNS):
    e, e2 = m.lit(_E), m.lit(_E2)
    one = m.lit(1.0)
    sb1, cb1 = m.lit(math.sin(_BETA1)), m.lit(math.cos(_BETA1))

    def authalic(s, lam):
        q = m.lit(1 - _E2) * (s / (one - e2 * s * s) - m.log((one - e * s) / (one + e * s)) / m.lit(2 * _E))
        return m.let(sphere, beta=m.asin(m.greatest(m.lit(-1.0), m.least(one, q / m.lit(_QP)))), lam=lam)

    def sphere(beta, lam):
        b = m.lit(_RQ) * m.sqrt(m.lit(2.0) / (one + sb1 * m.sin(beta) + cb1 * m.cos(beta) * m.cos(lam)))
        return m.let(plane, b=b, beta=beta, lam=lam)

    def plane(b, beta, lam):
        x = m.lit(LAEA_FE) + b * m.lit(_D) * m.cos(beta) * m.sin(lam)
        y = m.lit(LAEA_FN) + b / m.lit(_D) * (cb1 * m.sin(beta) - sb1 * m.cos(beta) * m.cos(lam))
        return m.point(x, y)

    return m.let(authalic, s=m.sin(m.radians(lat)), lam=m.radians(lon) - m.lit(math.radians(LAEA_LON0)))


def _laea_inverse(x, y, m=COLUMNS):
    sb1, cb1 = m.lit(math.sin(_BETA1)), m.lit(math.cos(_BETA1))

    def polar(dx, dy):
        return m.let(sphere, dx=dx, dy=dy, rho=m.hypot(dx / m.lit(_D), dy * m.lit(_D)))

    def sphere(dx, dy, rho):
        return m.let(authalic, dx=dx, dy=dy, rho=rho, c=m.lit(2.0) * m.asin(rho / m.lit(2 * _RQ)))

    def authalic(dx, dy, rho, c):
        ratio = m.coalesce(m.try_divide(dy * m.lit(_D) * m.sin(c) * cb1, rho), m.lit(0.0))
        lon = m.lit(math.radians(LAEA_LON0)) + m.atan2(
            dx * m.sin(c), m.lit(_D) * rho * cb1 * m.cos(c) - m.lit(_D * _D) * dy * sb1 * m.sin(c)
        )
        return m.let(geodetic, lon=lon, beta=m.asin(m.cos(c) * sb1 + ratio))

    def geodetic(lon, beta):
        lat = (
            beta
            + m.lit(_E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040) * m.sin(beta * 2)
            + m.lit(23 * _E2**2 / 360 + 251 * _E2**3 / 3780) * m.sin(beta * 4)
            + m.lit(761 * _E2**3 / 45360) * m.sin(beta * 6)
        )
        return m.point(m.degrees(lon), m.degrees(lat))

    return m.let(polar, dx=x - m.lit(LAEA_FE), dy=y - m.lit(LAEA_FN))


def _forward(srid: int):
    if srid == 3857:
        return _mercator_forward
    return _laea_forward if srid == 3035 else _utm_forward(srid)


def _inverse(srid: int):
    if srid == 3857:
        return _mercator_inverse
    return _laea_inverse if srid == 3035 else _utm_inverse(srid)


def _moved(x, y, from_srid: int, to_srid: int, m):
    """The point in another system: a struct, or a pair of arrays."""
    if from_srid == to_srid:
        return m.point(x, y)
    if from_srid == 4326:
        return _forward(to_srid)(x, y, m)
    point = _inverse(from_srid)(x, y, m)
    if to_srid == 4326:
        return point
    return m.moved(point, lambda x, y: _forward(to_srid)(x, y, m))


def reproject_xy(x, y, from_srid: int, to_srid: int, m=COLUMNS):
    """Coordinates moved from one system to another: columns, or numpy arrays with ``m=NUMPY``."""
    return m.xy(_moved(x, y, from_srid, to_srid, m))


def reproject(geom: Column | str, from_srid: int, to_srid: int) -> Column:
    """Every vertex of a geometry moved from one reference system to another."""
    geom = F.col(geom) if isinstance(geom, str) else geom
    return F.transform(geom, lambda ring: F.transform(ring, lambda p: _moved(p["x"], p["y"], from_srid, to_srid, COLUMNS)))
