"""Rasters on other lattices: between reference systems, and at ratios that are no whole number."""

from __future__ import annotations

import math

from ..functions import crs
from ..operators import raster, warp
from ..operators.grid import Grid
from . import bindings as B
from .registry import day, day_sql, query, rounded, rounded_sql

CELL = ["row", "col"]
# The pixel grid placed near 2 degrees east, 52 degrees north, in two systems, and a lattice of another system over each.
DEGREES = Grid(2.0, 52.0, 0.01, -0.01, 16, 16, 4326)
MERCATOR = Grid(222000.0, 6800500.0, 1300.0, -1300.0, 15, 24, 3857)
UTM = Grid(430000.0, 5762000.0, 1000.0, -1000.0, 16, 16, 32631)
OVER_UTM = Grid(1.97, 52.02, 0.012, -0.008, 24, 22, 4326)
EUROPE = Grid(3766000.0, 3240500.0, 700.0, -700.0, 36, 42, 3035)


def _centres(g: Grid) -> str:
    """Target cells with their centres."""
    return (
        f"SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c, {g.x0!r}::DOUBLE + (c + 0.5::DOUBLE) * {g.dx!r}::DOUBLE AS x, {g.y0!r}::DOUBLE + (r + 0.5::DOUBLE) * ({g.dy!r})::DOUBLE AS y"
        f" FROM (SELECT unnest(range({g.height})) AS r) AS a, (SELECT unnest(range({g.width})) AS c) AS b"
    )


def _places(g: Grid, of: str) -> str:
    """Fractional source rows and columns of moved centres (sx, sy)."""
    return f"SELECT r, c, (sy - {g.y0!r}::DOUBLE) / ({g.dy!r})::DOUBLE AS sr, (sx - {g.x0!r}::DOUBLE) / {g.dx!r}::DOUBLE AS sc FROM {of}"


FROM_MERCATOR = f"SELECT r, c, degrees(x / {crs.SEMI_MAJOR}::DOUBLE) AS sx, degrees(atan(sinh(y / {crs.SEMI_MAJOR}::DOUBLE))) AS sy FROM t"
NEAREST = f"SELECT {day_sql()}, s.r AS row, s.c AS col, nir, scl FROM px JOIN s ON px.row = floor(sr) AND px.col = floor(sc)"


def _to_utm(lon0: float) -> str:
    """Lon/lat centres in UTM north, by the series of the public guidance notes."""
    n = crs.FLATTENING / (2 - crs.FLATTENING)
    k = 2 * math.sqrt(n) / (1 + n)
    a = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    radius = crs.SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    east = " + ".join(f"{v!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, v in enumerate(a, 1))
    north = " + ".join(f"{v!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, v in enumerate(a, 1))
    tau = f"sinh(atanh(sin(radians(y))) - {k!r}::DOUBLE * atanh({k!r}::DOUBLE * sin(radians(y))))"
    lam = f"(radians(x) - {math.radians(lon0)!r}::DOUBLE)"
    angles = f"SELECT r, c, atan2({tau}, cos({lam})) AS xi, atanh(sin({lam}) / sqrt(1 + {tau} * {tau})) AS eta FROM t"
    return f"SELECT r, c, 500000::DOUBLE + {radius!r}::DOUBLE * (eta + {east}) AS sx, {radius!r}::DOUBLE * (xi + {north}) AS sy FROM ({angles}) AS angles"


@query("warped_nearest_to_mercator", B.sql("px", t=_centres(MERCATOR), m=FROM_MERCATOR, s=_places(DEGREES, "m")) + NEAREST)
def _(spark, d):
    px = B.pixels(spark, d).select("time", *CELL, "nir", "scl")
    return raster.resample_nearest(px, DEGREES, MERCATOR).select(day(), *CELL, "nir", "scl")


@query("warped_nearest_from_utm", B.sql("px", t=_centres(OVER_UTM), m=_to_utm(3.0), s=_places(UTM, "m")) + NEAREST)
def _(spark, d):
    out = warp.warp(B.pixels(spark, d), UTM, OVER_UTM, ["nir", "scl"])
    return out.select(day(), *CELL, "nir", "scl")


def _bilinear(value: str) -> str:
    return (
        "SELECT time, r, c, "
        f"sum(w * {value}) / sum(w) FILTER ({value} IS NOT NULL) AS v FROM (SELECT px.*, s.r, s.c, (1 - abs(sr - 0.5 - px.row)) * (1 - abs(sc - 0.5 - px.col)) AS w"
        " FROM px JOIN (SELECT s.*, i, j FROM s, (SELECT unnest([0, 1]) AS i) AS a, (SELECT unnest([0, 1]) AS j) AS b) AS s ON px.row = floor(sr - 0.5) + i AND px.col = floor(sc - 0.5) + j) AS near"
        " WHERE w > 0 GROUP BY time, r, c"
    )


@query(
    "warped_bilinear_from_utm",
    B.sql("px", t=_centres(OVER_UTM), m=_to_utm(3.0), s=_places(UTM, "m"), v=_bilinear("nir"))
    + f"SELECT {day_sql()}, r AS row, c AS col, {rounded_sql('v', 4)} AS nir FROM v WHERE v IS NOT NULL",
)
def _(spark, d):
    out = warp.warp(B.pixels(spark, d), UTM, OVER_UTM, ["nir"], "bilinear")
    return out.select(day(), *CELL, rounded("nir", 4).alias("nir"))


@query(
    "warped_bilinear_to_mercator",
    B.sql("px", t=_centres(MERCATOR), m=FROM_MERCATOR, s=_places(DEGREES, "m"), v=_bilinear("red"))
    + f"SELECT {day_sql()}, r AS row, c AS col, {rounded_sql('v', 4)} AS red FROM v WHERE v IS NOT NULL",
)
def _(spark, d):
    out = warp.warp(B.pixels(spark, d), DEGREES, MERCATOR, ["red"], "bilinear")
    return out.select(day(), *CELL, rounded("red", 4).alias("red"))


# 2.5 pixels to a cell, laid off by a quarter of a pixel.
COARSER = Grid(0.25, 0.25, 2.5, 2.5, 6, 6)
SHARES = (
    "SELECT px.*, r, c, (least(row + 1, r * 2.5::DOUBLE + 2.75) - greatest(row, r * 2.5::DOUBLE + 0.25)) * (least(col + 1, c * 2.5::DOUBLE + 2.75) - greatest(col, c * 2.5::DOUBLE + 0.25)) AS w"
    " FROM px, (SELECT CAST(unnest(range(6)) AS INT) AS r) AS a, (SELECT CAST(unnest(range(6)) AS INT) AS c) AS b"
    " WHERE r * 2.5::DOUBLE + 0.25 < row + 1 AND r * 2.5::DOUBLE + 2.75 > row AND c * 2.5::DOUBLE + 0.25 < col + 1 AND c * 2.5::DOUBLE + 2.75 > col"
)


@query(
    "resampled_conservative_mean",
    B.sql("px", w=SHARES) + f"SELECT {day_sql()}, r AS row, c AS col, {rounded_sql('sum(w * nir) / sum(w)')} AS nir, {rounded_sql('sum(w * red) / sum(w)')} AS red FROM w GROUP BY time, r, c",
)
def _(spark, d):
    out = warp.resample_conservative(B.pixels(spark, d), B.PX_GRID, COARSER, ["nir", "red"])
    return out.select(day(), *CELL, rounded("nir").alias("nir"), rounded("red").alias("red"))


@query(
    "resampled_conservative_sum",
    B.sql("px", w=SHARES) + f"SELECT {day_sql()}, r AS row, c AS col, {rounded_sql('sum(w * nir)')} AS nir FROM w GROUP BY time, r, c",
)
def _(spark, d):
    out = warp.resample_conservative(B.pixels(spark, d), B.PX_GRID, COARSER, ["nir"], "sum")
    return out.select(day(), *CELL, rounded("nir").alias("nir"))
