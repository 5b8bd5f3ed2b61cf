"""Raster-to-raster and raster-to-point joins, resampling and tile arithmetic."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .grid import Grid
from .warp import warp

CELL = ["row", "col"]


def sample_nearest(pixels: DataFrame, points: DataFrame, grid: Grid, key: str) -> DataFrame:
    """Pixel nearest to each point: the cell index is arithmetic, the join equi.

    A point outside the grid takes the nearest border cell, one without
    coordinates is dropped.
    """
    def clamp(i: Column, n: int) -> Column:
        return F.least(F.greatest(i, F.lit(0)), F.lit(n - 1)).cast("int")

    located = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(
        key,
        clamp(grid.row_of(F.col("y")), grid.height).alias("row"),
        clamp(grid.col_of(F.col("x")), grid.width).alias("col"),
    )
    return pixels.join(located, CELL)


def resample_nearest(pixels: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """Values moved to another grid; each target cell takes the source cell under
    its centre. Target cells are exploded from the source cell: no join.

    Grids of two reference systems are warped; ``time``, if there, tells their pixels apart."""
    if source.srid != target.srid:
        by = [c for c in ("time",) if c in pixels.columns]
        return warp(pixels, source, target, [c for c in pixels.columns if c not in (*CELL, *by)], "nearest", by).select(*[c for c in pixels.columns if c not in CELL], *CELL)

    def targets(i: str, s0: float, sd: float, t0: float, td: float, n: int) -> Column:
        a = (F.lit(s0) + F.col(i) * F.lit(sd) - F.lit(t0)) / F.lit(td) - F.lit(0.5)
        b = (F.lit(s0) + (F.col(i) + 1) * F.lit(sd) - F.lit(t0)) / F.lit(td) - F.lit(0.5)
        if sd / td > 0:
            lo, hi = F.ceil(a), F.ceil(b) - 1
        else:
            lo, hi = F.floor(b) + 1, F.floor(a)
        lo = F.greatest(lo, F.lit(0)).cast("int")
        hi = F.least(hi, F.lit(n - 1)).cast("int")
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    rows = targets("row", source.y0, source.dy, target.y0, target.dy, target.height)
    cols = targets("col", source.x0, source.dx, target.x0, target.dx, target.width)
    rest = [c for c in pixels.columns if c not in CELL]
    return pixels.select(*rest, cols.alias("_cols"), F.explode(rows).alias("row")).select(
        *rest, "row", F.explode("_cols").alias("col")
    )


def decimate(pixels: DataFrame, k: int) -> DataFrame:
    """Every k-th row and column, renumbered: an overview without averaging."""
    kept = pixels.where((F.col("row") % k == 0) & (F.col("col") % k == 0))
    return kept.withColumns({c: (F.col(c) / F.lit(k)).cast("int") for c in CELL})


def resample_grid(pixels: DataFrame, k: int, bands: Sequence[str], how: str = "mean", by: Sequence[str] = ("time",)) -> DataFrame:
    """k x k cells to one: mean of the valid values, or the cell nearest to the
    centre (the lower one of two)."""
    if how == "nearest":
        mid = (k - 1) // 2
        kept = pixels.where((F.col("row") % k == mid) & (F.col("col") % k == mid))
        return kept.withColumns({c: F.floor(F.col(c) / F.lit(k)).cast("int") for c in CELL}).select(*by, *CELL, *bands)
    cell = [F.floor(F.col(c) / F.lit(k)).cast("int").alias(c) for c in CELL]
    return pixels.groupBy(*by, *cell).agg(*[F.avg(b).alias(b) for b in bands])


def period_difference(pre: DataFrame, post: DataFrame, bands: Sequence[str]) -> DataFrame:
    """pre - post per cell, for cells present in both periods."""
    a = pre.select(*CELL, *[F.col(b).alias(f"_a_{b}") for b in bands])
    b_ = post.select(*CELL, *[F.col(b).alias(f"_b_{b}") for b in bands])
    return a.join(b_, CELL).select(*CELL, *[(F.col(f"_a_{b}") - F.col(f"_b_{b}")).alias(b) for b in bands])


# ---- slippy tiles -----------------------------------------------------------

MAX_MERCATOR_LAT = 85.0511287798066  # fixed value: latitude limit of square Web Mercator


def tile_x(lon: Column, zoom: int) -> Column:
    n = 2**zoom
    return F.least(
        F.greatest(F.floor((lon + F.lit(180.0)) / F.lit(360.0) * F.lit(float(n))), F.lit(0)), F.lit(n - 1)
    ).cast("long")


def tile_y(lat: Column, zoom: int) -> Column:
    n = 2**zoom
    lat = F.radians(F.least(F.greatest(lat, F.lit(-MAX_MERCATOR_LAT)), F.lit(MAX_MERCATOR_LAT)))
    t = (F.lit(1.0) - F.log(F.tan(lat) + F.lit(1.0) / F.cos(lat)) / F.lit(math.pi)) / F.lit(2.0)
    return F.least(F.greatest(F.floor(t * F.lit(float(n))), F.lit(0)), F.lit(n - 1)).cast("long")


def tile_cover(boxes: DataFrame, zoom: int, keep: Sequence[str] = ()) -> DataFrame:
    """Tiles (z, tx, ty) that a lon/lat box (minx, miny, maxx, maxy) touches at a zoom.

    A box whose ``minx`` is larger than its ``maxx`` crosses the antimeridian."""
    whole = boxes.dropna(subset=["minx", "miny", "maxx", "maxy"])
    west, east = tile_x(F.col("minx"), zoom), tile_x(F.col("maxx"), zoom)
    first, last = F.lit(0).cast("long"), F.lit(2**zoom - 1).cast("long")
    around = F.array_distinct(F.concat(F.sequence(west, last), F.sequence(first, east)))
    columns = F.when(F.col("minx") <= F.col("maxx"), F.sequence(west, F.greatest(west, east))).otherwise(around)
    return (
        whole.withColumn("tx", F.explode(columns))
        .withColumn("ty", F.explode(F.sequence(tile_y(F.col("maxy"), zoom), tile_y(F.col("miny"), zoom))))
        .select(*keep, F.lit(zoom).alias("z"), "tx", "ty")
    )


def features_by_tile(boxes: DataFrame, zoom: int) -> DataFrame:
    """Number of features per tile; map-side combined, so a crowded tile is no bottleneck."""
    return tile_cover(boxes, zoom).groupBy("z", "tx", "ty").agg(F.count("*").alias("features"))
