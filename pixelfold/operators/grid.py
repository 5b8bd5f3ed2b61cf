"""Affine raster grid and the scan-line rewrite of polygons to grid cells.

Spatial joins in this package are equi-joins on (row, col), or on (row, block of columns) where a
polygon is kept as runs of cells. Both come from higher-order Column expressions and ``explode`` steps:
no shuffle, no Python, and work proportional to the cells or runs produced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geometry as G
from ..functions.crs import reproject

# Blocks of runs are at most this wide (as a power of two).
MOST_SHIFT = 12


@dataclass(frozen=True)
class Grid:
    """Cell (row, col) spans x0+col*dx .. and y0+row*dy ..; dy < 0 is north-up."""

    x0: float
    y0: float
    dx: float
    dy: float
    width: int
    height: int
    srid: int = 4326

    def __post_init__(self) -> None:
        if self.dx <= 0 or self.dy == 0 or self.width <= 0 or self.height <= 0:
            raise ValueError("grid needs dx > 0, dy != 0 and a positive size")

    def x_of(self, col: Column) -> Column:
        return F.lit(self.x0) + (col + F.lit(0.5)) * F.lit(self.dx)

    def y_of(self, row: Column) -> Column:
        return F.lit(self.y0) + (row + F.lit(0.5)) * F.lit(self.dy)

    def col_of(self, x: Column) -> Column:
        return F.floor((x - F.lit(self.x0)) / F.lit(self.dx)).cast("int")

    def row_of(self, y: Column) -> Column:
        return F.floor((y - F.lit(self.y0)) / F.lit(self.dy)).cast("int")


@dataclass(frozen=True)
class ZoneExtent:
    """Cell range covered by a zone layer and upper bounds of its cells and runs.

    Runs are cut at blocks of 2**shift columns, about the mean width of the layer's polygons;
    ``max_runs`` bounds those of equal membership, ``max_cover_runs`` those of equal coverage.
    """

    row_min: int
    row_max: int
    col_min: int
    col_max: int
    max_cells: int
    max_runs: int = 0
    max_cover_runs: int = 0
    shift: int = 0

    @property
    def empty(self) -> bool:
        return self.max_cells == 0


def zones_on_grid(zones: DataFrame, grid: Grid) -> DataFrame:
    """The layer with its geometries in the grid's reference system.

    A layer with a ``srid`` column is moved row by row: its distinct systems, a handful of
    numbers, become the branches of one expression. A row without a system, or with one that
    the transforms do not know, is an error. A layer without the column is taken to be on the grid.
    """
    if "srid" not in zones.columns:
        return zones
    found = [r[0] for r in zones.select("srid").distinct().collect()]
    if any(s is None for s in found):
        raise ValueError("a zone has no srid")
    if all(int(s) == grid.srid for s in found):
        return zones
    moved = F.when(F.col("srid") == grid.srid, F.col("geom"))
    for s in sorted({int(s) for s in found} - {grid.srid}):
        moved = moved.when(F.col("srid") == s, reproject("geom", s, grid.srid))
    return zones.withColumn("geom", moved)


def _cell_window(z: DataFrame, grid: Grid) -> DataFrame:
    """Adds the clipped cell window (_r0.._r1, _c0.._c1) of every geometry."""
    b = G.bounds("geom")
    ra = (F.col("_b.miny") - F.lit(grid.y0)) / F.lit(grid.dy)
    rb = (F.col("_b.maxy") - F.lit(grid.y0)) / F.lit(grid.dy)
    ca = (F.col("_b.minx") - F.lit(grid.x0)) / F.lit(grid.dx)
    cb = (F.col("_b.maxx") - F.lit(grid.x0)) / F.lit(grid.dx)
    top, left = F.lit(float(grid.height - 1)), F.lit(float(grid.width - 1))
    zero = F.lit(0.0)
    return (
        z.where(F.col("geom").isNotNull())
        .withColumn("_b", b)
        .withColumn("_r0", F.greatest(F.floor(F.least(ra, rb)).cast("double"), zero))
        .withColumn("_r1", F.least((F.ceil(F.greatest(ra, rb)) - 1).cast("double"), top))
        .withColumn("_c0", F.greatest(F.floor(ca).cast("double"), zero))
        .withColumn("_c1", F.least((F.ceil(cb) - 1).cast("double"), left))
        .where("_r0 <= _r1 AND _c0 <= _c1")
        .withColumns({c: F.col(c).cast("int") for c in ("_r0", "_r1", "_c0", "_c1")})
    )


def zone_extent(zones: DataFrame, grid: Grid) -> ZoneExtent:
    """One-row aggregate over the zone table: range filter and broadcast bounds.

    Reads only geometries, never pixels. The range becomes literal
    predicates on the pixel scan; the bounds decide the join strategy. An edge crosses the centres of at most
    one row more than its height, and touches at most three cells more in a row than its width there.
    """
    w = _cell_window(zones.select("geom"), grid)
    rows = (F.col("_r1") - F.col("_r0") + 1).cast("long")
    cells = rows * (F.col("_c1") - F.col("_c0") + 1)

    def total(of: Column) -> Column:
        return F.aggregate("_n", F.lit(0.0), lambda a, e: a + e[of])

    def reach(e: Column) -> Column:
        high = F.least(F.abs(e["yb"] - e["ya"]) / F.lit(abs(grid.dy)), rows.cast("double"))
        wide = F.least(F.abs(e["xb"] - e["xa"]) / F.lit(grid.dx), (F.col("_c1") - F.col("_c0") + 1).cast("double"))
        return F.struct((high + 1).alias("crossed"), (wide + 3 * (high + 2)).alias("touched"))

    w = w.withColumn("_n", F.transform(G.edges("geom"), reach))
    spans = F.least(cells.cast("double"), total("crossed") / 2)
    covers = F.least(cells.cast("double"), 2 * total("touched") + rows)
    r = w.agg(
        F.min("_r0").alias("r0"),
        F.max("_r1").alias("r1"),
        F.min("_c0").alias("c0"),
        F.max("_c1").alias("c1"),
        F.sum(cells).alias("n"),
        F.sum(rows).alias("rows"),
        F.ceil(F.sum(spans)).alias("spans"),
        F.ceil(F.sum(covers)).alias("covers"),
    ).first()
    if r["n"] is None:
        return ZoneExtent(0, -1, 0, -1, 0)
    shift = min(MOST_SHIFT, int(math.log2(r["n"] / r["rows"])))
    # Borders of blocks inside a row's window: one more than its columns fill.
    cuts = (r["n"] >> shift) + r["rows"]
    return ZoneExtent(r["r0"], r["r1"], r["c0"], r["c1"], r["n"], min(r["n"], r["spans"] + cuts), min(r["n"], r["covers"] + cuts), shift)


def crop_to_extent(pixels: DataFrame, ext: ZoneExtent) -> DataFrame:
    """Literal row/col range, pushed down to Parquet statistics by the scan."""
    return pixels.where(
        F.col("row").between(ext.row_min, ext.row_max) & F.col("col").between(ext.col_min, ext.col_max)
    )


def _zone_rows(zones: DataFrame, grid: Grid, keep: list[str], spread: bool) -> DataFrame:
    """One row per polygon and raster row: keep, _c0, _c1, edges, row.

    ``spread`` shuffles these (not the far more numerous cells) by key and row, so
    that one huge polygon is filled by many tasks.
    """
    w = _cell_window(zones.select(*keep, "geom"), grid)
    rows = w.select(*keep, "_c0", "_c1", G.edges("geom").alias("_e"), F.explode(F.sequence("_r0", "_r1")).alias("row"))
    return rows.repartition(*keep, "row") if spread else rows


def _zone_spans(zones: DataFrame, grid: Grid, keep: list[str], spread: bool) -> DataFrame:
    """Spans of cells whose centre lies in the polygon: ``keep`` columns + row, _s (STRUCT(a, b), first and last column)."""
    rows = _zone_rows(zones, grid, keep, spread)
    yc = grid.y_of(F.col("row"))
    crossing = F.transform(
        F.filter("_e", lambda e: (e["ya"] <= yc) != (e["yb"] <= yc)),
        lambda e: e["xa"] + F.try_divide((yc - e["ya"]) * (e["xb"] - e["xa"]), e["yb"] - e["ya"]),
    )
    rows = rows.select(*keep, "row", F.array_sort(crossing).alias("_x")).where(F.size("_x") > 1)

    def span(i: Column) -> Column:
        def first_col(x: Column) -> Column:
            return F.ceil((x - F.lit(grid.x0)) / F.lit(grid.dx) - F.lit(0.5)).cast("long")

        return F.named_struct(
            F.lit("a"),
            F.greatest(first_col(F.get("_x", i * 2)), F.lit(0)).cast("int"),
            F.lit("b"),
            F.least(first_col(F.get("_x", i * 2 + 1)) - 1, F.lit(grid.width - 1)).cast("int"),
        )

    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("_x") / 2).cast("int") - 1), span)
    return rows.select(*keep, "row", F.explode(F.filter(pairs, lambda s: s["a"] <= s["b"])).alias("_s"))


def zone_cells(zones: DataFrame, grid: Grid, keep: list[str], spread: bool = False) -> DataFrame:
    """Cells whose centre lies in the polygon: ``keep`` columns + row, col.

    Half-open on both axes (low border in, high border out), so neighbouring
    polygons neither share nor lose a cell. Holes and multi-part polygons work by
    the even-odd rule.
    """
    spans = _zone_spans(zones, grid, keep, spread)
    return spans.select(*keep, "row", F.explode(F.sequence("_s.a", "_s.b")).alias("col"))


def _in_blocks(runs: DataFrame, shift: int) -> DataFrame:
    """Each run (_a .. _b) once for every block of 2**shift columns that it meets."""
    blocks = F.sequence(F.shiftright("_a", shift), F.shiftright("_b", shift))
    return runs.withColumn("_block", F.explode(blocks))


def zone_runs(zones: DataFrame, grid: Grid, keep: list[str], shift: int, spread: bool = False) -> DataFrame:
    """The cells of ``zone_cells`` as runs: ``keep`` + row, _block, _a, _b. Their number follows the polygon's border."""
    spans = _zone_spans(zones, grid, keep, spread)
    return _in_blocks(spans.select(*keep, "row", F.col("_s.a").alias("_a"), F.col("_s.b").alias("_b")), shift)


def join_runs(pixels: DataFrame, runs: DataFrame, shift: int, keep: list[str]) -> DataFrame:
    """Pixels inside the runs: an equi-join on (row, block), then the column's place in the run."""
    blocked = pixels.withColumn("_block", F.shiftright("col", shift))
    met = blocked.join(runs, ["row", "_block"]).where(F.col("col").between(F.col("_a"), F.col("_b")))
    return met.select("row", "col", *[c for c in pixels.columns if c not in ("row", "col")], *keep)


def coverage_cells(
    zones: DataFrame, grid: Grid, keep: list[str], window: bool = False, spread: bool = False
) -> DataFrame:
    """Exact share of each cell's area inside the polygon: ``keep`` + row, col, coverage.

    With ``window=True`` the cells of the polygon's bounding window with coverage
    0 are kept too.
    """
    rows, share, _ = _row_slabs(zones, grid, keep, spread)
    cells = F.transform(F.sequence("_c0", "_c1"), lambda c: F.named_struct(F.lit("col"), c, F.lit("coverage"), share(c)))
    if not window:
        cells = F.filter(cells, lambda c: c["coverage"] > 0)
    return rows.select(*keep, "row", F.inline(cells))


def _row_slabs(
    zones: DataFrame, grid: Grid, keep: list[str], spread: bool
) -> tuple[DataFrame, Callable[[Column], Column], Callable[[Column], Column]]:
    """Polygon rows with their edges cut to the row (_s); the share of a column's cell; whether an edge touches it."""
    rows = _zone_rows(zones, grid, keep, spread)
    ya = F.lit(grid.y0) + F.col("row") * F.lit(grid.dy)
    yb = F.lit(grid.y0) + (F.col("row") + 1) * F.lit(grid.dy)
    slabs = G.edge_slabs(F.col("_e"), F.least(ya, yb), F.greatest(ya, yb))
    # The one-element explode keeps the slabs from being computed anew for every cell.
    rows = rows.select(*keep, "row", "_c0", "_c1", F.explode(F.array(slabs)).alias("_s"))

    def ends(col: Column) -> tuple[Column, Column]:
        return F.lit(grid.x0) + col * F.lit(grid.dx), F.lit(grid.x0) + (col + 1) * F.lit(grid.dx)

    def share(col: Column) -> Column:
        return G.slab_area(F.col("_s"), *ends(col)) / F.lit(abs(grid.dx * grid.dy))

    def touched(col: Column) -> Column:
        xa, xb = ends(col)
        return F.exists("_s", lambda e: (e["u"] <= xb) & (e["v"] >= xa))

    return rows, share, touched


def coverage_runs(
    zones: DataFrame, grid: Grid, keep: list[str], shift: int, window: bool = False, spread: bool = False
) -> DataFrame:
    """The cells of ``coverage_cells`` as runs of equal coverage: ``keep`` + row, _block, _a, _b, coverage.

    A cell that an edge touches is a run of its own; the cells between two of them are alike, so the share is worked
    out for the first one only.
    """
    rows, share, touched = _row_slabs(zones, grid, keep, spread)
    starts = F.filter(F.sequence("_c0", "_c1"), lambda c: (c == F.col("_c0")) | touched(c) | touched(c - 1))
    rows = rows.select(*keep, "row", "_c1", "_s", F.explode(F.array(starts)).alias("_st"))

    def run(c: Column, i: Column) -> Column:
        last = F.coalesce(F.get("_st", i + 1) - 1, F.col("_c1"))
        return F.named_struct(F.lit("_a"), c, F.lit("_b"), last, F.lit("coverage"), share(c))

    runs = F.transform("_st", run)
    if not window:
        runs = F.filter(runs, lambda r: r["coverage"] > 0)
    return _in_blocks(rows.select(*keep, "row", F.inline(runs)), shift)
