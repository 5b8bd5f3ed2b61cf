"""Rasters moved to another lattice: warping between reference systems and area-weighted resampling.

``warp`` maps target cells back to the source. The target is cut into blocks; the border of a block, sampled and moved to the
source's system, gives the window of source cells it can need. Pixels meet the windows by an equi-join on
source block, are grouped by target block in the one exchange, and a block is filled as arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.crs import NUMPY, reproject_xy
from ..plans.sizing import small_side
from .grid import Grid

CELL = ["row", "col"]
#: Cells along a block of the finer of the two lattices, and samples along each side of a target block.
BLOCK, SAMPLES = 256, 8


def _scale(source: Grid, target: Grid) -> float:
    """Source cells along a target cell, at the middle of the target and its corners (the largest)."""
    most = 1.0
    for c, r in ((0.5, 0.5), (0.02, 0.02), (0.98, 0.02), (0.02, 0.98), (0.98, 0.98)):
        col, row = c * target.width + np.array([0.0, 1.0, 0.0]), r * target.height + np.array([0.0, 0.0, 1.0])
        with np.errstate(all="ignore"):
            x, y = reproject_xy(target.x0 + col * target.dx, target.y0 + row * target.dy, target.srid, source.srid, NUMPY)
        steps = np.hypot((x[1:] - x[0]) / source.dx, (y[1:] - y[0]) / source.dy)
        if np.isfinite(steps).all():
            most = max(most, float(steps.max()))
    return most


def block_windows(pixels: DataFrame, source: Grid, target: Grid, block: int, reach: int) -> DataFrame:
    """_tr, _tc (target block), _r0, _r1, _c0, _c1 (its window of source cells), _sr, _sc (each source block in it).

    No pixel is read. The image of a block is bounded by the image of its border; the margin covers what the border may bulge
    between two samples and the ``reach`` of the interpolation. Blocks whose border leaves the projection's domain are left out.
    """
    down, across = math.ceil(target.height / block), math.ceil(target.width / block)
    t = np.linspace(0.0, 1.0, SAMPLES + 1)
    zero, one = np.zeros_like(t), np.ones_like(t)
    along, up = np.concatenate((t, t, zero, one)), np.concatenate((zero, one, t, t))
    names = ["_tr", "_tc", "_r0", "_r1", "_c0", "_c1"]

    def span(v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = v.min(1), v.max(1)
        margin = (high - low) / 64 + reach + 1
        return np.maximum(np.floor(low - margin), 0), np.minimum(np.ceil(high + margin), n - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tr, tc = np.divmod(b.column("id").to_numpy(), across)
            top, left = tr * block, tc * block
            row = top[:, None] + np.minimum(block, target.height - top)[:, None] * up
            col = left[:, None] + np.minimum(block, target.width - left)[:, None] * along
            with np.errstate(all="ignore"):
                x, y = reproject_xy(target.x0 + col * target.dx, target.y0 + row * target.dy, target.srid, source.srid, NUMPY)
                rows, cols = (y - source.y0) / source.dy, (x - source.x0) / source.dx
            good = (np.isfinite(rows) & np.isfinite(cols) & (np.abs(rows) < 1e9) & (np.abs(cols) < 1e9)).all(1)
            (r0, r1), (c0, c1) = span(rows[good], source.height), span(cols[good], source.width)
            whole = pa.RecordBatch.from_arrays([pa.array(v.astype(np.int32)) for v in (tr[good], tc[good], r0, r1, c0, c1)], names=names)
            yield whole.filter(pa.array((r0 <= r1) & (c0 <= c1)))

    windows = pixels.sparkSession.range(down * across).mapInArrow(run, ", ".join(f"{n} int" for n in names))
    of = lambda a, b: F.sequence(F.floor(F.col(a) / BLOCK).cast("int"), F.floor(F.col(b) / BLOCK).cast("int"))
    return windows.withColumn("_sr", F.explode(of("_r0", "_r1"))).withColumn("_sc", F.explode(of("_c0", "_c1")))


def warp(pixels: DataFrame, source: Grid, target: Grid, bands: Sequence[str], how: str = "nearest", by: Sequence[str] = ("time",)) -> DataFrame:
    """``by``, row, col, ``bands`` on the target grid, whatever the two reference systems.

    ``nearest``: the source pixel whose cell holds the target cell's centre; there is a row where there is such a pixel, with its values
    and types. ``bilinear``: the four pixels around the centre, weighted; missing and NULL ones are left out and the
    other weights scaled up, so a row has a value where any of the four has one (bands become doubles). Pixels are one row for each
    ``by`` and cell. Blocks across the antimeridian or beyond a projection's domain are not filled.
    """
    if how not in ("nearest", "bilinear"):
        raise ValueError("how must be nearest or bilinear")
    block = max(1, int(BLOCK / _scale(source, target)))
    windows = block_windows(pixels, source, target, block, 1 if how == "bilinear" else 0)
    narrow = pixels.select(*by, *CELL, *bands).where(F.col("row").between(0, source.height - 1) & F.col("col").between(0, source.width - 1))
    placed = narrow.withColumns({"_sr": F.floor(F.col("row") / BLOCK).cast("int"), "_sc": F.floor(F.col("col") / BLOCK).cast("int")})
    met = placed.join(small_side(windows), ["_sr", "_sc"]).where("row BETWEEN _r0 AND _r1 AND col BETWEEN _c0 AND _c1")
    bands = list(bands)
    kinds = {f.name: f for f in narrow.schema.fields}
    shown = [kinds[c] for c in by] + [StructField("row", kinds["row"].dataType), StructField("col", kinds["col"].dataType)]
    schema = StructType(shown + [kinds[b] if how == "nearest" else StructField(b, DoubleType()) for b in bands])

    def fill(table: pa.Table) -> pa.Table:
        tr, tc = table.column("_tr")[0].as_py(), table.column("_tc")[0].as_py()
        row = np.arange(tr * block, min((tr + 1) * block, target.height))
        col = np.arange(tc * block, min((tc + 1) * block, target.width))
        row, col = np.repeat(row, len(col)), np.tile(col, len(row))
        with np.errstate(all="ignore"):
            x, y = reproject_xy(target.x0 + (col + 0.5) * target.dx, target.y0 + (row + 0.5) * target.dy, target.srid, source.srid, NUMPY)
            r, c = (y - source.y0) / source.dy, (x - source.x0) / source.dx
        good = np.isfinite(r) & np.isfinite(c)
        row, col, r, c = row[good], col[good], r[good], c[good]
        codes = table.column("row").to_numpy().astype(np.int64) * source.width + table.column("col").to_numpy()
        order = np.argsort(codes)
        codes = codes[order]

        def find(r: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Place of each source cell in the table, and whether it is there."""
            inside = (r >= 0) & (r < source.height) & (c >= 0) & (c < source.width)
            sought = np.where(inside, r * source.width + c, -1).astype(np.int64)
            at = np.minimum(np.searchsorted(codes, sought), len(codes) - 1)
            return order[at], inside & (codes[at] == sought)

        first = [table.column(name)[:1] for name in by]
        if how == "nearest":
            at, there = find(np.floor(r), np.floor(c))
            at, row, col = at[there], row[there], col[there]
            values = [table.column(b).take(pa.array(at)) for b in bands]
        else:
            r, c = r - 0.5, c - 0.5
            r0, c0 = np.floor(r), np.floor(c)
            around = []
            for dr in (0, 1):
                for dc in (0, 1):
                    at, there = find(r0 + dr, c0 + dc)
                    around.append((at, there, np.abs(1 - dr - (r - r0)) * np.abs(1 - dc - (c - c0))))
            some = np.zeros(len(row), bool)
            sums = []
            for b in bands:
                v = table.column(b).to_numpy().astype(np.float64)
                total, weight = np.zeros(len(row)), np.zeros(len(row))
                for at, there, w in around:
                    own = np.where(there, v[at], np.nan)
                    held = ~np.isnan(own) & (w > 0)
                    total += np.where(held, w * own, 0.0)
                    weight += np.where(held, w, 0.0)
                some |= weight > 0
                sums.append((total, weight))
            row, col = row[some], col[some]
            values = [pa.array(t[some] / np.where(w[some] > 0, w[some], 1.0), mask=w[some] == 0) for t, w in sums]
        n = len(row)
        keys = [f.take(pa.array(np.zeros(n, np.int64))) for f in first]
        whole = pa.Table.from_arrays([*keys, pa.array(row), pa.array(col), *values], names=[*by, *CELL, *bands])
        return whole.cast(pa.schema([table.schema.field(c) for c in [*by, *CELL]] + [table.schema.field(b) if how == "nearest" else pa.field(b, pa.float64()) for b in bands]))

    kept = met.select(*by, *CELL, *bands, "_tr", "_tc")
    return kept.groupBy(*by, "_tr", "_tc").applyInArrow(fill, schema)


def _overlaps(i: Column, s0: float, sd: float, t0: float, td: float, n: int) -> Column:
    """Target cells that source cell ``i`` overlaps along one axis: array of STRUCT(at, share of the source cell)."""
    a = (F.lit(s0) + i * F.lit(sd) - F.lit(t0)) / F.lit(td)
    b = (F.lit(s0) + (i + 1) * F.lit(sd) - F.lit(t0)) / F.lit(td)
    low, high = F.least(a, b), F.greatest(a, b)
    first, last = F.greatest(F.floor(low), F.lit(0)), F.least(F.ceil(high) - 1, F.lit(n - 1))
    size = abs(sd / td)
    each = F.transform(
        F.sequence(first, last),
        lambda k: F.named_struct(F.lit("at"), k.cast("int"), F.lit("share"), (F.least(high, k + F.lit(1.0)) - F.greatest(low, k.cast("double"))) / F.lit(size)),
    )
    # Rounding may leave a sliver on a shared border; it is no overlap.
    return F.when(first <= last, F.filter(each, lambda s: s["share"] > 1e-9)).otherwise(F.filter(F.transform(F.array(F.lit(0)), lambda k: F.named_struct(F.lit("at"), k, F.lit("share"), F.lit(0.0))), lambda s: F.lit(False)))


def resample_conservative(pixels: DataFrame, source: Grid, target: Grid, bands: Sequence[str], how: str = "mean", by: Sequence[str] = ("time",)) -> DataFrame:
    """``by``, row, col, ``bands`` on a lattice of any ratio and offset in the same reference system.

    A source cell gives each target cell the share of its area that lies in it; the weights are the product of those of row and
    column. ``mean``: area-weighted mean of the valid values; ``sum``: the values dealt out by area, so that their sum is kept (for
    what lies inside the target). A target cell without any valid value is NULL. Partial sums are combined before the shuffle.
    """
    if source.srid != target.srid:
        raise ValueError("grids of two reference systems: use warp")
    if how not in ("mean", "sum"):
        raise ValueError("how must be mean or sum")
    rows = _overlaps(F.col("row"), source.y0, source.dy, target.y0, target.dy, target.height)
    cols = _overlaps(F.col("col"), source.x0, source.dx, target.x0, target.dx, target.width)
    spread = pixels.select(*by, *bands, F.explode(rows).alias("_r"), cols.alias("_cs")).select(*by, *bands, "_r", F.explode("_cs").alias("_c"))
    share = F.col("_r.share") * F.col("_c.share")
    value = [F.sum(F.col(b) * share) if how == "sum" else F.try_divide(F.sum(F.col(b) * share), F.sum(F.when(F.col(b).isNotNull(), share))) for b in bands]
    return spread.groupBy(*by, F.col("_r.at").alias("row"), F.col("_c.at").alias("col")).agg(*[v.alias(b) for v, b in zip(value, bands)])
