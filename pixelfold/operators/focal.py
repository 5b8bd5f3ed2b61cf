"""Neighbourhood operators on square blocks with a halo.

Each cell is sent to the block that owns it and, near a border, to the
neighbours that need it as halo: about (1 + 2*halo/size)^2 of the rows in one
exchange, against k^2 for joining every cell with its k x k neighbours. Inside
a task a block is one small dense array and the arithmetic is vectorised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .runs import sorted_groups

CELL = ["row", "col"]
Block = Mapping[str, np.ndarray]


def apply_neighborhood(
    pixels: DataFrame,
    fn: Callable[[Block], Block],
    bands: Sequence[str],
    out: Sequence[str],
    size: int = 64,
    overlap: int = 32,
    by: Sequence[str] = ("time",),
    unique: bool = False,
    full_window: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Run ``fn`` on every size x size block with ``overlap`` cells around it.

    ``fn`` takes {band: array of (size + 2*overlap)^2, NaN where no cell} and
    returns arrays of the same shape by output name; the core cells that exist
    in the input are kept. A block holds at most (size + 2*overlap)^2 cells:
    copies of a cell are folded (highest value) before blocks are formed, unless
    the caller states that cells are ``unique``. With ``full_window=False`` the
    arrays shrink to the part of the window that has cells. The columns ``carry`` of
    the core cells come out unchanged, so no join back to the input is needed.
    """
    by, bands, out = list(by), list(bands), list(out)
    carried = [f"_k{i}" for i in range(len(carry))]
    src = pixels.select(
        *by, *CELL, *[F.col(b).cast("double").alias(b) for b in bands], *[F.col(c).alias(k) for c, k in zip(carry, carried)]
    )
    if not unique:
        src = src.groupBy(*by, *CELL).agg(*[F.max(b).alias(b) for b in [*bands, *carried]])

    def owners(i: str):
        lo = F.greatest(F.floor((F.col(i) - overlap) / F.lit(size)), F.lit(0)).cast("int")
        hi = F.floor((F.col(i) + overlap) / F.lit(size)).cast("int")
        return F.explode(F.sequence(lo, hi))

    blocks = src.withColumn("_br", owners("row")).withColumn("_bc", owners("col"))
    side = size + 2 * overlap

    keys = [*by, "_br", "_bc"]

    def one(block_row: int, block_col: int, row: np.ndarray, col: np.ndarray, vals: Block):
        """Core flags of a block's cells and the results of the core cells."""
        top, left = block_row * size, block_col * size
        core = (row >= top) & (row < top + size) & (col >= left) & (col < left + size)
        if not core.any():
            return core, None
        if full_window:
            r0, c0, shape = top - overlap, left - overlap, (side, side)
        else:
            r0, c0 = row.min(), col.min()
            shape = (row.max() - r0 + 1, col.max() - c0 + 1)
        block = {}
        for b in bands:
            block[b] = np.full(shape, np.nan)
            block[b][row - r0, col - c0] = vals[b]
        result = fn(block)
        at = row[core] - r0, col[core] - c0
        return core, {o: np.asarray(result[o], dtype=float)[at] for o in out}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in sorted_groups(batches, keys):
            t = groups.table
            column = {c: t[c].to_numpy() for c in [*CELL, "_br", "_bc", *bands]}
            keep = np.zeros(t.num_rows, dtype=bool)
            values = {o: np.full(t.num_rows, np.nan) for o in out}
            for i, j in zip(groups.starts, np.append(groups.starts[1:], t.num_rows)):
                core, result = one(
                    int(column["_br"][i]), int(column["_bc"][i]), column["row"][i:j], column["col"][i:j],
                    {b: column[b][i:j] for b in bands},
                )
                if result is not None:
                    keep[i:j] = core
                    for o in out:
                        values[o][i:j][core] = result[o]
            rows = np.flatnonzero(keep)
            kept = t.select(by + CELL + carried).take(pa.array(rows))
            for o in out:
                v = values[o][rows]
                kept = kept.append_column(pa.field(o, pa.float64()), pa.array(v, mask=np.isnan(v)))
            yield from kept.combine_chunks().to_batches()

    schema = T.StructType([src.schema[c] for c in by + CELL + carried] + [T.StructField(o, T.DoubleType()) for o in out])
    found = blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
    return found.select(*by, *CELL, *[F.col(k).alias(c) for c, k in zip(carry, carried)], *out)


def convolve(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Sum of kernel[i, j] * a[r+i-h, c+j-h]; missing cells count as 0."""
    a = np.nan_to_num(a)
    hr, hc = kernel.shape[0] // 2, kernel.shape[1] // 2
    padded = np.pad(a, ((hr, hr), (hc, hc)))
    total = np.zeros_like(a)
    for i, j in np.argwhere(kernel):
        total += kernel[i, j] * padded[i : i + a.shape[0], j : j + a.shape[1]]
    return total


def _check_odd(kernel: np.ndarray) -> None:
    if kernel.ndim != 2 or kernel.shape[0] % 2 == 0 or kernel.shape[1] % 2 == 0:
        raise ValueError("kernel sides must be odd")


def apply_kernel(
    pixels: DataFrame,
    kernel: Sequence[Sequence[float]],
    band: str,
    out: str | None = None,
    size: int = 256,
    by: Sequence[str] = ("time",),
    unique: bool = False,
) -> DataFrame:
    """Weighted neighbourhood sum of one band; cells outside the raster count as 0."""
    k = np.asarray(kernel, dtype=float)
    _check_odd(k)
    name = out or band
    return apply_neighborhood(
        pixels, lambda blk: {name: convolve(blk[band], k)}, [band], [name], size, max(k.shape) // 2, by, unique, False
    )


def gaussian_weights(size: int = 11, std: float = 1.6) -> np.ndarray:
    """Sampled Gaussian of odd length with sum 1; its outer product is the 2-D kernel."""
    i = np.arange(size) - (size - 1) / 2
    g = np.exp(-0.5 * (i / std) ** 2)
    return g / g.sum()


def dilate_mask(
    pixels: DataFrame,
    mask: str,
    size: int = 11,
    std: float = 1.6,
    thr: float = 0.1,
    block: int = 256,
    by: Sequence[str] = ("time",),
    unique: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Boolean mask smoothed by a Gaussian and cut at ``thr``: by, row, col, ``carry``, mask."""
    g = gaussian_weights(size, std)
    numeric = pixels.withColumn(mask, F.col(mask).cast("double"))

    def smoothed(blk: Block) -> Block:
        return {"_s": convolve(convolve(blk[mask], g[:, None]), g[None, :])}

    smooth = apply_neighborhood(numeric, smoothed, [mask], ["_s"], block, size // 2, by, unique, False, carry)
    return smooth.select(*by, *CELL, *carry, (F.col("_s") > thr).alias(mask))


SOBEL_X = ((-1.0, 0.0, 1.0), (-2.0, 0.0, 2.0), (-1.0, 0.0, 1.0))  # fixed values


def sobel(
    pixels: DataFrame, band: str, out: str = "edge", size: int = 256, by: Sequence[str] = ("time",), unique: bool = False
) -> DataFrame:
    """Edge strength: length of the gradient from the two 3 x 3 Sobel kernels."""
    gx = np.asarray(SOBEL_X)

    def fn(blk: Block) -> Block:
        return {out: np.hypot(convolve(blk[band], gx), convolve(blk[band], gx.T))}

    return apply_neighborhood(pixels, fn, [band], [out], size, 1, by, unique, False)


def evaluate_pixels(
    pixels: DataFrame,
    fn: Callable[[pd.DataFrame], Mapping[str, float]],
    bands: Sequence[str],
    out: Sequence[str],
    block: int = 32,
    by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Escape hatch: ``fn(samples of one cell, time-sorted) -> {name: value}``: by, row, col, out.

    With ``by`` (a period, say) the function sees the samples of one cell and period. Cells travel in
    block x block groups, sorted by cell, and a task reads them as a stream: it holds one Arrow batch and the open
    cell. Copies of a sample are folded first (highest value), unless the caller states that samples are
    ``unique``, so a cell is bounded by the acquisitions of the period. Prefer the built-in composites.
    """
    by, bands, out = list(by), list(bands), list(out)
    cells = [F.col(c).cast("int").alias(c) for c in CELL]
    src = pixels.select(*by, "time", *cells, *bands)
    if not unique:
        src = src.groupBy(*by, "time", *CELL).agg(*[F.max(b).alias(b) for b in bands])
    keys = [*by, *CELL]
    keyed = src.withColumns({f"_b{i}": F.floor(F.col(c) / F.lit(block)).cast("int") for i, c in enumerate(CELL)})
    zone = pixels.sparkSession.conf.get("spark.sql.session.timeZone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in sorted_groups(batches, keys):
            samples = groups.table.select(["time", *bands]).to_pandas()
            if isinstance(samples["time"].dtype, pd.DatetimeTZDtype):
                samples["time"] = samples["time"].dt.tz_convert(zone).dt.tz_localize(None)
            ends = np.append(groups.starts[1:], len(samples))
            found = [fn(samples.iloc[i:j].reset_index(drop=True)) for i, j in zip(groups.starts, ends)]
            kept = groups.table.select(keys).take(pa.array(groups.starts))
            for o in out:
                kept = kept.append_column(pa.field(o, pa.float64()), pa.array([r.get(o) for r in found], pa.float64(), from_pandas=True))
            yield from kept.combine_chunks().to_batches()

    schema = T.StructType([src.schema[c] for c in keys] + [T.StructField(o, T.DoubleType()) for o in out])
    return keyed.repartition(*by, "_b0", "_b1").sortWithinPartitions(*keys, "time").mapInArrow(run, schema)
