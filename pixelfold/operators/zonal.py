"""Zonal statistics: polygons x pixels x time as one equi-join and one groupBy."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import indices as I
from ..plans.sizing import BROADCAST_CELLS, sized_cells, small_side
from .grid import Grid, ZoneExtent, coverage_runs, crop_to_extent, join_runs, zone_cells, zone_extent, zone_runs, zones_on_grid
from .quantiles import group_mad, group_quantiles
from .runs import sorted_groups
from .selection import select_mad, select_quantiles
from .user_aggregates import UserAggregate, aggregate_by

SPREAD_CELLS = 100_000
CATEGORICAL_BANDS = ("oa_fmask", "SCL", "scl", "qa_pixel", "Fmask")  # fixed values: mask band names


def data_bands(bands: Sequence[str], include_categorical: bool = False) -> list[str]:
    """Bands that may be averaged; mask bands only on request."""
    return [b for b in bands if include_categorical or b not in CATEGORICAL_BANDS]


# ---- pixels of zones -------------------------------------------------------

def rasterize(
    zones: DataFrame, grid: Grid, key: str, order: str | None = None, overlap: bool = False, spread: bool = True
) -> DataFrame:
    """Cells of each zone. Without ``overlap`` a cell goes to the zone with the
    highest ``order`` (the later one), the larger key at ties; ``max_by`` combines
    map-side. Zones with a NULL key are skipped."""
    return _rasterize(_usable(zones, grid, key), grid, key, order, overlap, spread)


def _usable(zones: DataFrame, grid: Grid, key: str) -> DataFrame:
    """Zones with a key, in the grid's reference system."""
    return zones_on_grid(zones.where(F.col(key).isNotNull()), grid)


def _rasterize(zones: DataFrame, grid: Grid, key: str, order: str | None, overlap: bool, spread: bool) -> DataFrame:
    if overlap:
        return zone_cells(zones, grid, [key], spread)
    order = order or key
    keep = list(dict.fromkeys([key, order]))
    cells = zone_cells(zones, grid, keep, spread)
    return cells.groupBy("row", "col").agg(F.max_by(key, F.struct(order, key)).alias(key))


def _cells_with_pixels(pixels: DataFrame, cells: DataFrame, ext) -> DataFrame:
    """Equi-join of pixels and zone cells on (row, col).

    The cells are broadcast when the bounding windows prove them few; then the
    pixels are never shuffled for the join. Otherwise both sides are shuffled by
    cell, and adaptive execution splits hot partitions.
    """
    return crop_to_extent(pixels, ext).join(sized_cells(cells, ext.max_cells, BROADCAST_CELLS), ["row", "col"])


def _runs_with_pixels(pixels: DataFrame, runs: DataFrame, ext: ZoneExtent, bound: int, keep: Sequence[str]) -> DataFrame:
    """Join of pixels with runs of zone cells on (row, block of columns).

    What is broadcast or shuffled for the zones follows the length of their borders, not their
    area; ``bound`` proves it small or not, as for cells.
    """
    return join_runs(crop_to_extent(pixels, ext), sized_cells(runs, bound, BROADCAST_CELLS), ext.shift, list(keep))


def _large(ext: ZoneExtent) -> bool:
    """Layers worth spreading over tasks before their cells are filled in."""
    return ext.max_cells > SPREAD_CELLS


def clip(pixels: DataFrame, zones: DataFrame, grid: Grid, key: str) -> DataFrame:
    """Pixels with their centre in a polygon, once per polygon; NULL keys skipped."""
    zones = _usable(zones, grid, key)
    ext = zone_extent(zones, grid)
    return _runs_with_pixels(pixels, zone_runs(zones, grid, [key], ext.shift, _large(ext)), ext, ext.max_runs, [key])


def clip_all_touched(
    pixels: DataFrame, zones: DataFrame, grid: Grid, key: str, bands: Sequence[str], outside: str = "drop"
) -> DataFrame:
    """Pixels of every touched cell; with ``outside="zero"`` the rest of the
    polygon's window is kept with value 0 and counts in later statistics."""
    zones = _usable(zones, grid, key)
    ext = zone_extent(zones, grid)
    runs = coverage_runs(zones, grid, [key], ext.shift, outside == "zero", _large(ext))
    joined = _runs_with_pixels(pixels, runs, ext, ext.max_cover_runs, [key, "coverage"])
    touched = F.col("coverage") > 0
    return joined.withColumns(
        {b: F.when(touched, F.coalesce(F.col(b).cast("double"), F.lit(0.0))).otherwise(0.0) for b in bands}
        if outside == "zero"
        else {b: F.col(b) for b in bands}
    )


# ---- statistics -------------------------------------------------------------

def _simple_stat(stat: str, v: Column) -> Column:
    n = F.count(v)
    table = {
        "mean": lambda: F.avg(v),
        "sum": lambda: F.sum(v),
        "count": lambda: n,
        "min": lambda: F.min(v),
        "max": lambda: F.max(v),
        "std": lambda: F.when(n > 1, F.stddev_pop(v)),
        "var": lambda: F.when(n > 1, F.var_pop(v)),
        "square_sum": lambda: F.sum(v * v),
    }
    if stat not in table:
        raise ValueError(f"unknown statistic {stat!r}")
    return table[stat]()


def zonal_mean(
    pixels: DataFrame, zones: DataFrame, grid: Grid, key: str, bands: Sequence[str], include_categorical: bool = False
) -> DataFrame:
    """key, time, <band>_mean: pixel centres inside each polygon, NULLs skipped.

    A zone with cells but no valid value keeps a row with NULL; a zone without
    any pixel has none.
    """
    bands = data_bands(bands, include_categorical)
    joined = clip(pixels.select("time", "row", "col", *bands), zones, grid, key)
    return (
        joined.groupBy(key, "time")
        .agg(*[F.avg(b).alias(f"{b}_mean") for b in bands])
        .select(key, "time", *[f"{b}_mean" for b in bands])
    )


def zonal_mean_of_labels(pixels: DataFrame, labels: DataFrame, key: str, bands: Sequence[str]) -> DataFrame:
    """Zonal mean against a stored label table (row, col, key): rasterise once, reuse."""
    return (
        pixels.select("time", "row", "col", *bands)
        .join(small_side(labels.where(F.col(key).isNotNull()).select("row", "col", key), BROADCAST_CELLS), ["row", "col"])
        .groupBy(key, "time")
        .agg(*[F.avg(b).alias(f"{b}_mean") for b in bands])
    )


def _time_spine(pixels: DataFrame, zones: DataFrame, key: str, time: str) -> DataFrame:
    """Every zone at every acquisition time, from one scalar subquery: eight bytes per time."""
    times = pixels.agg(F.collect_set(time).alias("_t")).scalar()
    return zones.select(key).distinct().select(key, F.explode(times).alias(time))


def zonal_stats(
    pixels: DataFrame,
    zones: DataFrame,
    grid: Grid,
    key: str,
    value: str,
    stats: Sequence[str] = ("mean",),
    exclusive_order: str | None = None,
    keep_all_zones: bool = True,
    time: str = "time",
) -> DataFrame:
    """One row per zone and time with the asked statistics of ``value``.

    Zones without a valid cell are kept with NULLs and count 0: their rows enter
    as NULL values of the same aggregation, so one exchange serves both.
    ``exclusive_order`` gives overlapping cells to the later zone. Zones with a
    NULL key are skipped.
    """
    zones = _usable(zones, grid, key)
    ext = zone_extent(zones, grid)
    pixels = pixels.select(time, "row", "col", value)
    if exclusive_order is None:
        values = _runs_with_pixels(pixels, zone_runs(zones, grid, [key], ext.shift, _large(ext)), ext, ext.max_runs, [key])
    else:
        values = _cells_with_pixels(pixels, _rasterize(zones, grid, key, exclusive_order, False, _large(ext)), ext)
    values = values.select(key, time, value)
    if keep_all_zones:
        empty = F.lit(None).cast(pixels.schema[value].dataType)
        spine = _time_spine(pixels, zones, key, time).select(key, time, empty.alias(value))
        values = values.unionByName(spine)
    return values.groupBy(key, time).agg(*[_simple_stat(s, F.col(value)).alias(s) for s in stats])


def _few_values(pixels: DataFrame, value: str) -> bool:
    """Whether the band's type itself bounds a zone's distinct values."""
    return isinstance(pixels.schema[value].dataType, (T.ByteType, T.ShortType))


def zonal_percentiles(
    pixels: DataFrame,
    zones: DataFrame,
    grid: Grid,
    key: str,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = ("time",),
    approximate: bool = False,
) -> DataFrame:
    """Exact percentiles per zone and ``by``; ``approximate`` uses one mergeable sketch pass.

    A band of at most 16 bits has a short histogram, which is written once; the ranks of any other band are selected in two passes.
    """
    values = clip(pixels.select(*by, "row", "col", value), zones, grid, key)
    keys = [key, *by]
    if approximate:
        return values.groupBy(*keys).agg(
            *[F.percentile_approx(value, F.lit(p), F.lit(10000)).alias(n) for n, p in probs.items()]
        )
    pick = group_quantiles if _few_values(pixels, value) else select_quantiles
    return pick(values, keys, F.col(value), dict(probs))


def zonal_mad(
    pixels: DataFrame, zones: DataFrame, grid: Grid, key: str, value: str, by: Sequence[str] = ("time",)
) -> DataFrame:
    values = clip(pixels.select(*by, "row", "col", value), zones, grid, key)
    pick = group_mad if _few_values(pixels, value) else select_mad
    return pick(values, [key, *by], F.col(value))


def zonal_weighted(
    pixels: DataFrame,
    zones: DataFrame,
    grid: Grid,
    key: str,
    bands: Sequence[str],
    stats: Sequence[str] = ("mean",),
    include_cols: Sequence[str] = (),
    time: str = "time",
) -> DataFrame:
    """Coverage-weighted statistics: sum(v*c) / sum(c of non-null v), and min/max/sum/count."""
    zones = _usable(zones, grid, key)
    keep = list(dict.fromkeys([key, *include_cols]))
    ext = zone_extent(zones, grid)
    runs = coverage_runs(zones, grid, keep, ext.shift, spread=_large(ext))
    joined = _runs_with_pixels(pixels.select(time, "row", "col", *bands), runs, ext, ext.max_cover_runs, [*keep, "coverage"])
    c = F.col("coverage")
    aggs = []
    for b in bands:
        v = F.col(b)
        seen = F.when(v.isNotNull(), c)
        table = {
            "mean": lambda v=v, seen=seen: F.try_divide(F.sum(v * c), F.sum(seen)),
            "sum": lambda v=v: F.sum(v * c),
            "count": lambda seen=seen: F.sum(seen),
            "min": lambda v=v: F.min(v),
            "max": lambda v=v: F.max(v),
        }
        aggs += [table[s]().alias(f"{b}_{s}") for s in stats]
    return joined.groupBy(*keep, time).agg(*aggs)


def zonal_by_raster(
    values: DataFrame,
    labels: DataFrame,
    value: str,
    label: str,
    stats: Sequence[str] = ("mean", "max", "min", "sum", "std", "var", "count"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Statistics of a value raster per label of another raster on the same grid."""
    joined = values.select(*by, "row", "col", value).join(labels.select("row", "col", label), ["row", "col"])
    v = F.col(value)
    special = {"std": F.stddev_pop(v), "var": F.var_pop(v)}
    aggs = [(special[s] if s in special else _simple_stat(s, v)).alias(s) for s in stats]
    return joined.where(F.col(label).isNotNull()).groupBy(label, *by).agg(*aggs)


def crosstab(
    zones: DataFrame, cats: DataFrame, zone: str, cat: str, categories: Sequence[int], agg: str = "percentage"
) -> DataFrame:
    """Zone x category table of cell shares (0..100) or counts; categories given upfront."""
    joined = zones.select("row", "col", zone).join(cats.select("row", "col", cat), ["row", "col"])
    joined = joined.where(F.col(zone).isNotNull() & F.col(cat).isNotNull())
    counts = [F.count(F.when(F.col(cat) == c, 1)).alias(f"cat_{c}") for c in categories]
    table = joined.groupBy(zone).agg(F.count("*").alias("_n"), *counts)
    if agg == "count":
        return table.drop("_n")
    return table.select(
        zone,
        *[F.try_divide(F.lit(100.0) * F.col(f"cat_{c}"), F.col("_n")).alias(f"cat_{c}") for c in categories],
    )


def zonal_indices(
    pixels: DataFrame, zones: DataFrame, grid: Grid, key: str, nir: str = "nir", red: str = "red", blue: str = "blue"
) -> DataFrame:
    """time, aoi, metric, value: NDVI, EVI and SAVI means from one clip for all three."""
    with_indices = pixels.select(
        "time",
        "row",
        "col",
        I.ndvi(nir, red).alias("NDVI"),
        I.evi(nir, red, blue).alias("EVI"),
        I.savi(nir, red).alias("SAVI"),
    )
    metrics = ["NDVI", "EVI", "SAVI"]
    wide = clip(with_indices, zones, grid, key).groupBy(key, "time").agg(*[F.avg(m).alias(m) for m in metrics])
    return wide.unpivot([key, "time"], metrics, "metric", "value").withColumnRenamed(key, "aoi")


# ---- user-defined statistics ---------------------------------------------------

def zonal_user_stat(
    pixels: DataFrame,
    zones: DataFrame,
    grid: Grid,
    key: str,
    value: str,
    fn: Callable[[np.ndarray, np.ndarray], float],
    name: str,
    by: Sequence[str] = ("time",),
) -> DataFrame:
    """User statistic of a zone's values: ``fn(values, counts) -> float``.

    ``fn`` sees the sorted distinct values and how often each occurs, which
    determines every order-independent statistic; bands of any number type are
    taken. A group is as long as its band has distinct values in the zone: a
    statistic that can be merged over parts of a huge zone is better given to
    ``zonal_user_aggregate`` or, as Columns, to ``zonal_user_partials``.
    """
    values = clip(pixels.select(*by, "row", "col", value), zones, grid, key).where(F.col(value).isNotNull())
    keys = [key, *by]
    hist = values.select(*keys, F.col(value).cast("double").alias("_v")).groupBy(*keys, "_v").agg(F.count("*").alias("_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in sorted_groups(batches, keys):
            vs, ns = groups.table["_v"].to_numpy(), groups.table["_n"].to_numpy()
            ends = np.append(groups.starts[1:], len(vs))
            stats = [float(fn(vs[i:j].astype(float), ns[i:j])) for i, j in zip(groups.starts, ends)]
            out = groups.table.select(keys).take(pa.array(groups.starts))
            yield from out.append_column(name, pa.array(stats, pa.float64())).combine_chunks().to_batches()

    schema = T.StructType([hist.schema[k] for k in keys] + [T.StructField(name, T.DoubleType())])
    ordered = hist.repartition(*keys).sortWithinPartitions(*keys, "_v")
    return ordered.mapInArrow(run, schema)


def zonal_user_aggregate(
    pixels: DataFrame,
    zones: DataFrame,
    grid: Grid,
    key: str,
    value: str,
    agg: UserAggregate,
    name: str,
    by: Sequence[str] = ("time",),
) -> DataFrame:
    """User statistic with a mergeable state: no task sees more than its part of a zone's pixels."""
    return aggregate_by(clip(pixels.select(*by, "row", "col", value), zones, grid, key), [key, *by], value, agg, name)


def zonal_user_partials(
    pixels: DataFrame,
    zones: DataFrame,
    grid: Grid,
    key: str,
    value: str,
    partials: Mapping[str, Callable[[Column], Column]],
    finish: Callable[[Mapping[str, Column]], Column],
    name: str,
    by: Sequence[str] = ("time",),
) -> DataFrame:
    """Mergeable user statistic: summed partial Columns, then a finishing Column.

    Example: ``partials={"s": lambda v: v, "q": lambda v: v*v}`` and
    ``finish=lambda p: p["q"] / p["s"]``. Runs as an ordinary hash aggregate.
    """
    values = clip(pixels.select(*by, "row", "col", value), zones, grid, key).where(F.col(value).isNotNull())
    sums = values.groupBy(key, *by).agg(*[F.sum(f(F.col(value))).alias(n) for n, f in partials.items()])
    return sums.select(key, *by, finish({n: F.col(n) for n in partials}).alias(name))
