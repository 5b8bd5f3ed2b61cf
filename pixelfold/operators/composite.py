"""Time composites of a pixel cube.

Contract of every function: ``pixels`` has at most one row per (time, row, col),
as ``load_cube`` produces, so a cell's group in a period is bounded by the
number of acquisitions in it. ``fuse_pixels`` restores the contract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import indices as I
from .ranges import value_range

CELL = ["row", "col"]
NODATA_INT16 = -32768  # fixed value: nodata of the scaled composite
INVALID_SCENE_CLASSES = (0, 1, 3, 7, 8, 9, 10)  # fixed values: scene classes left out


def fuse_pixels(pixels: DataFrame, bands: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per (time, row, col): first valid value per band in ``order``.

    ``min_by``/``max`` are combined map-side, so a cell with many copies costs no more
    than any other. A single numeric or time column as ``order`` keeps the buffers
    fixed-width and the aggregate hashed; several columns make it sort-based.
    """
    aggs = []
    for b in bands:
        v = F.col(b)
        if order:
            rank = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(o) for o in order], v)
            aggs.append(F.min_by(v, F.when(v.isNotNull(), rank)).alias(b))
        else:
            aggs.append(F.max(v).alias(b))
    return pixels.groupBy("time", *CELL).agg(*aggs)


def monthly_median(pixels: DataFrame, bands: Sequence[str], fill_gaps: bool = False) -> DataFrame:
    """month, row, col, bands: median of the valid values, month-end label.

    With ``fill_gaps`` every cell has a row for each month of the cube's range,
    NULL where it was not observed. The gaps come from a per-cell map of at most
    one entry per month, not from a join with a calendar.
    """
    month = F.last_day("time").alias("month")
    med = pixels.groupBy(month, *CELL).agg(*[F.median(b).alias(b) for b in bands])
    if not fill_gaps:
        return med
    first, last = value_range(pixels, ["time"])["time"]
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))
    per_cell = med.groupBy(*CELL).agg(
        F.map_from_entries(F.collect_list(F.struct("month", F.struct(*bands)))).alias("_m")
    )
    spine = per_cell.select(*CELL, "_m", F.explode(months).alias("_d")).withColumn("month", F.last_day("_d"))
    return spine.select("month", *CELL, F.col("_m")[F.col("month")].alias("_v")).select(
        "month", *CELL, *[F.col(f"_v.{b}").alias(b) for b in bands]
    )


def least_cloudy_times(
    pixels: DataFrame, cloud_band: str | None, bands: Sequence[str], calendar_month: bool = False
) -> DataFrame:
    """time of the clearest scene per month; ties go to the earliest.

    One row per month leaves this function, which bounds its size.
    """
    if cloud_band:
        score = F.sum(cloud_band)
    else:
        score = -sum((F.count(b) for b in bands), F.lit(0))
    scenes = pixels.groupBy("time").agg(score.alias("_score"))
    month = F.month("time") if calendar_month else F.last_day("time")
    best = scenes.groupBy(month.alias("_month")).agg(
        F.min_by("time", F.struct(F.col("_score").isNull(), F.col("_score"), F.col("time"))).alias("time")
    )
    return best.select("time")


def least_cloudy_monthly(
    pixels: DataFrame, cloud_band: str | None, bands: Sequence[str], calendar_month: bool = False
) -> DataFrame:
    """Pixels of the clearest scene of every month. The winners (one row per
    month) are broadcast to a semi-join, so the pixels are not shuffled."""
    best = least_cloudy_times(pixels, cloud_band, bands, calendar_month)
    return pixels.join(F.broadcast(best), "time", "left_semi")


def reduce_time(pixels: DataFrame, bands: Sequence[str], how: str, by: Sequence[str] = ()) -> DataFrame:
    """Per cell over time: min, max, mean, median, first or last valid value."""

    def one(b: str) -> Column:
        v, t = F.col(b), F.when(F.col(b).isNotNull(), F.col("time"))
        table = {
            "min": lambda: F.min(v),
            "max": lambda: F.max(v),
            "mean": lambda: F.avg(v),
            "median": lambda: F.median(v),
            "first": lambda: F.min_by(v, t),
            "last": lambda: F.max_by(v, t),
        }
        if how not in table:
            raise ValueError(f"unknown reducer {how!r}")
        return table[how]()

    return pixels.groupBy(*by, *CELL).agg(*[one(b).alias(b) for b in bands])


def mosaic(pixels: DataFrame, bands: Sequence[str], order: str = "most_recent", cloud: str = "cloud_cover") -> DataFrame:
    """First valid value per cell in scene order.

    Time alone orders a cell's samples (one row per time and cell), which keeps
    the aggregate hashed; equal cloud cover is settled by the earlier time.
    """
    if order not in ("most_recent", "least_recent", "least_cloud"):
        raise ValueError(f"unknown mosaic order {order!r}")

    def one(b: str) -> Column:
        v = F.col(b)
        ok = v.isNotNull()
        if order == "least_recent":
            return F.min_by(v, F.when(ok, F.col("time")))
        if order == "most_recent":
            return F.max_by(v, F.when(ok, F.col("time")))
        return F.min_by(v, F.when(ok, F.struct(F.col(cloud), F.col("time"))))

    return pixels.groupBy(*CELL).agg(*[one(b).alias(b) for b in bands])


def quartile_composite(
    pixels: DataFrame,
    bands: Sequence[str],
    class_band: str | None = None,
    invalid: Sequence[int] = INVALID_SCENE_CLASSES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Element floor(n/4) of the sorted valid samples, per band and cell.

    A cell without a valid sample keeps a row with NULL bands. The samples of a
    cell in a period are one list of at most one entry per acquisition.
    """
    ok = ~F.col(class_band).isin(list(invalid)) if class_band else F.lit(True)
    lists = pixels.groupBy(*by, *CELL).agg(
        *[F.sort_array(F.collect_list(F.when(ok, F.col(b)))).alias(b) for b in bands]
    )
    return lists.select(
        *by, *CELL, *[F.get(b, F.floor(F.size(b) / F.lit(4)).cast("int")).alias(b) for b in bands]
    )


def quartile_composite_int16(
    pixels: DataFrame,
    nir: str,
    visible: Sequence[str],
    class_band: str,
    by: Sequence[str] = (),
    k: float = 10000.0,
    nodata: int = NODATA_INT16,
) -> DataFrame:
    """Quartile composite of the visible bands and its NDVI, scaled by k to
    16 bits; ``nodata`` where no valid sample exists. ``visible[0]`` is red."""
    comp = quartile_composite(pixels, [nir, *visible], class_band, by=by)
    scaled = {b: F.coalesce(I.scale_int16(b, k), F.lit(nodata).cast("smallint")) for b in visible}
    ndvi = F.coalesce(I.scale_int16(I.ndvi(nir, visible[0]), k), F.lit(nodata).cast("smallint"))
    return comp.select(*by, *CELL, *[scaled[b].alias(b) for b in visible], ndvi.alias("ndvi"))


def best_timesteps(pixels: DataFrame, mask: Column, n: int = 12) -> DataFrame:
    """The n acquisition times with the smallest masked share, earliest first on ties."""
    share = pixels.groupBy("time").agg(F.avg(mask.cast("double")).alias("cloud_fraction"))
    return share.orderBy("cloud_fraction", "time").limit(n)


def filter_best_timesteps(pixels: DataFrame, mask: Column, n: int = 12) -> DataFrame:
    """Pixels of the n clearest acquisitions; at most n rows are broadcast."""
    best = best_timesteps(pixels, mask, n).select("time")
    return pixels.join(F.broadcast(best), "time", "left_semi")


def best_available_pixel(
    pixels: DataFrame, bands: Sequence[str], mask: str, reducer: str = "first"
) -> DataFrame:
    """First or last value in time that the (already dilated) mask leaves, per cell."""
    masked = pixels.withColumns({b: F.when(~F.col(mask), F.col(b)) for b in bands})
    return reduce_time(masked, bands, reducer)
