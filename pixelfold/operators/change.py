"""Change detection, class areas and derived radar products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import indices as I
from .composite import reduce_time
from .ranges import value_range
from .raster import CELL, period_difference


def class_area_km2(pixels: DataFrame, cond: Column, res: tuple[float, float], by: Sequence[str]) -> DataFrame:
    """Area of the cells that meet ``cond``: count x cell size / 1e6."""
    cells = F.sum(F.when(cond, 1).otherwise(0))
    return pixels.groupBy(*by).agg((cells * F.lit(res[0] * res[1]) / F.lit(1e6)).alias("area_km2"))


def class_change(pixels: DataFrame, cond: Column, year: str = "year") -> DataFrame:
    """-1 loss, 0 unchanged, +1 gain against the cell's previous year.

    The window holds one cell's years; ``pixels`` has one row per (year, cell).
    """
    w = W.partitionBy(*CELL).orderBy(year)
    flagged = pixels.select(year, *CELL, F.when(cond, 1).otherwise(0).alias("_f"))
    change = F.col("_f") - F.lag("_f").over(w)
    return flagged.select(year, *CELL, change.alias("change")).where(F.col("change").isNotNull())


def cumulative_loss(pixels: DataFrame, cond: Column, res: tuple[float, float], year: str = "year") -> DataFrame:
    """Running total of the lost area; the last window sees one row per year."""
    loss = class_area_km2(class_change(pixels, cond, year), F.col("change") == -1, res, [year])
    w = W.orderBy(year).rowsBetween(W.unboundedPreceding, 0)
    return loss.select(year, F.sum("area_km2").over(w).alias("cum_loss_km2"))


def fire_flag(pre: DataFrame, post: DataFrame, band: str, threshold: float = 0.5) -> DataFrame:
    """Index drop between two periods and the burnt flag."""
    d = period_difference(pre, post, [band])
    return d.select(*CELL, F.col(band).alias("diff"), (F.col(band) > F.lit(threshold)).alias("burnt"))


def soil_moisture(
    current: DataFrame, reference: DataFrame, vv: str = "vv", lo_db: float = -17.0, hi_db: float = -6.0
) -> DataFrame:
    """(last current - reference min) / (reference max - min) per cell.

    NULL where the mean reference backscatter lies outside lo..hi decibel (built-up
    areas and open water). One pass over the reference serves all three reducers.
    """
    cur = reduce_time(current, [vv], "last").select(*CELL, F.col(vv).alias("_cur"))
    ref = reference.groupBy(*CELL).agg(
        F.min(vv).alias("_min"), F.max(vv).alias("_max"), F.avg(vv).alias("_avg")
    )
    keep = I.to_db("_avg").between(lo_db, hi_db)
    ssm = F.try_divide(F.col("_cur") - F.col("_min"), F.col("_max") - F.col("_min"))
    return cur.join(ref, CELL).select(*CELL, F.when(keep, ssm).alias("ssm"))


def mask_range(pixels: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Values outside lo..hi (ends kept) become NULL."""
    return pixels.withColumn(col, F.when(F.col(col).between(lo, hi), F.col(col)))


def equal_interval(df: DataFrame, col: str, k: int = 5, out: str = "zone") -> DataFrame:
    """Class 0..k-1 of equal width between the global minimum and maximum.

    The two bounds come from one scalar subquery. A value on an inner cut belongs
    to the lower class (right-closed bins).
    """
    lo, hi = value_range(df, [col])[col]
    pos = F.try_divide((F.col(col) - lo) * F.lit(float(k)), hi - lo)
    cls = F.greatest(F.least(F.coalesce(F.ceil(pos).cast("int") - 1, F.lit(0)), F.lit(k - 1)), F.lit(0))
    return df.withColumn(out, F.when(F.col(col).isNotNull(), cls))


def true_color(
    pixels: DataFrame, red: str, green: str, blue: str, c: float = 30.0, th: float = 0.075, nodata: float = 0.0
) -> DataFrame:
    """8-bit sigmoid stretch of three bands with an alpha band (0 for nodata)."""
    ends = value_range(pixels, [red, green, blue])

    def stretch(b: str) -> Column:
        lo, hi = ends[b]
        norm = F.try_divide(F.col(b) - lo, hi - lo)
        v = F.lit(255.0) / (F.lit(1.0) + F.exp(F.lit(c) * (F.lit(th) - norm)))
        return F.floor(F.coalesce(v, F.lit(0.0))).cast("int")

    seen = F.col(red).isNotNull() & (F.col(red) > nodata)
    alpha = F.when(seen, 255).otherwise(0)
    return pixels.select(
        *[x for x in pixels.columns if x not in (red, green, blue)],
        stretch(red).alias("r"),
        stretch(green).alias("g"),
        stretch(blue).alias("b"),
        alpha.alias("a"),
    )
