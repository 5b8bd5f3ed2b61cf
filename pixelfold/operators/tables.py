"""Relational operators on zone, item and result tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geometry as G
from ..functions import values as V
from ..functions.crs import reproject
from ..plans.sizing import small_side


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows in an explicit order (a top-k report; planned as TakeOrdered)."""
    return df.orderBy(*order).limit(n)


def nth_row(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The n-th row (0-based) in an explicit order."""
    return df.orderBy(*order).offset(n).limit(1)


def total_bounds(zones: DataFrame, by: Sequence[str] = (), srid: int = 4326, to_srid: int = 4326) -> DataFrame:
    """minx, miny, maxx, maxy of all polygons (per ``by``) in ``to_srid``."""
    b = zones.select(*by, G.bounds(reproject("geom", srid, to_srid)).alias("_b"))
    return b.groupBy(*by).agg(
        F.min("_b.minx").alias("minx"),
        F.min("_b.miny").alias("miny"),
        F.max("_b.maxx").alias("maxx"),
        F.max("_b.maxy").alias("maxy"),
    )


def clip_box(df: DataFrame, bounds: Sequence[float], buf: float = 0.0, x: str = "x", y: str = "y") -> DataFrame:
    """Rows with x and y inside the box widened by ``buf``; pushed to the scan."""
    minx, miny, maxx, maxy = bounds
    return df.where(F.col(x).between(minx - buf, maxx + buf) & F.col(y).between(miny - buf, maxy + buf))


def time_slice(df: DataFrame, start, end, time: str = "time") -> DataFrame:
    """Rows from start to end, both included."""
    return df.where(F.col(time).between(F.lit(start), F.lit(end)))


def last_days(df: DataFrame, n: int, now, time: str = "time") -> DataFrame:
    """Rows of the n days up to ``now``."""
    now = F.lit(now).cast("date")
    return df.where((F.col(time) >= F.date_sub(now, n)) & (F.col(time) < F.date_add(now, 1)))


def season_filter(
    df: DataFrame, months: Sequence[int] | None = None, span: tuple[str, str] | None = None, time: str = "time"
) -> DataFrame:
    """Keeps months from a list, or the half-open span ("06-01", "09-01") of every year."""
    if months is not None:
        df = df.where(F.month(time).isin(list(months)))
    if span is not None:
        md = F.date_format(F.col(time), "MM-dd")
        df = df.where((md >= span[0]) & (md < span[1]))
    return df


def mask_classes(
    pixels: DataFrame, class_band: str, bands: Sequence[str], keep: Iterable[int] | None = None, drop: Iterable[int] | None = None
) -> DataFrame:
    """NULLs the bands outside ``keep`` or inside ``drop`` classes; rows stay."""
    if (keep is None) == (drop is None):
        raise ValueError("give either keep or drop")
    fn = V.keep_classes if keep is not None else V.drop_classes
    return pixels.withColumns({b: fn(b, class_band, keep if keep is not None else drop) for b in bands})


def nodata_to_null(pixels: DataFrame, bands: Sequence[str], nodata: float | None = None) -> DataFrame:
    """A given nodata value, or everything at or below zero, becomes NULL."""
    if nodata is None:
        return pixels.withColumns({b: V.positive_only(b) for b in bands})
    return pixels.withColumns({b: F.when(F.col(b) != F.lit(nodata), F.col(b)) for b in bands})


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def null_key_count(df: DataFrame, key: str) -> DataFrame:
    """One row: used and skipped (NULL key) counts."""
    return df.agg(F.count(key).alias("used"), F.count(F.when(F.col(key).isNull(), 1)).alias("skipped"))


def rename_and_drop(df: DataFrame, rename: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(dict(rename))


# ---- joins ------------------------------------------------------------------------

def attach_zone_columns(results: DataFrame, zones: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Results with zone attributes; the zone side is broadcast only when proven small."""
    return results.join(small_side(zones.select(key, *cols)), key)


def compare_results(a: DataFrame, b: DataFrame, key: str, value_a: str, value_b: str) -> DataFrame:
    """Outer join side by side with the difference (NULL where one side is missing)."""
    left = a.select(key, F.col(value_a).alias("left_value"))
    right = b.select(key, F.col(value_b).alias("right_value"))
    return left.join(right, key, "full_outer").withColumn("diff", F.col("left_value") - F.col("right_value"))


def pending_zones(zones: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Zones without any result yet."""
    return zones.join(results.select(key).distinct(), key, "left_anti")


def missing_rows(expected: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected key rows that the results lack."""
    return expected.join(results.select(*keys).distinct(), list(keys), "left_anti")


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_by_year(rasters: Mapping[int, DataFrame], year: str = "year") -> DataFrame:
    """Yearly rasters stacked along a new year column."""
    return stack([df.withColumn(year, F.lit(y)) for y, df in rasters.items()])


def tile_id(zones: DataFrame, n: int, out: str = "tile") -> DataFrame:
    """n x n tile number (row * n + col) of each polygon's centroid over the layer's bounds."""
    b = zones.select(G.bounds("geom").alias("_b"))
    ext = b.agg(
        F.struct(
            F.min("_b.minx").alias("minx"),
            F.min("_b.miny").alias("miny"),
            F.max("_b.maxx").alias("maxx"),
            F.max("_b.maxy").alias("maxy"),
        ).alias("_e")
    ).scalar()
    c = zones.withColumn("_c", G.centroid("geom")).withColumn("_e", ext)

    def index(v: str, lo: str, hi: str) -> Column:
        pos = F.try_divide((F.col(f"_c.{v}") - F.col(f"_e.{lo}")) * F.lit(float(n)), F.col(f"_e.{hi}") - F.col(f"_e.{lo}"))
        return F.greatest(F.least(F.coalesce(F.floor(pos), F.lit(0)), F.lit(n - 1)), F.lit(0)).cast("int")

    return c.withColumn(out, index("y", "miny", "maxy") * n + index("x", "minx", "maxx")).drop("_c", "_e")
