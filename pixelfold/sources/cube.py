"""Cube loading: tiles to pixels, band stacks and yearly rasters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import values as V
from ..operators.grid import Grid
from ..plans.sizing import small_side

TILE_DDL = (
    "item_id string, time timestamp_ntz, band string, row0 int, col0 int, "
    "height int, width int, data array<float>"
)


def load_cube(
    tiles: DataFrame,
    items: DataFrame,
    bands: Sequence[str],
    grid: Grid | None = None,
    bbox: Sequence[float] | None = None,
    nodata: float | None = None,
    aligned: bool | None = None,
) -> DataFrame:
    """time, row, col, bands: selected scenes and bands, cropped, one row per cell and time.

    ``tiles`` holds row-major blocks (``TILE_DDL``). Scenes with the same timestamp
    fuse; the first valid value wins, in the order of the items' BIGINT column
    ``item_order`` or, without one, of a hash of the item id (a number keeps the
    per-pixel aggregate hashed, text would make it sort). Where all tiles lie on one lattice, as tiles of
    one product do, whole arrays are stacked and fused in a single exchange and exploded last; a look at the
    tiles' places, without their arrays, decides unless the caller states ``aligned`` (for tiles that are computed
    and not stored the look is dear). Tiles that overlap otherwise are fused pixel by pixel.
    NaN and ``nodata`` become NULL here and never appear later.
    """
    bands = list(bands)
    rank = F.col("item_order").cast("long") if "item_order" in items.columns else F.xxhash64("item_id")
    chosen = small_side(items.groupBy("item_id").agg(F.min(rank).alias("item_order")))
    src = tiles.where(F.col("band").isin(bands))
    window = None
    if bbox is not None:
        if grid is None:
            raise ValueError("bbox needs the grid of the tiles")
        window = _cell_range(grid, bbox)
        r0, r1, c0, c1 = window
        src = src.where(
            (F.col("row0") <= r1)
            & (F.col("row0") + F.col("height") > r0)
            & (F.col("col0") <= c1)
            & (F.col("col0") + F.col("width") > c0)
        )
    if aligned is None:
        aligned = _on_one_lattice(src)
    src = src.join(chosen, "item_id")
    px = _fused_arrays(src, bands, nodata) if aligned else _stacked_arrays(src, bands, nodata)
    if window is not None:
        r0, r1, c0, c1 = window
        px = px.where(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
    if aligned:
        return px
    return px.groupBy("time", "row", "col").agg(
        *[F.min_by(b, F.when(F.col(b).isNotNull(), F.col("item_order"))).alias(b) for b in bands]
    )


def _on_one_lattice(tiles: DataFrame) -> bool:
    """Whether all tiles have one size and whole multiples of it between them; one row of metadata."""
    seen = {
        "h": F.col("height"),
        "w": F.col("width"),
        "r": F.pmod("row0", "height"),
        "c": F.pmod("col0", "width"),
    }
    found = tiles.agg(*[f(v).alias(f"{p}_{n}") for n, v in seen.items() for p, f in (("lo", F.min), ("hi", F.max))]).first()
    return all(found[f"lo_{n}"] == found[f"hi_{n}"] for n in seen)


def _exploded(blocks: DataFrame, bands: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
    """time, row, col, ``more``, bands from blocks with one array per band; a band that is shorter is padded with NULL."""
    zipped = F.arrays_zip(*[F.col(b) for b in bands])
    return blocks.select(*more, "time", "row0", "col0", "width", F.posexplode(zipped).alias("_i", "_v")).select(
        "time",
        (F.col("row0") + F.floor(F.col("_i") / F.col("width"))).cast("int").alias("row"),
        (F.col("col0") + F.col("_i") % F.col("width")).cast("int").alias("col"),
        *more,
        *[F.col(f"_v.{b}").alias(b) for b in bands],
    )


def _fused_arrays(src: DataFrame, bands: Sequence[str], nodata: float | None) -> DataFrame:
    """Pixels of tiles on one lattice: a group is the scenes of one timestamp at one tile, equal copies folded map-side."""
    none = F.array().cast("array<float>")

    def fused(b: str) -> Column:
        scenes = F.sort_array(F.collect_set(F.when((F.col("band") == b) & F.col("item_order").isNotNull(), F.struct("item_order", "data"))))
        # The first scene as it is, gaps filled from the next ones; a lone scene costs nothing per element.
        rest = F.slice(scenes, 2, F.greatest(F.size(scenes) - 1, F.lit(0)))
        fill = lambda v, x: F.when(_clean(v, nodata).isNotNull(), v).otherwise(x)
        return F.coalesce(F.aggregate(rest, F.get(scenes, F.lit(0))["data"], lambda done, s: F.zip_with(done, s["data"], fill)), none)

    blocks = src.groupBy("time", "row0", "col0", "width").agg(*[fused(b).alias(b) for b in bands])
    px = _exploded(blocks, bands)
    return px.select("time", "row", "col", *[_clean(F.col(b).cast("double"), nodata).alias(b) for b in bands])


def _stacked_arrays(src: DataFrame, bands: Sequence[str], nodata: float | None) -> DataFrame:
    """Pixels of each scene with its ``item_order``, bands side by side."""
    blocks = src.groupBy("item_id", "item_order", "time", "row0", "col0", "width").agg(
        *[F.coalesce(F.max(F.when(F.col("band") == b, F.col("data"))), F.array().cast("array<float>")).alias(b) for b in bands]
    )
    px = _exploded(blocks, bands, ["item_order"])
    return px.select("time", "row", "col", "item_order", *[_clean(F.col(b).cast("double"), nodata).alias(b) for b in bands])


def _clean(v: Column, nodata: float | None) -> Column:
    v = V.nan_to_null(v)
    return v if nodata is None else F.when(v != F.lit(float(nodata)), v)


def _cell_range(grid: Grid, bbox: Sequence[float]) -> tuple[int, int, int, int]:
    minx, miny, maxx, maxy = bbox
    rows = sorted(((miny - grid.y0) / grid.dy, (maxy - grid.y0) / grid.dy))
    cols = ((minx - grid.x0) / grid.dx, (maxx - grid.x0) / grid.dx)
    up = lambda v: -int(-v // 1)
    return (
        max(int(rows[0] // 1), 0),
        min(up(rows[1]) - 1, grid.height - 1),
        max(int(cols[0] // 1), 0),
        min(up(cols[1]) - 1, grid.width - 1),
    )


def pixels_to_tiles(pixels: DataFrame, bands: Sequence[str], item: Column, size: int = 64) -> DataFrame:
    """Pixels back to tile rows, row-major with NaN for absent cells.

    A tile is bounded by size x size cells: copies of a cell are folded first.
    """
    cells = pixels.select(
        item.cast("string").alias("item_id"), "time", "row", "col", *[F.col(b).cast("float").alias(b) for b in bands]
    ).unpivot(["item_id", "time", "row", "col"], list(bands), "band", "v")
    cells = cells.groupBy("item_id", "time", "band", "row", "col").agg(F.max("v").alias("v"))
    tr, tc = (F.floor(F.col(c) / F.lit(size)).cast("int") * size for c in ("row", "col"))
    keyed = cells.withColumn("row0", tr).withColumn("col0", tc)
    index = (F.col("row") - F.col("row0")) * size + F.col("col") - F.col("col0")
    packed = keyed.groupBy("item_id", "time", "band", "row0", "col0").agg(
        F.sort_array(F.collect_list(F.struct(index.alias("i"), "v"))).alias("_c")
    )
    # Runs of NaN between one cell and the next, so the work is linear in the tile.
    nan = F.lit(float("nan")).cast("float")
    before = F.concat(F.array(F.lit(-1)), F.transform("_c", lambda c: c["i"]))
    runs = F.zip_with(
        F.slice(before, 1, F.size("_c")),
        F.col("_c"),
        lambda last, c: F.concat(F.array_repeat(nan, c["i"] - last - 1), F.array(F.coalesce(c["v"], nan))),
    )
    tail = F.array_repeat(nan, F.lit(size * size - 1) - F.element_at("_c", -1)["i"])
    data = F.concat(F.flatten(runs), tail)
    return packed.select(
        "item_id", "time", "band", "row0", "col0", F.lit(size).alias("height"), F.lit(size).alias("width"), data.alias("data")
    )


def stack_bands(pixels_long: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Rows (time, row, col, band, value) to one column per band in a fixed order.

    Of several values of one band at one cell the highest is taken.
    """
    return pixels_long.groupBy("time", "row", "col").agg(
        *[F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in bands]
    )


def read_by_year(spark: SparkSession, path: str, schema: str | None = None, by_folder: bool = False) -> DataFrame:
    """Parquet files of several years as one cube; the year is the last number
    1900..2099 of four digits that stands alone in the file name or, with
    ``by_folder``, in the name of the folder that holds the file."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("recursiveFileLookup", "true").parquet(path)
    name = F.element_at(F.split("_metadata.file_path", "/"), -2 if by_folder else -1)
    return df.withColumn("year", F.regexp_extract(name, r"^.*(?<!\d)((?:19|20)\d{2})(?!\d)", 1).try_cast("int"))


def cube_size_gb(tiles: DataFrame, bytes_per_value: int = 4) -> DataFrame:
    """Cube size in GB from tile metadata alone; no pixel array is read."""
    n = F.sum(F.col("height").cast("long") * F.col("width").cast("long"))
    return tiles.agg((n * F.lit(bytes_per_value) / F.lit(float(1024**3))).alias("size_gb"))
