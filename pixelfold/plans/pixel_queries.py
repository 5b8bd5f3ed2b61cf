"""Pixel-wise indices, masks, filters and grid arithmetic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import indices as I
from ..functions import values as V
from ..operators import change, raster, tables
from ..operators.grid import Grid
from ..operators.pyramid import Pyramid
from ..sources.sensors import apply_band_aliases
from . import bindings as B
from .registry import day, day_sql, query, rounded, rounded_sql
from .sizing import shared_folder

CELL = ["row", "col"]
CELL_SQL = f"{day_sql()}, row, col"


def _index(name: str, column, expr: str, digits: int | None = None):
    """A registered query that computes one value per pixel."""
    value = rounded_sql(expr, digits) if digits is not None else expr

    @query(name, B.sql("px") + f"SELECT {CELL_SQL}, {value} AS value FROM px")
    def run(spark, d):
        shown = rounded(column(), digits) if digits is not None else column()
        return B.pixels(spark, d).select(day(), *CELL, shown.alias("value"))


_index("ndvi", lambda: I.ndvi("nir", "red"), "(nir - red) / nullif(nir + red, 0)")
_index("ndvi_eps", lambda: I.ndvi("nir", "red", 1e-10), "(nir - red) / (nir + red + 1e-10)")
_index(
    "evi",
    lambda: I.evi("nir", "red", "blue"),
    "2.5::DOUBLE * (nir - red) / nullif(nir + 6.0::DOUBLE * red - 7.5::DOUBLE * blue + 1.0::DOUBLE, 0)",
)
_index(
    "evi_free_constants_eps",
    lambda: I.evi("nir", "red", "blue", G=2.0, C1=5.0, C2=7.0, L=2.0, eps=1e-10),
    "2.0::DOUBLE * (nir - red) / nullif(nir + 5.0::DOUBLE * red - 7.0::DOUBLE * blue + 2.0::DOUBLE + 1e-10, 0)",
)
_index("savi", lambda: I.savi("nir", "red"), "1.5::DOUBLE * (nir - red) / nullif(nir + red + 0.5::DOUBLE, 0)")
_index(
    "msavi",
    lambda: I.msavi("nir", "red"),
    "(2*nir + 1 - sqrt(power(2*nir + 1, 2) - 8*(nir - red))) / 2",
    6,
)
_index("nbr", lambda: I.nbr("nir", "blue"), "(nir - blue) / nullif(nir + blue, 0)")
_index("radar_vegetation_index", lambda: I.rvi("nir", "red"), "4.0::DOUBLE * red / nullif(nir + red, 0)")
_index("dual_pol_vegetation_index", lambda: I.dprvi_vv("red", "blue"), "4.0::DOUBLE * blue / nullif(red + blue, 0)")
_index("normalised_difference", lambda: I.norm_diff("red", "blue"), "(red - blue) / nullif(red + blue, 0)")
_index(
    "land_surface_temperature",
    lambda: I.lst_celsius("nir"),
    "nir * 0.00341802::DOUBLE + 149.0::DOUBLE - 273.15::DOUBLE",
)
_index("decibel", lambda: I.to_db("nir"), "CASE WHEN nir > 0 THEN 10 * log10(nir) END", 6)
_index(
    "scaled_int16",
    lambda: I.scale_int16(F.col("red") / 8).cast("double"),
    "CASE WHEN red IS NOT NULL THEN least(greatest(red * 1250, -32767), 32767) END",
)
_index("unscaled", lambda: I.unscale("red", 10000), "red / 10000.0::DOUBLE")
_index("reflectance", lambda: I.reflectance("nir", "blue"), "nir * blue")
_index("vegetated_flag", lambda: I.threshold_class(I.ndvi("nir", "red"), 0.7).cast("int"),
       "CAST((nir - red) / nullif(nir + red, 0) > 0.7 AS INT)")
_index("gain_clipped", lambda: I.gain_clip("nir", 0.03125), "least(greatest(nir * 0.03125::DOUBLE, 0.0), 1.0::DOUBLE)")
_index("keep_clear_classes", lambda: V.keep_classes("red", "scl", (4, 5)), "CASE WHEN scl IN (4, 5) THEN red END")
_index(
    "drop_bad_classes",
    lambda: V.drop_classes("red", "scl", (0, 1, 3, 7, 8, 9, 10)),
    "CASE WHEN scl NOT IN (0, 1, 3, 7, 8, 9, 10) THEN red END",
)
_index("cloud_mask", lambda: F.col("scl").isin(3, 8, 9, 10).cast("int"), "CAST(scl IN (3, 8, 9, 10) AS INT)")
_index("positive_only", lambda: V.positive_only("blue"), "CASE WHEN blue > 0 THEN blue END")
_index("cell_of_coordinate", lambda: V.cell_of(F.col("nir") * 0.25, 1.5, 0.75).cast("bigint"),
       "CAST(floor((nir * 0.25::DOUBLE - 1.5::DOUBLE) / 0.75::DOUBLE) AS BIGINT)")
_index("cell_centre", lambda: V.cell_centre("col", 100.0, 10.0), "100.0::DOUBLE + (col + 0.5::DOUBLE) * 10.0::DOUBLE")


@query(
    "mask_bands_by_class",
    B.sql("px")
    + f"SELECT {CELL_SQL}, CASE WHEN scl IN (4,5) THEN blue END AS blue, CASE WHEN scl IN (4,5) THEN red END AS red FROM px",
)
def _(spark, d):
    px = tables.mask_classes(B.pixels(spark, d), "scl", ["blue", "red"], keep=(4, 5))
    return px.select(day(), *CELL, "blue", "red")


@query(
    "mask_nodata_value",
    B.sql("px") + f"SELECT {CELL_SQL}, CASE WHEN red <> 50 THEN red END AS red FROM px",
)
def _(spark, d):
    return tables.nodata_to_null(B.pixels(spark, d), ["red"], 50.0).select(day(), *CELL, "red")


@query(
    "range_mask",
    B.sql("px") + f"SELECT {CELL_SQL}, CASE WHEN nir >= 17 AND nir <= 60 THEN nir END AS nir FROM px",
)
def _(spark, d):
    return change.mask_range(B.pixels(spark, d), "nir", 17, 60).select(day(), *CELL, "nir")


@query("band_subset", B.sql("px") + f"SELECT {CELL_SQL}, red, nir FROM px")
def _(spark, d):
    return B.pixels(spark, d).select(day(), *CELL, "red", "nir")


@query(
    "clip_box_buffered",
    B.sql("px") + f"SELECT {CELL_SQL}, red FROM px WHERE col + 0.5 BETWEEN 2.5 AND 9.5 AND row + 0.5 BETWEEN 3.5 AND 12.5",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumns(
        {"x": B.PX_GRID.x_of(F.col("col")), "y": B.PX_GRID.y_of(F.col("row"))}
    )
    return tables.clip_box(px, (3.0, 4.0, 9.0, 12.0), 0.5).select(day(), *CELL, "red")


@query(
    "time_slice",
    B.sql("px") + f"SELECT {CELL_SQL}, red FROM px WHERE time BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1998-08-31'",
)
def _(spark, d):
    px = tables.time_slice(B.pixels(spark, d), datetime(1996, 3, 1), datetime(1998, 8, 31))
    return px.select(day(), *CELL, "red")


@query(
    "last_days",
    B.sql("px")
    + f"SELECT {CELL_SQL}, red FROM px WHERE time >= TIMESTAMP '2001-01-01' AND time < TIMESTAMP '2001-04-02'",
)
def _(spark, d):
    return tables.last_days(B.pixels(spark, d), 90, datetime(2001, 4, 1)).select(day(), *CELL, "red")


@query(
    "season_months",
    B.sql("px") + f"SELECT {CELL_SQL}, red FROM px WHERE month(time) IN (3, 6, 9, 12)",
)
def _(spark, d):
    return tables.season_filter(B.pixels(spark, d), months=(3, 6, 9, 12)).select(day(), *CELL, "red")


@query(
    "season_span",
    B.sql("px")
    + f"SELECT {CELL_SQL}, red FROM px WHERE strftime(time, '%m-%d') >= '06-01' AND strftime(time, '%m-%d') < '09-01'",
)
def _(spark, d):
    return tables.season_filter(B.pixels(spark, d), span=("06-01", "09-01")).select(day(), *CELL, "red")


@query(
    "month_labels",
    B.sql("px")
    + f"SELECT {CELL_SQL}, {day_sql('month_end', 'last_day(time)')}, year(time) AS y, month(time) AS m FROM px",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("month_end", V.month_end("time"))
    return px.select(day(), *CELL, day("month_end"), F.year("time").cast("bigint").alias("y"), F.month("time").cast("bigint").alias("m"))


@query(
    "band_aliases",
    B.sql("px") + f"SELECT {CELL_SQL}, blue, red, nir, scl AS mask FROM px",
)
def _(spark, d):
    provider = B.pixels(spark, d).withColumnsRenamed({"blue": "B02", "red": "B04", "nir": "B08", "scl": "SCL"})
    return apply_band_aliases(provider, "sentinel-2-l2a").select(day(), *CELL, "blue", "red", "nir", "mask")


@query("decimated_overview", B.sql("px") + f"SELECT {day_sql()}, row // 4 AS row, col // 4 AS col, red FROM px WHERE row % 4 = 0 AND col % 4 = 0")
def _(spark, d):
    return raster.decimate(B.pixels(spark, d), 4).select(day(), *CELL, "red")


def _pyramid(spark, d):
    return Pyramid(B.pixels(spark, d), shared_folder(spark, "pyramid"), 2, ("red", "nir")).write()


@query("pyramid_decimated", B.sql("px") + f"SELECT {day_sql()}, row // 4 AS row, col // 4 AS col, red, nir FROM px WHERE row % 4 = 0 AND col % 4 = 0")
def _(spark, d):
    return _pyramid(spark, d).decimated(4).select(day(), *CELL, "red", "nir")


# Blocks of six cells: the first level, three to one.
@query(
    "pyramid_mean",
    B.sql("px") + f"SELECT {day_sql()}, row // 6 AS row, col // 6 AS col, {rounded_sql('avg(red)', 6)} AS red, {rounded_sql('avg(nir)', 6)} AS nir FROM px GROUP BY ALL",
)
def _(spark, d):
    return _pyramid(spark, d).mean(6).select(day(), *CELL, *[rounded(b, 6).alias(b) for b in ("red", "nir")])


@query(
    "coarse_grid_mean",
    B.sql("px") + f"SELECT {day_sql()}, row // 4 AS row, col // 4 AS col, avg(red) AS red, avg(nir) AS nir FROM px GROUP BY 1, 2, 3",
)
def _(spark, d):
    return raster.resample_grid(B.pixels(spark, d), 4, ["red", "nir"]).select(day(), *CELL, "red", "nir")


@query(
    "coarse_grid_nearest",
    B.sql("px") + f"SELECT {day_sql()}, row // 4 AS row, col // 4 AS col, red FROM px WHERE row % 4 = 1 AND col % 4 = 1",
)
def _(spark, d):
    return raster.resample_grid(B.pixels(spark, d), 4, ["red"], "nearest").select(day(), *CELL, "red")


@query(
    "resample_to_other_grid",
    B.sql("px", t="SELECT range AS i, CAST(floor((range + 0.5) * 0.75) AS INT) AS s FROM range(21)")
    + f"SELECT {day_sql()}, CAST(a.i AS INT) AS row, CAST(b.i AS INT) AS col, red FROM px JOIN t a ON a.s = px.row JOIN t b ON b.s = px.col",
)
def _(spark, d):
    target = Grid(0.0, 0.0, 0.75, 0.75, 21, 21)
    return raster.resample_nearest(B.pixels(spark, d), B.PX_GRID, target).select(day(), *CELL, "red")


@query(
    "nearest_pixel_of_points",
    B.sql(
        "px",
        pt="SELECT event_id, (event_id % 80) * 0.25::DOUBLE - 1.125 AS x, (user_id % 80) * 0.25::DOUBLE - 1.125 AS y FROM events",
        top="SELECT row, col, max(nir) AS nir FROM px GROUP BY 1, 2",
    )
    + "SELECT event_id, top.row, top.col, nir FROM pt JOIN top ON top.row = least(greatest(floor(y), 0), 15)"
    " AND top.col = least(greatest(floor(x), 0), 15)",
)
def _(spark, d):
    points = B.table(spark, d, "events").select(
        "event_id",
        ((F.col("event_id") % 80) * F.lit(0.25) - 1.125).alias("x"),
        ((F.col("user_id") % 80) * F.lit(0.25) - 1.125).alias("y"),
    )
    top = B.pixels(spark, d).groupBy(*CELL).agg(F.max("nir").alias("nir"))
    return raster.sample_nearest(top, points, B.PX_GRID, "event_id").select("event_id", *CELL, "nir")


@query(
    "equal_interval_classes",
    B.sql("px", b="SELECT min(nir) AS lo, max(nir) AS hi FROM px")
    + f"SELECT {CELL_SQL}, CAST(greatest(least(ceil((nir - lo) * 5.0::DOUBLE / (hi - lo)) - 1, 4), 0) AS BIGINT) AS zone FROM px, b",
)
def _(spark, d):
    return change.equal_interval(B.pixels(spark, d), "nir", 5).select(day(), *CELL, F.col("zone").cast("bigint"))


def _stretch_sql(band: str) -> str:
    return f"floor(255 / (1 + exp(30.0 * (0.075 - ({band} - lo_{band}) / (hi_{band} - lo_{band})))))"


@query(
    "true_color_stretch",
    B.sql(
        "px",
        b="SELECT min(red) AS lo_red, max(red) AS hi_red, min(nir) AS lo_nir, max(nir) AS hi_nir, min(blue) AS lo_blue, max(blue) AS hi_blue FROM px",
    )
    + f"SELECT {CELL_SQL}, CAST({_stretch_sql('red')} AS BIGINT) AS r, CAST({_stretch_sql('nir')} AS BIGINT) AS g,"
    f" CAST({_stretch_sql('blue')} AS BIGINT) AS b, CAST(CASE WHEN red > 0 THEN 255 ELSE 0 END AS BIGINT) AS a FROM px, b",
)
def _(spark, d):
    img = change.true_color(B.pixels(spark, d), "red", "nir", "blue")
    return img.select(day(), *CELL, *[F.col(c).cast("bigint").alias(c) for c in "rgba"])
