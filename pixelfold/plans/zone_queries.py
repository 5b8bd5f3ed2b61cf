"""Zonal statistics over pixels, zones and time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import geometry as G, indices as I
from ..functions.crs import reproject
from ..operators import change, composite, grid, series, tables, zonal
from ..operators.user_aggregates import UserAggregate
from . import bindings as B
from .registry import day, day_sql, query, rounded, rounded_sql

KEY = "zone_key"
INSIDE = "col + 0.5 >= minx AND col + 0.5 < maxx AND row + 0.5 >= miny AND row + 0.5 < maxy"
MEDIAN = "SELECT last_day(time) AS time, row, col, median(red) AS red, median(nir) AS nir FROM px GROUP BY 1, 2, 3"
NDVI_SQL = "(nir - red) / nullif(nir + red, 0)"
# Zone cells with the share of the cell inside the rectangle.
COVER = (
    "SELECT zone_key, level, r AS row, c AS col,"
    " (least(c + 1, maxx) - greatest(c, minx)) * (least(r + 1, maxy) - greatest(r, miny)) AS coverage"
    " FROM (SELECT zn.*, unnest(range(CAST(greatest(floor(miny), 0) AS BIGINT), CAST(least(ceil(maxy), 16) AS BIGINT))) AS r FROM zn)"
    " CROSS JOIN (SELECT range AS c FROM range(16)) WHERE c < maxx AND c + 1 > minx"
)


def flagship(spark, d):
    """Monthly median, NDVI of the medians, zonal mean per zone and month."""
    monthly = composite.monthly_median(B.pixels(spark, d), ["red", "nir"]).withColumnRenamed("month", "time")
    ndvi = monthly.select("time", "row", "col", I.ndvi("nir", "red").alias("ndvi"))
    out = zonal.zonal_mean(ndvi, B.zones(spark, d), B.PX_GRID, KEY, ["ndvi"])
    return out.select(KEY, day(), rounded("ndvi_mean", 10).alias("ndvi_mean"))


query(
    "zonal_monthly_ndvi",
    B.sql("px", "zn", m=MEDIAN)
    + f"SELECT zone_key, {day_sql()}, {rounded_sql(f'avg({NDVI_SQL})', 10)} AS ndvi_mean FROM m JOIN zn ON {INSIDE} GROUP BY 1, 2",
)(flagship)


@query(
    "zonal_mean",
    B.sql("px", "zn") + f"SELECT zone_key, {day_sql()}, avg(red) AS red_mean, avg(nir) AS nir_mean FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    out = zonal.zonal_mean(B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY, ["red", "nir", "scl"])
    return out.select(KEY, day(), "red_mean", "nir_mean")


@query(
    "zonal_mean_of_reprojected_layer",
    B.sql("px", "zn") + f"SELECT zone_key, {day_sql()}, avg(red) AS red_mean FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    # The pixel grid as ten-metre cells of UTM zone 32 north, the layer in longitude and latitude.
    utm = grid.Grid(500000.0, 5500000.0, 10.0, 10.0, 16, 16, srid=32632)
    x0, x1 = (F.col(c) * 10 + F.lit(utm.x0) for c in ("minx", "maxx"))
    y0, y1 = (F.col(c) * 10 + F.lit(utm.y0) for c in ("miny", "maxy"))
    lonlat = B.zones(spark, d).withColumn("geom", reproject(G.rect(x0, y0, x1, y1), utm.srid, 4326)).withColumn("srid", F.lit(4326))
    return zonal.zonal_mean(B.pixels(spark, d), lonlat, utm, KEY, ["red"]).select(KEY, day(), "red_mean")


@query(
    "zonal_mean_with_empty_zones_of_masked_pixels",
    B.sql("px", "zn")
    + f"SELECT zone_key, {day_sql()}, avg(CASE WHEN scl IN (4, 5) THEN red END) AS red_mean FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    px = tables.mask_classes(B.pixels(spark, d), "scl", ["red"], keep=(4, 5))
    return zonal.zonal_mean(px, B.zones(spark, d), B.PX_GRID, KEY, ["red"]).select(KEY, day(), "red_mean")


@query(
    "zonal_mean_of_triangles",
    B.sql("px", "zn")
    + f"SELECT zone_key, {day_sql()}, avg(red) AS red_mean FROM px JOIN zn ON col + 0.5 >= minx AND row + 0.5 >= miny"
    " AND (col + 0.5 - minx) + (row + 0.5 - miny) < 3.5 GROUP BY 1, 2",
)
def _(spark, d):
    out = zonal.zonal_mean(B.pixels(spark, d), B.triangles(spark, d), B.PX_GRID, KEY, ["red"])
    return out.select(KEY, day(), "red_mean")


@query(
    "clipped_pixels",
    B.sql("px", "zn") + f"SELECT zone_key, {day_sql()}, row, col, red FROM px JOIN zn ON {INSIDE}",
)
def _(spark, d):
    px = B.pixels(spark, d)
    return zonal.clip(px, B.zones(spark, d), B.PX_GRID, KEY).select(KEY, day(), "row", "col", "red")


@query(
    "null_zone_keys_skipped",
    B.sql("px", "zn")
    + f"SELECT zone_key, {day_sql()}, avg(red) AS red_mean FROM px JOIN zn ON {INSIDE} WHERE level <> 2 GROUP BY 1, 2",
)
def _(spark, d):
    z = B.zones(spark, d).withColumn(KEY, F.when(F.col("level") != 2, F.col(KEY)))
    return zonal.zonal_mean(B.pixels(spark, d), z, B.PX_GRID, KEY, ["red"]).select(KEY, day(), "red_mean")


@query(
    "null_key_count",
    B.sql("pl") + "SELECT count(CASE WHEN level <> 2 THEN 1 END) AS used, count(CASE WHEN level = 2 THEN 1 END) AS skipped FROM pl",
)
def _(spark, d):
    z = B.plots(spark, d).withColumn("plot_key", F.when(F.col("level") != 2, F.col("plot_key")))
    return tables.null_key_count(z, "plot_key")


_STATS = ["mean", "sum", "count", "std", "min", "max"]


@query(
    "zonal_stats_all_zones",
    B.sql(
        "px",
        "zn",
        m="SELECT time, row, col, CASE WHEN scl IN (4, 5) THEN red END AS v FROM px",
        j=f"SELECT zone_key, time, v FROM m JOIN zn ON {INSIDE}",
        t="SELECT DISTINCT time FROM px",
    )
    + f"SELECT zn.zone_key, {day_sql('time', 't.time')}, avg(v) AS mean, sum(v) AS sum, count(v) AS count,"
    f" {rounded_sql('CASE WHEN count(v) > 1 THEN stddev_pop(v) END')} AS std, min(v) AS min, max(v) AS max"
    " FROM zn CROSS JOIN t LEFT JOIN j ON j.zone_key = zn.zone_key AND j.time = t.time GROUP BY 1, 2",
)
def _(spark, d):
    px = tables.mask_classes(B.pixels(spark, d), "scl", ["red"], keep=(4, 5))
    out = zonal.zonal_stats(px, B.zones(spark, d), B.PX_GRID, KEY, "red", _STATS)
    return out.select(KEY, day(), *[rounded(s).alias(s) if s == "std" else s for s in _STATS])


WINNER = f"SELECT row, col, arg_max(zone_key, zone_order) AS zone_key FROM (SELECT range AS row FROM range(16)) CROSS JOIN (SELECT range AS col FROM range(16)) JOIN zn ON {INSIDE} GROUP BY 1, 2"


@query(
    "zonal_stats_exclusive_zones",
    B.sql("px", "zn", w=WINNER)
    + f"SELECT zone_key, {day_sql()}, avg(red) AS mean, count(red) AS count FROM px JOIN w USING (row, col) GROUP BY 1, 2",
)
def _(spark, d):
    out = zonal.zonal_stats(
        B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "red", ["mean", "count"],
        exclusive_order="zone_order", keep_all_zones=False,
    )
    return out.select(KEY, day(), "mean", "count")


@query(
    "zonal_mean_of_stored_labels",
    B.sql("px", "zn", w=WINNER) + f"SELECT zone_key, {day_sql()}, avg(nir) AS nir_mean FROM px JOIN w USING (row, col) GROUP BY 1, 2",
)
def _(spark, d):
    labels = zonal.rasterize(B.zones(spark, d), B.PX_GRID, KEY, "zone_order")
    return zonal.zonal_mean_of_labels(B.pixels(spark, d), labels, KEY, ["nir"]).select(KEY, day(), "nir_mean")


@query(
    "zonal_sum_per_year",
    B.sql("px", "zn") + f"SELECT zone_key, year(time) AS year, sum(red) AS sum FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("year", F.year("time").cast("bigint"))
    out = zonal.zonal_stats(px, B.zones(spark, d), B.PX_GRID, KEY, "red", ["sum"], keep_all_zones=False, time="year")
    return out.select(KEY, "year", "sum")


@query(
    "zonal_percentiles",
    B.sql("px", "zn")
    + f"SELECT zone_key, year(time) AS year, {rounded_sql('quantile_cont(nir, 0.1)')} AS p10, quantile_cont(nir, 0.5) AS median,"
    f" {rounded_sql('quantile_cont(nir, 0.9)')} AS p90 FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("year", F.year("time").cast("bigint"))
    out = zonal.zonal_percentiles(
        px, B.zones(spark, d), B.PX_GRID, KEY, "nir", {"p10": 0.1, "median": 0.5, "p90": 0.9}, by=["year"]
    )
    return out.select(KEY, "year", rounded("p10").alias("p10"), "median", rounded("p90").alias("p90"))


@query("zonal_percentiles_approximate")
def _(spark, d):
    px = B.pixels(spark, d).withColumn("year", F.year("time").cast("bigint"))
    return zonal.zonal_percentiles(
        px, B.zones(spark, d), B.PX_GRID, KEY, "nir", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, by=["year"], approximate=True
    )


@query(
    "zonal_median_absolute_deviation",
    B.sql("px", "zn", j=f"SELECT zone_key, year(time) AS year, nir FROM px JOIN zn ON {INSIDE}")
    + "SELECT zone_key, year, mad(nir) AS mad FROM j GROUP BY 1, 2",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("year", F.year("time").cast("bigint"))
    return zonal.zonal_mad(px, B.zones(spark, d), B.PX_GRID, KEY, "nir", by=["year"]).select(KEY, "year", "mad")


NDVI_BY_YEAR = f"SELECT zone_key, year(time) AS year, {NDVI_SQL} AS ndvi FROM px JOIN zn ON {INSIDE}"


def _ndvi_by_year(spark, d):
    return B.pixels(spark, d).select("row", "col", F.year("time").cast("bigint").alias("year"), I.ndvi("nir", "red").alias("ndvi"))


@query(
    "zonal_ndvi_percentiles",
    B.sql("px", "zn", j=NDVI_BY_YEAR)
    + "SELECT zone_key, year, min(ndvi) AS p0, " + ", ".join(f"{rounded_sql(f'quantile_cont(ndvi, {p})', 10)} AS {n}" for n, p in
    (("p5", 0.05), ("p25", 0.25), ("median", 0.5), ("p95", 0.95)))
    + " FROM j WHERE ndvi IS NOT NULL GROUP BY 1, 2",
)
def _(spark, d):
    probs = {"p0": 0.0, "p5": 0.05, "p25": 0.25, "median": 0.5, "p95": 0.95}
    out = zonal.zonal_percentiles(_ndvi_by_year(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "ndvi", probs, by=["year"])
    return out.select(KEY, "year", "p0", *[rounded(c, 10).alias(c) for c in ("p5", "p25", "median", "p95")])


@query(
    "zonal_ndvi_median_absolute_deviation",
    B.sql("px", "zn", j=NDVI_BY_YEAR)
    + f"SELECT zone_key, year, {rounded_sql('mad(ndvi)', 10)} AS mad FROM j WHERE ndvi IS NOT NULL GROUP BY 1, 2",
)
def _(spark, d):
    out = zonal.zonal_mad(_ndvi_by_year(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "ndvi", by=["year"])
    return out.select(KEY, "year", rounded("mad", 10).alias("mad"))


@query(
    "zonal_square_sum",
    B.sql("px", "zn")
    + f"SELECT zone_key, {day_sql()}, sum(CASE WHEN scl IN (4, 5) THEN red * red END) AS square_sum FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    px = tables.mask_classes(B.pixels(spark, d), "scl", ["red"], keep=(4, 5))
    out = zonal.zonal_stats(px, B.zones(spark, d), B.PX_GRID, KEY, "red", ["square_sum"], keep_all_zones=False)
    return out.select(KEY, day(), "square_sum")


@query(
    "zonal_weighted_mean_min",
    B.sql("px", "zn", c=COVER)
    + f"SELECT zone_key, level, {day_sql()}, sum(red * coverage) / sum(coverage) AS red_mean, min(red) AS red_min,"
    " sum(nir * coverage) / sum(coverage) AS nir_mean, min(nir) AS nir_min FROM px JOIN c USING (row, col) GROUP BY 1, 2, 3",
)
def _(spark, d):
    out = zonal.zonal_weighted(
        B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY, ["red", "nir"], ["mean", "min"], include_cols=["level"]
    )
    return out.select(KEY, "level", day(), "red_mean", "red_min", "nir_mean", "nir_min")


@query(
    "zonal_weighted_mean_of_masked_pixels",
    B.sql("px", "zn", c=COVER)
    + f"SELECT zone_key, {day_sql()}, sum(CASE WHEN scl IN (4, 5) THEN red * coverage END)"
    " / nullif(sum(CASE WHEN scl IN (4, 5) THEN coverage END), 0) AS red_mean FROM px JOIN c USING (row, col) GROUP BY 1, 2",
)
def _(spark, d):
    px = tables.mask_classes(B.pixels(spark, d), "scl", ["red"], keep=(4, 5))
    return zonal.zonal_weighted(px, B.zones(spark, d), B.PX_GRID, KEY, ["red"]).select(KEY, day(), "red_mean")


TRI_WINDOW = "col < maxx AND col + 1 > minx AND row < maxy AND row + 1 > miny"
TRI_TOUCHED = "greatest(col, minx) - minx + greatest(row, miny) - miny < 3.5"


@query(
    "all_touched_zero_filled_stats",
    B.sql("px", "zn", j=f"SELECT zone_key, time, CASE WHEN {TRI_TOUCHED} THEN red ELSE 0.0 END AS v FROM px JOIN zn ON {TRI_WINDOW}")
    + f"SELECT zone_key, {day_sql()}, min(v) AS min, avg(v) AS mean, median(v) AS median, max(v) AS max FROM j GROUP BY 1, 2",
)
def _(spark, d):
    px = B.pixels(spark, d).select("time", "row", "col", "red")
    j = zonal.clip_all_touched(px, B.triangles(spark, d), B.PX_GRID, KEY, ["red"], outside="zero")
    out = j.groupBy(KEY, "time").agg(
        F.min("red").alias("min"), F.avg("red").alias("mean"), F.median("red").alias("median"), F.max("red").alias("max")
    )
    return out.select(KEY, day(), "min", "mean", "median", "max")


@query(
    "all_touched_pixels",
    B.sql("px", "zn")
    + f"SELECT zone_key, {day_sql()}, row, col, red FROM px JOIN zn ON {TRI_WINDOW} AND {TRI_TOUCHED}",
)
def _(spark, d):
    px = B.pixels(spark, d).select("time", "row", "col", "red")
    return zonal.clip_all_touched(px, B.triangles(spark, d), B.PX_GRID, KEY, ["red"]).select(KEY, day(), "row", "col", "red")


# ---- zones from rasters ---------------------------------------------------------------

ELEV = "SELECT row, col, arg_max(nir, time) AS nir FROM px GROUP BY 1, 2"
BOUNDS = "SELECT min(nir) AS lo, max(nir) AS hi FROM elev"
ZONES5 = "SELECT row, col, CAST(greatest(least(ceil((nir - lo) * 5.0::DOUBLE / (hi - lo)) - 1, 4), 0) AS BIGINT) AS zone FROM elev, b"


def _elevation_zones(spark, d):
    last = composite.reduce_time(B.pixels(spark, d), ["nir"], "last")
    return change.equal_interval(last, "nir", 5).select("row", "col", F.col("zone").cast("bigint").alias("zone"))


@query(
    "zonal_stats_by_label_raster",
    B.sql("px", elev=ELEV, b=BOUNDS, z=ZONES5)
    + f"SELECT zone, avg(red) AS mean, max(red) AS max, min(red) AS min, sum(red) AS sum, {rounded_sql('stddev_pop(red)')} AS std,"
    f" {rounded_sql('var_pop(red)')} AS var, count(red) AS count FROM px JOIN z USING (row, col) GROUP BY 1",
)
def _(spark, d):
    out = zonal.zonal_by_raster(B.pixels(spark, d), _elevation_zones(spark, d), "red", "zone")
    return out.select("zone", "mean", "max", "min", "sum", rounded("std").alias("std"), rounded("var").alias("var"), "count")


def _crosstab(name: str, agg: str, cell: str):
    cols = ", ".join(cell.format(c=c) + f" AS cat_{c}" for c in range(12))

    @query(name, B.sql("px", elev=ELEV, b=BOUNDS, z=ZONES5) + f"SELECT zone, {cols} FROM px JOIN z USING (row, col) GROUP BY 1")
    def run(spark, d):
        out = zonal.crosstab(_elevation_zones(spark, d), B.pixels(spark, d), "zone", "scl", range(12), agg)
        return out.select("zone", *[f"cat_{c}" for c in range(12)])


_crosstab("crosstab_percentage", "percentage", "100.0::DOUBLE * count(CASE WHEN scl = {c} THEN 1 END) / count(*)")
_crosstab("crosstab_count", "count", "count(CASE WHEN scl = {c} THEN 1 END)")


# ---- series out of zones ----------------------------------------------------------------

@query(
    "zonal_indices_long",
    B.sql(
        "px",
        "zn",
        w="SELECT zone_key, time, avg((nir - red) / nullif(nir + red, 0)) AS \"NDVI\","
        " avg(2.5::DOUBLE * (nir - red) / nullif(nir + 6 * red - 7.5::DOUBLE * blue + 1, 0)) AS \"EVI\","
        f" avg(1.5::DOUBLE * (nir - red) / nullif(nir + red + 0.5::DOUBLE, 0)) AS \"SAVI\" FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
        u="SELECT zone_key, time, 'NDVI' AS metric, \"NDVI\" AS value FROM w UNION ALL SELECT zone_key, time, 'EVI', \"EVI\" FROM w"
        " UNION ALL SELECT zone_key, time, 'SAVI', \"SAVI\" FROM w",
    )
    + f"SELECT zone_key AS aoi, {day_sql()}, metric, {rounded_sql('value', 10)} AS value FROM u",
)
def _(spark, d):
    out = zonal.zonal_indices(B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY)
    return out.select("aoi", day(), "metric", rounded("value", 10).alias("value"))


@query(
    "mean_over_zones",
    B.sql("px", "zn", s=f"SELECT zone_key, time, sum(red) AS red FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2")
    + f"SELECT {day_sql()}, avg(red) AS red FROM s GROUP BY 1",
)
def _(spark, d):
    s = zonal.zonal_stats(
        B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "red", ["sum"], keep_all_zones=False
    ).withColumnRenamed("sum", "red")
    return series.mean_over_zones(s, ["red"]).select(day(), "red")


@query("area_trend", B.sql("px") + f"SELECT {day_sql()}, avg(red) AS red, avg(nir) AS nir FROM px GROUP BY 1")
def _(spark, d):
    return series.trend(B.pixels(spark, d), ["red", "nir"]).select(day(), "red", "nir")


@query(
    "result_with_zone_columns",
    B.sql("px", "zn")
    + f"SELECT zone_key, level, {day_sql()}, avg(red) AS red_mean FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2, 3",
)
def _(spark, d):
    z = B.zones(spark, d)
    res = zonal.zonal_mean(B.pixels(spark, d), z, B.PX_GRID, KEY, ["red"])
    return tables.attach_zone_columns(res, z, KEY, ["level"]).select(KEY, "level", day(), "red_mean")


@query(
    "compare_two_algorithms",
    B.sql(
        "px",
        "zn",
        w=WINNER,
        a=f"SELECT zone_key, avg(red) AS v FROM px JOIN zn ON {INSIDE} GROUP BY 1",
        b="SELECT zone_key, avg(red) AS v FROM px JOIN w USING (row, col) GROUP BY 1",
    )
    + "SELECT coalesce(a.zone_key, b.zone_key) AS zone_key, a.v AS left_value, b.v AS right_value, a.v - b.v AS diff FROM a FULL JOIN b ON a.zone_key = b.zone_key",
)
def _(spark, d):
    px, z = B.pixels(spark, d), B.zones(spark, d)
    a = zonal.clip(px, z, B.PX_GRID, KEY).groupBy(KEY).agg(F.avg("red").alias("va"))
    b = (
        px.join(zonal.rasterize(z, B.PX_GRID, KEY, "zone_order"), ["row", "col"])
        .groupBy(KEY)
        .agg(F.avg("red").alias("vb"))
    )
    return tables.compare_results(a, b, KEY, "va", "vb")


@query(
    "run_summary",
    B.sql(
        "px",
        "zn",
        z="SELECT CASE WHEN level <> 2 THEN zone_key END AS zone_key, minx, miny, maxx, maxy FROM zn",
        a=f"SELECT zone_key, time, avg(CASE WHEN scl IN (4, 5) THEN red END) AS v FROM px JOIN z ON {INSIDE} WHERE zone_key IS NOT NULL GROUP BY 1, 2",
        k="SELECT zone_key, count(*) AS n, count(v) AS ok, min(time) AS t0, max(time) AS t1 FROM a GROUP BY 1",
    )
    + "SELECT count(CASE WHEN ok > 0 THEN 1 END) AS processed, count(CASE WHEN ok = 0 THEN 1 END) AS empty,"
    " count(CASE WHEN z.zone_key IS NOT NULL AND n IS NULL THEN 1 END) AS no_data, count(CASE WHEN z.zone_key IS NULL THEN 1 END) AS skipped,"
    " CAST(sum(n) AS BIGINT) AS rows, count(n) AS unique_keys, strftime(min(t0), '%Y-%m-%d') AS first_time, strftime(max(t1), '%Y-%m-%d') AS last_time"
    " FROM z LEFT JOIN k ON z.zone_key = k.zone_key",
)
def _(spark, d):
    z = B.zones(spark, d).withColumn(KEY, F.when(F.col("level") != 2, F.col(KEY)))
    px = tables.mask_classes(B.pixels(spark, d), "scl", ["red"], keep=(4, 5))
    res = zonal.zonal_mean(px, z, B.PX_GRID, KEY, ["red"])
    s = series.run_summary(res, z, KEY, "red_mean")
    return s.select(
        "processed", "empty", "no_data", "skipped", "rows", "unique_keys", day("first_time"), day("last_time")
    )


# ---- user statistics --------------------------------------------------------------------

def _value_range(values, counts):
    return float(values[-1] - values[0])


@query(
    "zonal_user_statistic",
    B.sql("px", "zn") + f"SELECT zone_key, {day_sql()}, max(red) - min(red) AS spread FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    out = zonal.zonal_user_stat(B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "red", _value_range, "spread")
    return out.select(KEY, day(), "spread")


@query(
    "zonal_user_mergeable_statistic",
    B.sql("px", "zn") + f"SELECT zone_key, {day_sql()}, sum(red * red) / sum(red) AS contraharmonic FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    out = zonal.zonal_user_partials(
        B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "red",
        {"s": lambda v: v, "q": lambda v: v * v}, lambda p: F.try_divide(p["q"], p["s"]), "contraharmonic",
    )
    return out.select(KEY, day(), "contraharmonic")


def _moments(values):
    mean = values.mean()
    d = values - mean
    return np.array([len(values), mean, (d**2).sum(), (d**3).sum()])


def _join_moments(a, b):
    """Count, mean, second and third central moment of two parts together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, d = a[0] + b[0], b[1] - a[1]
    third = a[3] + b[3] + d**3 * a[0] * b[0] * (a[0] - b[0]) / n**2 + 3 * d * (a[0] * b[2] - b[0] * a[2]) / n
    return np.array([n, a[1] + d * b[0] / n, a[2] + b[2] + d**2 * a[0] * b[0] / n, third])


SKEWNESS = UserAggregate(
    init=lambda: np.zeros(4),
    update=lambda s, v: _join_moments(s, _moments(v)),
    merge=_join_moments,
    finish=lambda s: float(np.sqrt(s[0]) * s[3] / s[2] ** 1.5) if s[2] > 1e-12 else float("nan"),
)


@query(
    "user_aggregate_skewness",
    B.sql("px", "zn", j=NDVI_BY_YEAR, m="SELECT zone_key, year, avg(ndvi) AS mean FROM j GROUP BY 1, 2")
    + f"SELECT zone_key, year, {rounded_sql('CASE WHEN sum((ndvi - mean) ** 2) > 1e-12 THEN sqrt(count(ndvi)) * sum((ndvi - mean) ** 3) / sum((ndvi - mean) ** 2) ** 1.5 END', 7)}"
    " AS skewness FROM j JOIN m USING (zone_key, year) WHERE ndvi IS NOT NULL GROUP BY 1, 2",
)
def _(spark, d):
    out = zonal.zonal_user_aggregate(_ndvi_by_year(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "ndvi", SKEWNESS, "skewness", by=["year"])
    return out.select(KEY, "year", rounded("skewness", 7).alias("skewness"))


# ---- cells of many polygons ----------------------------------------------------------------

PLOT_CELLS = (
    "SELECT plot_key, plot_order, CAST(r AS INT) AS row, CAST(c AS INT) AS col FROM"
    " (SELECT pl.*, unnest(range(CAST(ceil(miny - 0.5) AS BIGINT), CAST(ceil(maxy - 0.5) AS BIGINT))) AS r FROM pl) AS a,"
    " LATERAL (SELECT unnest(range(CAST(ceil(minx - 0.5) AS BIGINT), CAST(ceil(maxx - 0.5) AS BIGINT))) AS c) AS b"
)


@query("plot_cells_overlapping", B.sql("pl", pc=PLOT_CELLS) + "SELECT plot_key, row, col FROM pc")
def _(spark, d):
    return zonal.rasterize(B.plots(spark, d), B.PLOT_GRID, "plot_key", overlap=True)


@query(
    "plot_cells_last_wins",
    B.sql("pl", pc=PLOT_CELLS) + "SELECT arg_max(plot_key, plot_order) AS plot_key, row, col FROM pc GROUP BY row, col",
)
def _(spark, d):
    return zonal.rasterize(B.plots(spark, d), B.PLOT_GRID, "plot_key", "plot_order").select("plot_key", "row", "col")


@query(
    "plot_cell_coverage",
    B.sql("pl")
    + "SELECT plot_key, CAST(r AS INT) AS row, CAST(c AS INT) AS col,"
    " (least(c + 1, maxx) - greatest(c, minx)) * (least(r + 1, maxy) - greatest(r, miny)) AS coverage FROM"
    " (SELECT pl.*, unnest(range(CAST(floor(miny) AS BIGINT), CAST(ceil(maxy) AS BIGINT))) AS r FROM pl) AS a,"
    " LATERAL (SELECT unnest(range(CAST(floor(minx) AS BIGINT), CAST(ceil(maxx) AS BIGINT))) AS c) AS b",
)
def _(spark, d):
    return grid.coverage_cells(B.plots(spark, d), B.PLOT_GRID, ["plot_key"], spread=True)
