"""Sinks and readers as round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import zonal
from ..sources import cube, files, zones
from . import bindings as B
from .registry import day, day_sql, query, rounded, rounded_sql
from .sizing import shared_folder
from .zone_queries import INSIDE, KEY


@query(
    "csv_per_zone_compiled",
    B.sql("px", "zn")
    + f"SELECT zone_key, {day_sql()}, sum(red) AS red_sum, NULL::DOUBLE AS nir_sum FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2",
)
def _(spark, d):
    """One folder per zone, then all files read back into one frame."""
    out = shared_folder(spark, "csv-per-zone")
    sums = zonal.zonal_stats(B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY, "red", ["sum"], keep_all_zones=False)
    table = sums.withColumn("time", F.col("time").cast("date")).withColumnRenamed("sum", "red_sum")
    files.write_per_key(table, KEY, out, [KEY, "time", "red_sum", "nir_sum"])
    schema = f"{KEY} string, time date, red_sum double, nir_sum double"
    both, _summary = files.compile_csvs(spark, out, KEY, schema, recursive=True)
    return both.select(KEY, day(), "red_sum", "nir_sum")


@query(
    "csv_compile_summary",
    "SELECT count(*) AS rows, count(DISTINCT o_custkey) AS unique_keys, strftime(min(o_orderdate), '%Y-%m-%d') AS first_time,"
    " strftime(max(o_orderdate), '%Y-%m-%d') AS last_time FROM orders",
)
def _(spark, d):
    out = shared_folder(spark, "csv-summary")
    o = B.table(spark, d, "orders").select(
        F.col("o_custkey").alias("zone"), F.col("o_orderdate").cast("date").alias("time"), F.col("o_totalprice").alias("v")
    )
    o.write.option("header", "true").csv(out)
    _all, summary = files.compile_csvs(spark, out, "zone", "zone bigint, time date, v double")
    return summary.select("rows", "unique_keys", day("first_time"), day("last_time"))


@query(
    "files_by_year",
    B.sql("px") + f"SELECT CAST(year(time) AS INT) AS year, {day_sql()}, row, col, red FROM px",
)
def _(spark, d):
    out = shared_folder(spark, "by-year")
    files.write_by_year(B.pixels(spark, d), out)
    return spark.read.parquet(out).select("year", day(), "row", "col", "red")


@query(
    "year_from_file_name",
    B.sql("px") + "SELECT CAST(year(time) AS INT) AS year, count(*) AS n, sum(red) AS red FROM px GROUP BY 1",
)
def _(spark, d):
    out = shared_folder(spark, "yearly")
    named = F.concat(F.lit("T32631_"), F.year("time"), F.lit("_10m"))
    B.pixels(spark, d).select("row", "col", "red", named.alias("S2_L2A")).write.partitionBy("S2_L2A").parquet(out)
    px = cube.read_by_year(spark, out, by_folder=True)
    return px.groupBy("year").agg(F.count("*").alias("n"), F.sum("red").alias("red"))


AOIS = [f"NATION_{i}" for i in range(25)]


@query(
    "wide_csv",
    B.sql("px", "zn", s=f"SELECT time, zone_key, sum(red) AS red, sum(nir) AS nir FROM px JOIN zn ON {INSIDE} GROUP BY 1, 2")
    + f"SELECT {day_sql()}, "
    + ", ".join(f"max(CASE WHEN zone_key = '{a}' THEN {m} END) AS {m}_{a}" for m in ("red", "nir") for a in AOIS)
    + " FROM s GROUP BY time",
)
def _(spark, d):
    out = shared_folder(spark, "wide-csv")
    j = zonal.clip(B.pixels(spark, d), B.zones(spark, d), B.PX_GRID, KEY)
    sums = j.groupBy("time", F.col(KEY).alias("aoi")).agg(F.sum("red").alias("red"), F.sum("nir").alias("nir"))
    long = sums.withColumn("time", day()).unpivot(["time", "aoi"], ["red", "nir"], "metric", "value")
    files.write_wide(long, out, ["red", "nir"], AOIS)
    cols = [f"{m}_{a}" for m in ("red", "nir") for a in AOIS]
    schema = "time string, " + ", ".join(f"{c} double" for c in cols)
    return spark.read.schema(schema).option("header", "true").csv(f"{out}/combined")


@query("zone_layer_from_wkt", B.sql("pl") + "SELECT plot_key, minx, miny, maxx, maxy, 4326 AS srid FROM pl")
def _(spark, d):
    out = shared_folder(spark, "layers")
    B.plots(spark, d).select("plot_key", G.geom_to_wkt("geom").alias("wkt")).write.parquet(f"{out}/plots")
    return zones.with_bbox(zones.read_zones(spark, out, "plots")).drop("geom")


@query("geojson_lines", B.sql("geo") + f"SELECT plot_key, {rounded_sql('minx')} AS x FROM geo")
def _(spark, d):
    out = shared_folder(spark, "lines")
    zones.write_geojson_lines(B.degree_boxes(spark, d), out, drop=("minx", "miny", "maxx", "maxy"))
    line = spark.read.text(out)
    get = lambda p: F.get_json_object("value", p)
    return line.select(
        get("$.properties.plot_key").alias("plot_key"),
        rounded(get("$.geometry.coordinates[0][0][0]").cast("double")).alias("x"),
    )
