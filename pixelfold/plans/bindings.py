"""The given star-schema tables seen as pixels, zones, items, series and weather.

Each binding exists twice: as a DataFrame and as the text of a common table
expression, so that both engines compute on the same rows. Bands are whole
numbers and edges multiples of a quarter: sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geometry as G
from ..operators.grid import Grid

PX_GRID = Grid(0.0, 0.0, 1.0, 1.0, 16, 16)
# Plots lie 40 to a row of the layer, so the layer grows in y with the customer table.
PLOT_GRID = Grid(0.0, 0.0, 1.0, 1.0, 176, 1 << 30)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """px: one row per (time, row, col) on a 16 x 16 grid."""
    li = table(spark, d, "lineitem")
    return li.groupBy(
        F.col("l_shipdate").alias("time"),
        (F.col("l_suppkey") % 16).cast("int").alias("row"),
        (F.col("l_partkey") % 16).cast("int").alias("col"),
    ).agg(
        F.max(F.round(F.col("l_tax") * 100)).alias("blue"),
        F.max("l_quantity").alias("red"),
        F.max(F.floor(F.col("l_extendedprice") / 1000)).cast("double").alias("nir"),
        F.max((F.col("l_orderkey") + F.col("l_linenumber")) % 12).cast("int").alias("scl"),
        F.min("l_orderkey").alias("item_id"),
    )


def _rects(df: DataFrame) -> DataFrame:
    return df.withColumn("geom", G.rect("minx", "miny", "maxx", "maxy"))


def zones(spark: SparkSession, d: str) -> DataFrame:
    """zn: 25 overlapping rectangles on the pixel grid."""
    n = table(spark, d, "nation")
    x = (F.col("n_nationkey") % 5) * 3 + F.lit(0.25)
    y = F.floor(F.col("n_nationkey") / F.lit(5.0)) * 3 + F.lit(0.25)
    return _rects(
        n.select(
            F.col("n_name").alias("zone_key"),
            F.col("n_nationkey").alias("zone_order"),
            F.col("n_regionkey").alias("level"),
            x.alias("minx"),
            (x + 3.5).alias("maxx"),
            y.alias("miny"),
            (y + 3.5).alias("maxy"),
        )
    )


def triangles(spark: SparkSession, d: str) -> DataFrame:
    """tri: the lower-left halves of the zones."""
    x0, y0, x1, y1 = (F.col(c) for c in ("minx", "miny", "maxx", "maxy"))
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return zones(spark, d).withColumn("geom", F.array(F.array(pt(x0, y0), pt(x1, y0), pt(x0, y1), pt(x0, y0))))


def plots(spark: SparkSession, d: str) -> DataFrame:
    """pl: one rectangle per customer, overlapping its neighbours."""
    k = F.col("c_custkey")
    x = (k % 40) * 4 + F.lit(0.25) + (k % 3) * F.lit(0.5)
    y = F.floor(k / F.lit(40.0)) * 4 + F.lit(0.5)
    c = table(spark, d, "customer")
    return _rects(
        c.select(
            F.col("c_name").alias("plot_key"),
            k.alias("plot_order"),
            F.col("c_nationkey").alias("level"),
            F.col("c_mktsegment").alias("segment"),
            x.alias("minx"),
            (x + 4.25).alias("maxx"),
            y.alias("miny"),
            (y + 4.25).alias("maxy"),
        )
    )


def _supplier_boxes(spark: SparkSession, d: str, side: float, key: str) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = ((k % 10) * 16).cast("double"), (F.floor(k / F.lit(10.0)) * 16).cast("double")
    s = table(spark, d, "supplier")
    return _rects(
        s.select(
            F.col("s_name").alias(key), x.alias("minx"), (x + side).alias("maxx"), y.alias("miny"), (y + side).alias("maxy")
        )
    )


def parents(spark: SparkSession, d: str) -> DataFrame:
    """par: gap-free 16 x 16 tiling by the suppliers."""
    return _supplier_boxes(spark, d, 16.0, "parent_key")


def reserves(spark: SparkSession, d: str) -> DataFrame:
    """res: 10 x 10 boxes with gaps, one per supplier."""
    return _supplier_boxes(spark, d, 10.0, "reserve_key")


def horseshoes(spark: SparkSession, d: str) -> DataFrame:
    """shoe: U-shaped parents, the tiles without their upper middle (x 5..9, y 6..16)."""
    x, y = F.col("minx"), F.col("miny")
    outline = ((0, 0), (16, 0), (16, 16), (9, 16), (9, 6), (5, 6), (5, 16), (0, 16), (0, 0))
    ring = F.array(*[F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y")) for a, b in outline])
    return parents(spark, d).withColumn("geom", F.array(ring))


def pairs_of_boxes(spark: SparkSession, d: str) -> DataFrame:
    """twin: reserves of two parts, 5 x 5 boxes at two corners of the tile."""
    x, y = F.col("minx"), F.col("miny")
    return parents(spark, d).withColumn("geom", F.concat(G.rect(x, y, x + 5, y + 5), G.rect(x + 10, y + 10, x + 15, y + 15)))


def degree_boxes(spark: SparkSession, d: str) -> DataFrame:
    """geo: small lon/lat boxes, one per customer."""
    k = F.col("c_custkey")
    lon, lat = (k % 350 - 175).cast("double"), (k % 160 - 80).cast("double")
    return _rects(
        table(spark, d, "customer").select(
            F.col("c_name").alias("plot_key"),
            lon.alias("minx"),
            (lon + 1.5).alias("maxx"),
            lat.alias("miny"),
            (lat + 0.75).alias("maxy"),
        )
    )


def items(spark: SparkSession, d: str) -> DataFrame:
    """it: scene items; the cloud cover includes 0."""
    e = table(spark, d, "events")
    x, y = F.col("user_id") % 13, F.col("event_id") % 13
    return e.select(
        F.col("event_id").alias("item_id"),
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("collection"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("cloud_cover"),
        "value",
        x.cast("double").alias("minx"),
        (x + 3).cast("double").alias("maxx"),
        y.cast("double").alias("miny"),
        (y + 3).cast("double").alias("maxy"),
    )


def series(spark: SparkSession, d: str) -> DataFrame:
    """se: 8 zones x 30 days."""
    return (
        table(spark, d, "events")
        .groupBy((F.col("user_id") % 8).cast("int").alias("zone"), F.col("ts").cast("date").alias("day"))
        .agg((F.round(F.sum(F.col("value") * 100)) / F.count("*")).alias("value"))
    )


def gappy_series(spark: SparkSession, d: str) -> DataFrame:
    """sg: the series with NULLs inside and at the ends."""
    gap = (F.dayofmonth("day") + F.col("zone")) % 3 == 0
    ends = F.dayofmonth("day").isin(1, 2, 30)
    return series(spark, d).withColumn("value", F.when(~(gap | ends), F.col("value")))


def weather(spark: SparkSession, d: str) -> DataFrame:
    """we: text columns of a weather file, one row per order."""
    o = table(spark, d, "orders")
    whole = F.floor(F.col("o_totalprice") / 1000)
    return o.select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("Date"),
        F.lit("n/a").alias("Date2"),
        F.when(F.col("o_orderstatus") == "P", "bad").otherwise(whole.cast("string")).alias("T.Max"),
        whole.cast("string").alias("Rain"),
        F.col("o_custkey").cast("string").alias("Evap"),
    )


CTE = {
    "px": """SELECT l_shipdate AS time, CAST(l_suppkey % 16 AS INT) AS row, CAST(l_partkey % 16 AS INT) AS col,
 max(round(l_tax*100)) AS blue, max(l_quantity) AS red,
 CAST(max(floor(l_extendedprice/1000)) AS DOUBLE) AS nir,
 CAST(max((l_orderkey + l_linenumber) % 12) AS INT) AS scl, min(l_orderkey) AS item_id
 FROM lineitem GROUP BY 1, 2, 3""",
    "zn": """SELECT n_name AS zone_key, n_nationkey AS zone_order, n_regionkey AS level,
 (n_nationkey % 5) * 3 + 0.25::DOUBLE AS minx, (n_nationkey % 5) * 3 + 3.75::DOUBLE AS maxx,
 floor(n_nationkey / 5.0::DOUBLE) * 3 + 0.25::DOUBLE AS miny, floor(n_nationkey / 5.0::DOUBLE) * 3 + 3.75::DOUBLE AS maxy
 FROM nation""",
    "pl": """SELECT c_name AS plot_key, c_custkey AS plot_order, c_nationkey AS level, c_mktsegment AS segment,
 (c_custkey % 40) * 4 + 0.25::DOUBLE + (c_custkey % 3) * 0.5::DOUBLE AS minx,
 (c_custkey % 40) * 4 + 4.5::DOUBLE + (c_custkey % 3) * 0.5::DOUBLE AS maxx,
 floor(c_custkey / 40.0::DOUBLE) * 4 + 0.5::DOUBLE AS miny, floor(c_custkey / 40.0::DOUBLE) * 4 + 4.75::DOUBLE AS maxy
 FROM customer""",
    "par": """SELECT s_name AS parent_key, CAST((s_suppkey % 10) * 16 AS DOUBLE) AS minx,
 CAST((s_suppkey % 10) * 16 + 16 AS DOUBLE) AS maxx, floor(s_suppkey / 10.0::DOUBLE) * 16 AS miny,
 floor(s_suppkey / 10.0::DOUBLE) * 16 + 16 AS maxy FROM supplier""",
    "res": """SELECT s_name AS reserve_key, CAST((s_suppkey % 10) * 16 AS DOUBLE) AS minx,
 CAST((s_suppkey % 10) * 16 + 10 AS DOUBLE) AS maxx, floor(s_suppkey / 10.0::DOUBLE) * 16 AS miny,
 floor(s_suppkey / 10.0::DOUBLE) * 16 + 10 AS maxy FROM supplier""",
    "geo": """SELECT c_name AS plot_key, CAST(c_custkey % 350 - 175 AS DOUBLE) AS minx,
 CAST(c_custkey % 350 - 175 AS DOUBLE) + 1.5 AS maxx, CAST(c_custkey % 160 - 80 AS DOUBLE) AS miny,
 CAST(c_custkey % 160 - 80 AS DOUBLE) + 0.75 AS maxy FROM customer""",
    "it": """SELECT event_id AS item_id, ts AS datetime, event_type AS collection,
 CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS cloud_cover, value,
 CAST(user_id % 13 AS DOUBLE) AS minx, CAST(user_id % 13 + 3 AS DOUBLE) AS maxx,
 CAST(event_id % 13 AS DOUBLE) AS miny, CAST(event_id % 13 + 3 AS DOUBLE) AS maxy FROM events""",
    "se": """SELECT CAST(user_id % 8 AS INT) AS zone, CAST(ts AS DATE) AS day,
 round(sum(value * 100)) / count(*) AS value FROM events GROUP BY 1, 2""",
    "sg": """SELECT zone, day, CASE WHEN (day(day) + zone) % 3 <> 0 AND day(day) NOT IN (1, 2, 30) THEN value END AS value
 FROM se""",
}


def sql(*names: str, **more: str) -> str:
    """WITH clause of the named bindings and further expressions, in order."""
    parts = [f"{n} AS ({CTE[n]})" for n in names] + [f"{n} AS ({q})" for n, q in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"
