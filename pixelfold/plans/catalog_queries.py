"""Item search, flattening, cube loading and sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import values as V
from ..sources import catalog, cube
from . import bindings as B
from .registry import day, day_sql, query

CELL = ["row", "col"]


@query(
    "search_items",
    B.sql("it")
    + "SELECT item_id, collection, cloud_cover FROM it WHERE maxx >= 2.5 AND minx <= 5 AND maxy >= 3.5 AND miny <= 6"
    " AND collection IN ('click', 'view') AND datetime BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' AND cloud_cover < 20",
)
def _(spark, d):
    out = catalog.search_items(
        B.items(spark, d),
        bbox=(2.5, 3.5, 5, 6),
        collections=["click", "view"],
        time_range=(datetime(2024, 1, 5), datetime(2024, 1, 25)),
        query={"eo:cloud_cover": {"lt": 20}},
    )
    return out.select("item_id", "collection", "cloud_cover")


@query(
    "search_items_in_list",
    B.sql("it") + "SELECT item_id, collection FROM it WHERE collection IN ('error', 'click') AND cloud_cover >= 50",
)
def _(spark, d):
    q = {"collection": {"in": ["error", "click"]}, "cloud_cover": {"gte": 50}}
    return catalog.search_items(B.items(spark, d), query=q).select("item_id", "collection")


@query("search_items_at_point", B.sql("it") + "SELECT item_id FROM it WHERE 6.5 BETWEEN minx AND maxx AND 7.25 BETWEEN miny AND maxy")
def _(spark, d):
    return catalog.search_items(B.items(spark, d), point=(6.5, 7.25)).select("item_id")


@query(
    "search_items_in_polygon",
    # Right triangle (1,1) (9,1) (1,9): a box meets it when its lower-left corner does.
    B.sql("it")
    + "SELECT item_id FROM it WHERE minx <= 9 AND maxx >= 1 AND miny <= 9 AND maxy >= 1 AND greatest(minx, 1) + greatest(miny, 1) <= 10",
)
def _(spark, d):
    ring = [(1, 1), (9, 1), (1, 9), (1, 1)]
    return catalog.search_items(B.items(spark, d), polygon=ring).select("item_id")


@query("list_collections", B.sql("it") + "SELECT collection, count(*) AS items FROM it GROUP BY 1")
def _(spark, d):
    return catalog.list_collections(B.items(spark, d))


@query(
    "list_assets",
    B.sql("it", f="SELECT collection, min(item_id) AS i FROM it WHERE collection IN ('click', 'view') GROUP BY 1")
    + "SELECT collection, unnest(['B' || CAST(i % 3 AS VARCHAR), 'SCL']) AS asset FROM f",
)
def _(spark, d):
    assets = F.create_map(
        F.concat(F.lit("B"), (F.col("item_id") % 3).cast("string")), F.lit("a.tif"), F.lit("SCL"), F.lit("b.tif")
    )
    return catalog.list_assets(B.items(spark, d).withColumn("assets", assets), ["click", "view"])


@query(
    "first_scene_per_month",
    "WITH s AS (SELECT o_orderkey AS item_id, o_orderdate AS datetime, o_orderpriority AS collection,"
    " row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)"
    " SELECT item_id, strftime(datetime, '%Y-%m-%d') AS datetime, collection FROM s WHERE rn = 1 AND month(datetime) IN (3, 6, 9, 12)",
)
def _(spark, d):
    scenes = B.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("item_id"), F.col("o_orderdate").alias("datetime"), F.col("o_orderpriority").alias("collection")
    )
    return catalog.first_scene_per_month(scenes, (3, 6, 9, 12)).withColumn("datetime", day("datetime"))


@query("least_cloud_first", B.sql("it") + "SELECT item_id, cloud_cover FROM it ORDER BY cloud_cover, datetime, item_id LIMIT 1")
def _(spark, d):
    return catalog.least_cloud_first(B.items(spark, d)).select("item_id", "cloud_cover")


@query(
    "cloud_filter_ordered",
    B.sql("it") + "SELECT item_id, cloud_cover FROM it WHERE cloud_cover <= 30 AND collection = 'view'",
)
def _(spark, d):
    q = {"cloud_cover": {"lte": 30}, "collection": {"eq": "view"}}
    return catalog.search_items(B.items(spark, d), query=q).orderBy("cloud_cover", "item_id").select("item_id", "cloud_cover")


# ---- JSON ----------------------------------------------------------------------------

def _items_json(spark, d):
    """Catalogue items as JSON text: every fallback and shape occurs."""
    e = B.items(spark, d)
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy"), corner("minx", "miny"))
    third = F.col("item_id") % 3
    stamp = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    props = F.struct(
        F.when(third == 0, stamp).alias("datetime"),
        F.when(third != 0, stamp).alias("start_datetime"),
        F.when(third != 1, F.col("cloud_cover")).alias("eo:cloud_cover"),
        F.when(third == 1, F.col("cloud_cover")).alias("cloud_cover"),
        F.when(third == 2, F.lit("sat-b")).alias("platform"),
        F.lit("sat-c").alias("constellation"),
        F.array(F.lit("msi"), F.lit("tirs")).alias("instruments"),
        F.lit(10).alias("gsd"),
        F.col("value").alias("proj:value"),
        F.struct(F.col("item_id").alias("a")).alias("nested.part"),
    )
    geometry = F.when(
        third != 2, F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    )
    item = F.struct(
        F.concat(F.lit("S"), F.col("item_id").cast("string")).alias("id"),
        F.when(third == 0, F.col("collection")).alias("collection"),
        F.when(third != 0, F.col("collection")).alias("collection_id"),
        geometry.alias("geometry"),
        F.array("minx", "miny", "maxx", "maxy").alias("bbox"),
        F.struct(F.struct(F.concat(F.lit("s3/"), F.col("item_id").cast("string")).alias("href")).alias("B04")).alias("assets"),
        props.alias("properties"),
    )
    return e.select(F.to_json(item).alias("value"))


def _flatten_sql(cloud: str) -> str:
    return (
        B.sql("it")
        + f"SELECT 'S' || item_id AS item_id, collection, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, {cloud} AS cloud_cover,"
        " CASE WHEN item_id % 3 = 2 THEN 'sat-b' ELSE 'sat-c' END AS platform, 'msi,tirs' AS instruments, 10.0::DOUBLE AS gsd,"
        " 's3/' || item_id AS b04, minx, miny, maxx, maxy,"
        " CASE WHEN item_id % 3 <> 1 THEN cloud_cover END AS raw_cloud,"
        " '{\"a\":' || item_id || '}' AS prop_nested_part, value AS prop_proj_value FROM it"
    )


def _flattened(spark, d, truthy: bool):
    f = catalog.flatten_items(_items_json(spark, d), ["proj:value", "nested.part", "cloud_cover"], truthy=truthy)
    return f.select(
        "item_id", "collection", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), "cloud_cover", "platform",
        F.array_join("instruments", ",").alias("instruments"), "gsd", F.col("assets")["B04"].alias("b04"),
        "minx", "miny", "maxx", "maxy", F.col("raw_eo_cloud_cover").cast("double").alias("raw_cloud"),
        "prop_nested_part", F.col("prop_proj_value").cast("double").alias("prop_proj_value"),
    )


@query("flattened_items", _flatten_sql("cloud_cover"))
def _(spark, d):
    return _flattened(spark, d, False)


# With truthiness an eo:cloud_cover of 0 falls through to the absent cloud_cover.
@query(
    "flattened_items_truthy",
    _flatten_sql("CASE WHEN item_id % 3 <> 1 AND cloud_cover = 0 THEN NULL ELSE cloud_cover END"),
)
def _(spark, d):
    return _flattened(spark, d, True)


STAMP_SQL = "strftime(datetime, '%Y-%m-%dT%H:%M:%SZ')"


@query(
    "flattened_items_found_columns",
    B.sql("it")
    + "SELECT 'S' || item_id AS item_id, CASE WHEN item_id % 3 = 1 THEN cloud_cover END AS prop_cloud_cover, 'sat-c' AS prop_constellation,"
    f" CASE WHEN item_id % 3 = 0 THEN {STAMP_SQL} END AS prop_datetime, CASE WHEN item_id % 3 <> 1 THEN cloud_cover END AS prop_eo_cloud_cover,"
    " 10 AS prop_gsd, '[\"msi\",\"tirs\"]' AS prop_instruments, '{\"a\":' || item_id || '}' AS prop_nested_part,"
    f" CASE WHEN item_id % 3 = 2 THEN 'sat-b' END AS prop_platform, value AS prop_proj_value, CASE WHEN item_id % 3 <> 0 THEN {STAMP_SQL} END AS prop_start_datetime FROM it",
)
def _(spark, d):
    return catalog.flatten_found(_items_json(spark, d))


@query(
    "flattened_items_without_extensions",
    B.sql("it") + "SELECT 'S' || item_id AS item_id, '{\"a\":' || item_id || '}' AS prop_nested_part FROM it",
)
def _(spark, d):
    f = catalog.flatten_items(
        _items_json(spark, d), ["proj:value", "nested.part"], drop_prefixes=["eo:", "view:", "proj:"]
    )
    assert not [c for c in f.columns if c.startswith(("raw_eo", "raw_view", "prop_proj"))]
    return f.select("item_id", "prop_nested_part")


@query(
    "property_keys",
    "SELECT unnest(['datetime', 'start_datetime', 'eo:cloud_cover', 'cloud_cover', 'platform', 'constellation', 'instruments',"
    " 'gsd', 'proj:value', 'nested.part']) AS key",
)
def _(spark, d):
    return catalog.discover_property_keys(_items_json(spark, d))


@query(
    "json_property",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract(props, '$.k') AS BIGINT) AS n FROM events",
)
def _(spark, d):
    m = F.from_json("props", "map<string,string>")
    return B.table(spark, d, "events").select("event_id", m["k"].alias("k"), F.get_json_object("props", "$.k").cast("bigint").alias("n"))


@query(
    "first_truthy_value",
    "SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN user_id % 5 WHEN event_id % 2 <> 0 THEN event_id % 2 ELSE event_id % 7 END AS v FROM events",
)
def _(spark, d):
    v = V.first_truthy(F.col("user_id") % 5, F.col("event_id") % 2, F.col("event_id") % 7)
    return B.table(spark, d, "events").select("event_id", v.alias("v"))


@query("safe_names", "SELECT page_id, regexp_replace(url, '[:./ ]', '_', 'g') AS name FROM pages")
def _(spark, d):
    return B.table(spark, d, "pages").select("page_id", V.safe_name_col("url").alias("name"))


@query("safe_file_keys", "SELECT page_id, regexp_replace(url, '[/\\\\ ]', '_', 'g') AS name FROM pages")
def _(spark, d):
    return B.table(spark, d, "pages").select("page_id", V.safe_file_key("url").alias("name"))


@query(
    "page_links",
    "SELECT page_id, CAST(pos - 1 AS INT) AS pos, url || h[pos] AS link FROM (SELECT page_id, url, h, unnest(range(2, len(h) + 1)) AS pos FROM"
    " (SELECT page_id, url, regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1) AS h FROM pages))",
)
def _(spark, d):
    return catalog.extract_links(B.table(spark, d, "pages"))


# ---- cubes -----------------------------------------------------------------------------

def _tiles(spark, d):
    """Two scenes per day in 8 x 8 tiles: each pixel is in one of them."""
    px = B.pixels(spark, d)
    scene = F.concat_ws(
        "-", F.lit("S"), F.date_format("time", "yyyyMMdd"), F.when(F.col("item_id") % 2 == 0, "a").otherwise("b")
    )
    return cube.pixels_to_tiles(px, ["red", "nir"], scene, size=8)


def _scene_items(spark, d):
    days = B.table(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyyMMdd").alias("day")).distinct()
    return days.select(F.explode(F.array(*[F.concat_ws("-", F.lit("S"), "day", F.lit(s)) for s in "ab"])).alias("item_id"))


@query(
    "loaded_cube",
    B.sql("px")
    + f"SELECT {day_sql()}, row, col, CASE WHEN red <> 50 THEN red END AS red, nir FROM px WHERE row BETWEEN 2 AND 13 AND col BETWEEN 3 AND 14 AND nir <> 50",
)
def _(spark, d):
    c = cube.load_cube(
        _tiles(spark, d), _scene_items(spark, d), ["red", "nir"], B.PX_GRID, (3.25, 2.0, 14.5, 14.0), nodata=50.0, aligned=True
    )
    return c.where(F.col("nir").isNotNull()).select(day(), *CELL, "red", "nir")


@query(
    "loaded_cube_with_empty_cells",
    B.sql(
        "px",
        t="SELECT DISTINCT time, row // 8 AS r, col // 8 AS c FROM px",
        cell="SELECT time, CAST(r * 8 + i AS INT) AS row, CAST(c * 8 + j AS INT) AS col FROM t, range(8) AS a(i), range(8) AS b(j)",
    )
    + f"SELECT {day_sql('time', 'cell.time')}, cell.row, cell.col, red, nir FROM cell LEFT JOIN px USING (time, row, col)",
)
def _(spark, d):
    return cube.load_cube(_tiles(spark, d), _scene_items(spark, d), ["red", "nir"], aligned=True).select(day(), *CELL, "red", "nir")


@query(
    "cube_size",
    B.sql(
        "px",
        t="SELECT DISTINCT time, item_id % 2 AS s, row // 8 AS r, col // 8 AS c FROM px",
    )
    + "SELECT count(*) * 2 * 64 * 4 / 1073741824.0::DOUBLE AS size_gb FROM t",
)
def _(spark, d):
    return cube.cube_size_gb(_tiles(spark, d))


@query("stacked_bands", B.sql("px") + f"SELECT {day_sql()}, row, col, blue, red, nir FROM px")
def _(spark, d):
    long = B.pixels(spark, d).unpivot(["time", "row", "col"], ["red", "nir", "blue"], "band", "value")
    return cube.stack_bands(long, ["blue", "red", "nir"]).select(day(), *CELL, "blue", "red", "nir")
