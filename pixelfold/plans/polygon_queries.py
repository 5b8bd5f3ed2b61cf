"""Polygon layers: overlay, containment, bounds, tiles and coordinate transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.crs import reproject
from ..operators import overlay, raster, tables
from ..sources import catalog, zones as zone_files
from . import bindings as B
from .registry import query, rounded, rounded_sql

MEET = "p.minx <= q.maxx AND q.minx <= p.maxx AND p.miny <= q.maxy AND q.miny <= p.maxy"
AREA = "(least(p.maxx, q.maxx) - greatest(p.minx, q.minx)) * (least(p.maxy, q.maxy) - greatest(p.miny, q.miny))"
OVERLAP = "p.minx < q.maxx AND q.minx < p.maxx AND p.miny < q.maxy AND q.miny < p.maxy"
BOX = ("minx", "miny", "maxx", "maxy")


@query(
    "overlay_intersection",
    B.sql("pl", "par") + f"SELECT plot_key AS plot_key_1, level AS level_1, parent_key AS parent_key_2, {AREA} AS area FROM pl p JOIN par q ON {OVERLAP}",
)
def _(spark, d):
    out = overlay.overlay_intersection(B.plots(spark, d), B.parents(spark, d), ["plot_key", "level"], ["parent_key"])
    return out.drop("geom")


NOTCH = (
    "greatest(0, least(p.maxx, q.minx + 9) - greatest(p.minx, q.minx + 5))"
    " * greatest(0, least(p.maxy, q.miny + 16) - greatest(p.miny, q.miny + 6))"
)


@query(
    "overlay_concave_parents",
    B.sql("pl", "par", o=f"SELECT plot_key AS plot_key_1, parent_key AS parent_key_2, {AREA} - {NOTCH} AS area FROM pl p JOIN par q ON {OVERLAP}")
    + "SELECT * FROM o WHERE area > 0",
)
def _(spark, d):
    return overlay.overlay_intersection(B.plots(spark, d), B.horseshoes(spark, d), ["plot_key"], ["parent_key"]).drop("geom")


@query(
    "overlay_renamed_columns",
    B.sql("pl", "res") + f"SELECT plot_key, reserve_key AS reserve, {AREA} AS area FROM pl p JOIN res q ON {OVERLAP}",
)
def _(spark, d):
    out = overlay.overlay_intersection(B.plots(spark, d), B.reserves(spark, d), ["plot_key", "level"], ["reserve_key"])
    return tables.rename_and_drop(out, {"plot_key_1": "plot_key", "reserve_key_2": "reserve"}, ["level_1", "geom"])


@query(
    "spatial_join_intersects",
    B.sql("pl", "res") + f"SELECT plot_key AS l_plot_key, reserve_key AS r_reserve_key FROM pl p JOIN res q ON {MEET}",
)
def _(spark, d):
    return overlay.sjoin(B.plots(spark, d), B.reserves(spark, d), ["plot_key"], ["reserve_key"])


@query(
    "keep_intersecting",
    B.sql("pl", "res") + f"SELECT plot_key, level FROM pl p WHERE EXISTS (SELECT 1 FROM res q WHERE {MEET})",
)
def _(spark, d):
    return overlay.keep_intersecting(B.plots(spark, d), B.reserves(spark, d), "plot_key").select("plot_key", "level")


@query(
    "drop_intersecting",
    B.sql("pl", "res") + f"SELECT plot_key, level FROM pl p WHERE NOT EXISTS (SELECT 1 FROM res q WHERE {MEET})",
)
def _(spark, d):
    out = overlay.keep_intersecting(B.plots(spark, d), B.reserves(spark, d), "plot_key", anti=True)
    return out.select("plot_key", "level")


WITHIN = "p.minx >= q.minx AND p.maxx <= q.maxx AND p.miny >= q.miny AND p.maxy <= q.maxy"


@query("within_parent", B.sql("pl", "res") + f"SELECT plot_key, reserve_key FROM pl p JOIN res q ON {WITHIN}")
def _(spark, d):
    return overlay.within(B.plots(spark, d), B.reserves(spark, d), "plot_key", "reserve_key")


@query(
    "within_concave_parent",
    B.sql("pl", "par")
    + f"SELECT plot_key, parent_key FROM pl p JOIN par q ON {WITHIN}"
    " WHERE NOT (p.minx < q.minx + 9 AND p.maxx > q.minx + 5 AND p.maxy > q.miny + 6)",
)
def _(spark, d):
    return overlay.within(B.plots(spark, d), B.horseshoes(spark, d), "plot_key", "parent_key")


TWINS = (
    "SELECT parent_key, minx, miny, minx + 5 AS maxx, miny + 5 AS maxy FROM par"
    " UNION ALL SELECT parent_key, minx + 10, miny + 10, minx + 15, miny + 15 FROM par"
)


@query(
    "spatial_join_two_parts",
    B.sql("pl", "par", twin=TWINS) + f"SELECT DISTINCT plot_key AS l_plot_key, parent_key AS r_parent_key FROM pl p JOIN twin q ON {MEET}",
)
def _(spark, d):
    return overlay.sjoin(B.plots(spark, d), B.pairs_of_boxes(spark, d), ["plot_key"], ["parent_key"])


CORNERS = (
    "SELECT plot_key, minx AS x, miny AS y FROM pl UNION ALL SELECT plot_key, maxx, miny FROM pl"
    " UNION ALL SELECT plot_key, maxx, maxy FROM pl UNION ALL SELECT plot_key, minx, maxy FROM pl"
)
IN_TILING = (
    "SELECT plot_key FROM v WHERE EXISTS (SELECT 1 FROM par q WHERE x BETWEEN q.minx AND q.maxx AND y BETWEEN q.miny AND q.maxy)"
    " GROUP BY 1 HAVING count(*) = 4"
)


@query("within_union_of_parents", B.sql("pl", "par", v=CORNERS) + IN_TILING)
def _(spark, d):
    return overlay.within_union(B.plots(spark, d), B.parents(spark, d), "plot_key").select("plot_key")


@query(
    "within_union_with_gaps",
    B.sql("pl", "par", v=CORNERS, t=IN_TILING)
    + "SELECT plot_key FROM pl p JOIN t USING (plot_key) WHERE NOT EXISTS (SELECT 1 FROM par q"
    " WHERE p.minx < q.minx + 9 AND p.maxx > q.minx + 5 AND p.miny < q.miny + 16 AND p.maxy > q.miny + 6)",
)
def _(spark, d):
    return overlay.within_union(B.plots(spark, d), B.horseshoes(spark, d), "plot_key").select("plot_key")


@query("children_per_parent", B.sql("pl", "par") + f"SELECT parent_key, count(*) AS children FROM pl p JOIN par q ON {OVERLAP} GROUP BY 1")
def _(spark, d):
    return overlay.children_per_parent(B.plots(spark, d), B.parents(spark, d), "plot_key", "parent_key")


@query(
    "pending_zones",
    B.sql("pl", "res") + f"SELECT plot_key FROM pl p WHERE NOT EXISTS (SELECT 1 FROM res q WHERE {OVERLAP})",
)
def _(spark, d):
    done = overlay.overlay_intersection(B.plots(spark, d), B.reserves(spark, d), ["plot_key"], ["reserve_key"])
    return tables.pending_zones(B.plots(spark, d), done.select(F.col("plot_key_1").alias("plot_key")), "plot_key").select("plot_key")


@query("attribute_filter", B.sql("pl") + "SELECT plot_key, level FROM pl WHERE level = 10 AND segment = 'BUILDING'")
def _(spark, d):
    return B.plots(spark, d).where("level = 10 AND segment = 'BUILDING'").select("plot_key", "level")


@query("first_zones", B.sql("pl") + "SELECT plot_key, level FROM pl ORDER BY level, plot_key LIMIT 20")
def _(spark, d):
    return tables.top_n(B.plots(spark, d), 20, "level", "plot_key").select("plot_key", "level")


@query("nth_zone", B.sql("pl") + "SELECT plot_key, level FROM pl ORDER BY level, plot_key LIMIT 1 OFFSET 72")
def _(spark, d):
    return tables.nth_row(B.plots(spark, d), 72, "level", "plot_key").select("plot_key", "level")


@query("layer_bounds", B.sql("pl") + "SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM pl")
def _(spark, d):
    return tables.total_bounds(B.plots(spark, d))


@query(
    "layer_bounds_by_level",
    B.sql("pl") + "SELECT level, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM pl GROUP BY 1",
)
def _(spark, d):
    return tables.total_bounds(B.plots(spark, d), ["level"])


@query(
    "polygon_measures",
    B.sql("pl")
    + f"SELECT plot_key, 4.25::DOUBLE * 4.25 AS area, {rounded_sql('(minx + maxx) / 2')} AS cx, {rounded_sql('(miny + maxy) / 2')} AS cy FROM pl",
)
def _(spark, d):
    z = B.plots(spark, d).withColumn("c", G.centroid("geom"))
    return z.select("plot_key", G.area("geom").alias("area"), rounded("c.x").alias("cx"), rounded("c.y").alias("cy"))


@query(
    "centroid_tiles",
    B.sql("pl", e="SELECT min(minx) AS x0, max(maxx) AS x1, min(miny) AS y0, max(maxy) AS y1 FROM pl")
    + "SELECT plot_key, CAST(floor(((miny + maxy) / 2 - y0) * 4 / (y1 - y0)) * 4 + floor(((minx + maxx) / 2 - x0) * 4 / (x1 - x0)) AS INT) AS tile FROM pl, e",
)
def _(spark, d):
    return tables.tile_id(B.plots(spark, d), 4).select("plot_key", "tile")


@query("footprint_round_trip", B.sql("it") + "SELECT item_id, minx, miny, maxx, maxy FROM it")
def _(spark, d):
    foot = zone_files.with_footprint(B.items(spark, d)).drop(*BOX)
    return zone_files.with_bbox(foot).select("item_id", *BOX)


@query("wkt_round_trip", B.sql("pl") + "SELECT plot_key, minx, miny, maxx, maxy, 18.0625::DOUBLE AS area FROM pl")
def _(spark, d):
    text = B.plots(spark, d).select("plot_key", G.geom_to_wkt("geom").alias("wkt"))
    back = text.select("plot_key", G.wkt_to_geom("wkt").alias("geom"))
    return zone_files.with_bbox(back).select("plot_key", *BOX, G.area("geom").alias("area"))


@query(
    "geojson_features",
    B.sql("geo") + "SELECT 'Feature' AS type, 'Polygon' AS shape, plot_key, minx AS x, miny AS y FROM geo",
)
def _(spark, d):
    lines = zone_files.zones_to_geojson(B.degree_boxes(spark, d), 4326, drop=BOX)
    get = lambda p: F.get_json_object("value", p)
    return lines.select(
        get("$.type").alias("type"),
        get("$.geometry.type").alias("shape"),
        get("$.properties.plot_key").alias("plot_key"),
        get("$.geometry.coordinates[0][0][0]").cast("double").alias("x"),
        get("$.geometry.coordinates[0][0][1]").cast("double").alias("y"),
    )


@query(
    "layer_info",
    "SELECT 4326 AS srid, count(*) AS rows FROM customer",
)
def _(spark, d):
    z = B.degree_boxes(spark, d).withColumn("srid", F.lit(4326))
    return catalog.layer_info(z)[1]


@query(
    "web_mercator_bounds",
    B.sql("geo")
    + f"SELECT plot_key, {rounded_sql('radians(minx) * 6378137', 3)} AS minx, {rounded_sql('ln(tan(pi() / 4 + radians(miny) / 2)) * 6378137', 3)} AS miny FROM geo",
)
def _(spark, d):
    z = B.degree_boxes(spark, d).withColumn("geom", reproject("geom", 4326, 3857))
    return zone_files.with_bbox(z).select("plot_key", rounded("minx", 3).alias("minx"), rounded("miny", 3).alias("miny"))


def _round_trip(name: str, srid: int) -> None:
    """There and back through a projection that has no short SQL form."""

    @query(
        name,
        B.sql("geo")
        + f"SELECT plot_key, {rounded_sql('minx / 40', 5)} AS x, {rounded_sql('miny / 8 + 52', 5)} AS y FROM geo",
    )
    def run(spark, d):
        small = B.degree_boxes(spark, d).withColumn(
            "geom", G.map_points("geom", lambda x, y: (x / 40, y / 8 + 52))
        )
        there = small.withColumn("geom", reproject("geom", 4326, srid))
        back = there.withColumn("geom", reproject("geom", srid, 4326))
        p = F.col("geom")[0][0]
        return back.select("plot_key", rounded(p["x"], 5).alias("x"), rounded(p["y"], 5).alias("y"))


_round_trip("utm_round_trip", 32631)
_round_trip("utm_south_round_trip", 32731)
_round_trip("european_equal_area_round_trip", 3035)

TX = "CAST(floor(({v} + 180.0::DOUBLE) / 360.0::DOUBLE * 64) AS BIGINT)"
TY = "CAST(floor((1 - ln(tan(radians({v})) + 1 / cos(radians({v}))) / pi()) / 2 * 64) AS BIGINT)"
COVER = (
    "SELECT plot_key, tx, ty FROM (SELECT plot_key, ty, unnest(range({x0}, {x1} + 1)) AS tx FROM"
    " (SELECT geo.*, unnest(range({y0}, {y1} + 1)) AS ty FROM geo) AS a) AS b"
).format(x0=TX.format(v="minx"), x1=TX.format(v="maxx"), y0=TY.format(v="maxy"), y1=TY.format(v="miny"))


@query("tile_cover", B.sql("geo", t=COVER) + "SELECT plot_key, 6 AS z, tx, ty FROM t")
def _(spark, d):
    return raster.tile_cover(B.degree_boxes(spark, d), 6, ["plot_key"])


@query("features_by_tile", B.sql("geo", t=COVER) + "SELECT 6 AS z, tx, ty, count(*) AS features FROM t GROUP BY 2, 3")
def _(spark, d):
    return raster.features_by_tile(B.degree_boxes(spark, d), 6)
