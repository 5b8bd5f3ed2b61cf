"""Scene catalogue: item search, listing and metadata flattening."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import geometry as G
from ..functions import values as V

# Item properties that get a column of their own.
STANDARD_KEYS = (
    "eo:cloud_cover", "view:sun_elevation", "view:sun_azimuth", "platform", "instruments", "gsd",
    "eo:gsd", "constellation", "mission", "start_datetime", "end_datetime", "datetime",
)


def _predicates(query: Mapping[str, Mapping[str, object]], column_of) -> Column:
    cond = F.lit(True)
    for prop, tests in query.items():
        c = column_of(prop)
        for op, arg in tests.items():
            if op == "lt":
                cond = cond & (c < F.lit(arg))
            elif op == "lte":
                cond = cond & (c <= F.lit(arg))
            elif op == "gt":
                cond = cond & (c > F.lit(arg))
            elif op == "gte":
                cond = cond & (c >= F.lit(arg))
            elif op == "eq":
                cond = cond & (c == F.lit(arg))
            elif op == "in":
                cond = cond & c.isin([arg] if isinstance(arg, str) else list(arg))
            else:
                raise ValueError(f"unknown predicate {op!r}")
    return cond


def search_items(
    items: DataFrame,
    bbox: Sequence[float] | None = None,
    collections: Sequence[str] | None = None,
    time_range: tuple[object, object] | None = None,
    query: Mapping[str, Mapping[str, object]] | None = None,
    point: tuple[float, float] | None = None,
    polygon: Sequence[tuple[float, float]] | None = None,
) -> DataFrame:
    """Items whose footprint box meets the area, in collection and time range.

    ``bbox`` may be replaced by a ``point`` or a closed ``polygon`` ring; a
    polygon is tested exactly after its box. Plain comparisons reach the scan.
    """
    cond = F.lit(True)
    if point is not None:
        bbox = (point[0], point[1], point[0], point[1])
    if polygon is not None:
        xs, ys = [p[0] for p in polygon], [p[1] for p in polygon]
        bbox = (min(xs), min(ys), max(xs), max(ys))
    if bbox is not None:
        minx, miny, maxx, maxy = (float(v) for v in bbox)
        cond = (F.col("maxx") >= minx) & (F.col("minx") <= maxx) & (F.col("maxy") >= miny) & (F.col("miny") <= maxy)
    if collections is not None:
        cond = cond & F.col("collection").isin(list(collections))
    if time_range is not None:
        cond = cond & F.col("datetime").between(F.lit(time_range[0]), F.lit(time_range[1]))
    if query:
        cond = cond & _predicates(query, lambda p: F.col(V.safe_name(p.split(":")[-1])))
    found = items.where(cond)
    if polygon is not None:
        ring = F.array(
            F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in polygon])
        )
        found = found.where(G.intersects(G.rect("minx", "miny", "maxx", "maxy"), ring))
    return found


def list_collections(items: DataFrame) -> DataFrame:
    return items.groupBy("collection").agg(F.count("*").alias("items"))


def list_assets(items: DataFrame, collections: Sequence[str]) -> DataFrame:
    """collection, asset: asset names of the collection's first item by id."""
    first = (
        items.where(F.col("collection").isin(list(collections)))
        .groupBy("collection")
        .agg(F.min_by(F.map_keys("assets"), "item_id").alias("_k"))
    )
    return first.select("collection", F.explode("_k").alias("asset"))


def first_scene_per_month(items: DataFrame, months: Sequence[int] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Full row of the earliest item per (year, month), ties to the lower id, then
    the wanted months. One mergeable ``min_by`` per group, no sort of the group."""
    src = items.withColumns({"_y": F.year("datetime"), "_m": F.month("datetime")})
    if months is not None:
        src = src.where(F.col("_m").isin(list(months)))
    whole = F.struct(*items.columns)
    best = src.groupBy(*by, "_y", "_m").agg(F.min_by(whole, F.struct("datetime", "item_id")).alias("_w"))
    return best.select("_w.*")


def least_cloud_first(items: DataFrame, n: int = 1, cloud: str = "cloud_cover") -> DataFrame:
    """The n items with the smallest cloud cover; NULLs last, ties by time and id."""
    return items.orderBy(F.col(cloud).asc_nulls_last(), "datetime", "item_id").limit(n)


# ---- JSON items -------------------------------------------------------------------

def discover_property_keys(items_json: DataFrame, json_col: str = "value") -> DataFrame:
    """Distinct property names of a JSON item table, one row each."""
    props = F.from_json(F.get_json_object(json_col, "$.properties"), "map<string,string>")
    return items_json.select(F.explode(F.map_keys(props)).alias("key")).distinct()


def flatten_items(
    items_json: DataFrame,
    extra_keys: Sequence[str] = (),
    json_col: str = "value",
    truthy: bool = False,
    drop_prefixes: Sequence[str] = (),
) -> DataFrame:
    """One row per catalogue item (JSON text) with metadata as columns.

    Fallback columns (datetime, cloud_cover, platform, ...) stay beside the raw
    properties (``raw_*`` for the standard keys, ``prop_*`` for ``extra_keys``);
    values that are not scalars are JSON text. With ``truthy`` a 0 or empty
    value counts as missing in a fallback chain. ``drop_prefixes`` leaves out
    raw properties with such a prefix.
    """
    doc = F.col(json_col)
    head = F.from_json(
        doc,
        "struct<id:string,collection:string,collection_id:string,bbox:array<double>,"
        "geometry:struct<type:string,coordinates:string>,assets:map<string,string>,properties:string>",
    )
    coords = F.col("_h.geometry.coordinates")
    rings = F.when(
        F.col("_h.geometry.type") == "Polygon", F.from_json(coords, "array<array<array<double>>>")
    ).when(
        F.col("_h.geometry.type") == "MultiPolygon",
        F.flatten(F.from_json(coords, "array<array<array<array<double>>>>")),
    )
    # One parse of the document, then of its text members; each stage is read several times below.
    src = items_json.select(head.alias("_h")).select(
        "_h", F.from_json("_h.properties", "map<string,string>").alias("_p"), F.flatten(rings).alias("_xy")
    )
    p = lambda k: F.col("_p")[k]
    pick = (lambda *ks: V.first_truthy(*[p(k) for k in ks])) if truthy else (
        lambda *ks: F.coalesce(*[p(k) for k in ks])
    )
    when = F.try_to_timestamp(pick("datetime", "acquired", "start_datetime", "end_datetime"))
    points = F.col("_xy")
    box = F.when(
        points.isNotNull(),
        F.array(
            F.array_min(F.transform(points, lambda q: q[0])),
            F.array_min(F.transform(points, lambda q: q[1])),
            F.array_max(F.transform(points, lambda q: q[0])),
            F.array_max(F.transform(points, lambda q: q[1])),
        ),
    ).when(F.size("_h.bbox") == 4, F.col("_h.bbox"))
    href = F.transform_values("_h.assets", lambda k, v: F.coalesce(F.get_json_object(v, "$.href"), v))
    keep = [k for k in STANDARD_KEYS if not k.startswith(tuple(drop_prefixes) or ("\0",))]
    more = [k for k in extra_keys if k not in STANDARD_KEYS and not k.startswith(tuple(drop_prefixes) or ("\0",))]
    out = src.select("_h", "_p", box.alias("_box")).select(
        F.col("_h.id").alias("item_id"),
        F.coalesce("_h.collection", "_h.collection_id").alias("collection"),
        when.alias("datetime"),
        when.alias("acquired"),
        pick("eo:cloud_cover", "cloud_cover").try_cast("double").alias("cloud_cover"),
        pick("view:sun_elevation", "sun_elevation").try_cast("double").alias("sun_elevation"),
        pick("view:sun_azimuth", "sun_azimuth").try_cast("double").alias("sun_azimuth"),
        pick("platform", "constellation", "mission").alias("platform"),
        F.from_json(p("instruments"), "array<string>").alias("instruments"),
        pick("gsd", "eo:gsd").try_cast("double").alias("gsd"),
        p("constellation").alias("constellation"),
        p("mission").alias("mission"),
        href.alias("assets"),
        F.to_json(href).alias("assets_json"),
        F.col("_h.properties").alias("properties"),
        *[F.col("_box")[i].alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))],
        *[p(k).alias("raw_" + V.safe_name(k)) for k in keep],
        *[p(k).alias("prop_" + V.safe_name(k)) for k in more],
    )
    return out


def _discovered(properties: DataFrame) -> list[T.StructField]:
    """Names and types of all properties that occur: one mergeable pass, a header comes to the driver."""
    text = properties.agg(F.schema_of_variant_agg("_p")).first()[0]
    # The text is DDL but for its word for a struct; quoted names are left alone.
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", text)
    found = T.DataType.fromDDL(ddl)
    return sorted(found.fields, key=lambda f: f.name) if isinstance(found, T.StructType) else []


def flatten_found(items_json: DataFrame, json_col: str = "value", drop_prefixes: Sequence[str] = ()) -> DataFrame:
    """item_id and a column ``prop_<name>`` for every property that occurs in any item (JSON text).

    Names and types are found in a first pass. Whole numbers are longs, other numbers doubles (beyond the range of
    a long: decimals), and text and truth values stay what they are; members without one scalar type are JSON text. Names that become equal when made safe
    are numbered in their order. Text that is no JSON, or an item without properties, gives NULLs.
    """
    doc = items_json.select(F.try_parse_json(json_col).alias("_d"))
    src = doc.select(F.try_variant_get("_d", "$.id", "string").alias("item_id"), F.try_variant_get("_d", "$.properties", "variant").alias("_p"))
    scalars = (T.LongType, T.DoubleType, T.StringType, T.BooleanType)
    cols, used = [], {"item_id"}
    for field in _discovered(src):
        if drop_prefixes and field.name.startswith(tuple(drop_prefixes)):
            continue
        kind = field.dataType
        if isinstance(kind, T.DecimalType) and (kind.scale or kind.precision <= 18):
            # Also 69.0, which a variant holds without its zero.
            kind = T.DoubleType()
        if "'" in field.name or '"' in field.name:
            # A path cannot hold both kinds of quotes.
            value = F.from_json(F.to_json("_p"), "map<string,string>")[field.name]
        elif isinstance(kind, (*scalars, T.DecimalType)):
            value = F.try_variant_get("_p", f'$["{field.name}"]', kind.simpleString())
        else:
            member = F.try_variant_get("_p", f'$["{field.name}"]', "variant")
            value = F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(member, "$", "string")).when(~F.is_variant_null(member), F.to_json(member))
        safe = name = "prop_" + V.safe_name(field.name)
        number = 1
        while name.lower() in used:
            number += 1
            name = f"{safe}_{number}"
        used.add(name.lower())
        cols.append(value.alias(name))
    return src.select("item_id", *cols)


def list_layers(spark: SparkSession, path: str) -> DataFrame:
    """layer, files: the sub-folders of ``path`` that hold files, from the file listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    base = path.rstrip("/").rsplit("/", 1)[-1]
    below = F.substring_index(F.col("path"), f"/{base}/", -1)
    return files.where(below.contains("/")).groupBy(F.substring_index(below, "/", 1).alias("layer")).agg(F.count("*").alias("files"))


def layer_info(zones: DataFrame) -> tuple[list[str], DataFrame]:
    """Field names of a layer, and one row per srid with its feature count."""
    return zones.columns, zones.groupBy("srid").agg(F.count("*").alias("rows"))


def extract_links(pages: DataFrame, base: str | None = None, html: str = "html", url: str = "url") -> DataFrame:
    """page_id, pos, link: every anchor's href with the base URL in front, the first
    one of each page dropped."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))
    prefix = F.lit(base) if base is not None else F.col(url)
    return (
        pages.select("page_id", prefix.alias("_u"), F.posexplode(hrefs).alias("pos", "_h"))
        .where(F.col("pos") > 0)
        .select("page_id", "pos", F.concat("_u", "_h").alias("link"))
    )
