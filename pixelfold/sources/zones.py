"""Polygon layers: WKT tables in, GeoJSON lines out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import geometry as G
from ..functions.crs import reproject


def read_zones(
    spark: SparkSession,
    path: str,
    layer: str | None = None,
    wkt: str = "wkt",
    fmt: str = "parquet",
    schema: str | None = None,
    srid: int = 4326,
) -> DataFrame:
    """A layer (sub-folder of ``path``) with its WKT column parsed to oriented rings."""
    where = f"{path.rstrip('/')}/{layer}" if layer else path
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("header", "true").csv(where) if fmt == "csv" else reader.format(fmt).load(where)
    out = df.withColumn("geom", G.wkt_to_geom(wkt)).drop(wkt)
    return out if "srid" in out.columns else out.withColumn("srid", F.lit(srid))


def zones_to_geojson(zones: DataFrame, srid: int, drop: tuple[str, ...] = ()) -> DataFrame:
    """One GeoJSON feature per row as text, coordinates in lon/lat; several parts make a MultiPolygon."""
    props = [c for c in zones.columns if c not in ("geom", *drop)]
    lonlat = reproject("geom", srid, 4326)

    def feature(kind: str, coordinates: Column) -> Column:
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*props).alias("properties")))

    shaped = zones.withColumn("_parts", G.geom_to_part_coordinates(lonlat))
    one = feature("Polygon", F.coalesce(F.get("_parts", F.lit(0)), F.array().cast("array<array<array<double>>>")))
    return shaped.select(F.when(F.size("_parts") > 1, feature("MultiPolygon", F.col("_parts"))).otherwise(one).alias("value"))


def write_geojson_lines(zones: DataFrame, path: str, srid: int = 4326, drop: tuple[str, ...] = ()) -> None:
    zones_to_geojson(zones, srid, drop).write.mode("overwrite").text(path)


def with_bbox(df: DataFrame) -> DataFrame:
    """Box columns from the footprint geometry."""
    b = G.bounds("geom")
    return df.withColumns({k: b[k] for k in ("minx", "miny", "maxx", "maxy")})


def with_footprint(df: DataFrame) -> DataFrame:
    """Footprint geometry from the box columns."""
    return df.withColumn("geom", G.rect("minx", "miny", "maxx", "maxy"))
