"""Inputs that the table-bound queries do not hold: parts, gaps, clamps, odd names and headers."""

from __future__ import annotations

import json

import pytest
from pixelfold.functions import geometry as G, indices as I
from pixelfold.operators import raster, series, zonal
from pixelfold.operators.grid import Grid
from pixelfold.sources import cube, files, zones
from pyspark.sql import functions as F

TWO_PARTS = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((10 10, 14 10, 14 14, 10 14, 10 10), (11 11, 11 12, 12 12, 12 11, 11 11)))"


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def geom(text):
    return G.wkt_to_geom(F.lit(text))


def test_every_part_can_meet(spark):
    box = "POLYGON ((12.5 12.5, 13 12.5, 13 13, 12.5 13, 12.5 12.5))"
    around = "POLYGON ((9 9, 15 9, 15 15, 9 15, 9 9))"
    hole = "POLYGON ((11.2 11.2, 11.8 11.2, 11.8 11.8, 11.2 11.8, 11.2 11.2))"
    r = one(
        spark,
        a=G.intersects(geom(TWO_PARTS), geom(box)),
        b=G.intersects(geom(box), geom(TWO_PARTS)),
        c=G.intersects(geom(TWO_PARTS), geom(around)),
        d=G.intersects(geom(TWO_PARTS), geom("POLYGON ((3 3, 4 3, 4 4, 3 4, 3 3))")),
        e=G.intersects(geom(TWO_PARTS), geom(hole)),
    )
    assert tuple(r) == (True, True, True, False, False)


def test_parts_survive_text_and_geojson(spark):
    r = one(spark, w=G.geom_to_wkt(geom(TWO_PARTS)), p=G.geom_to_wkt(geom("POLYGON ((0 0, 1 0, 1 1, 0 0))")))
    assert r["w"].startswith("MULTIPOLYGON (((") and r["p"].startswith("POLYGON ((")
    assert one(spark, a=G.area(geom(r["w"])))["a"] == pytest.approx(16.0)
    layer = spark.createDataFrame([("k", TWO_PARTS), ("s", "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "key string, wkt string").withColumn("geom", G.wkt_to_geom("wkt")).drop("wkt")
    found = {json.loads(x["value"])["properties"]["key"]: json.loads(x["value"])["geometry"] for x in zones.zones_to_geojson(layer, 4326).collect()}
    assert found["k"]["type"] == "MultiPolygon" and [len(p) for p in found["k"]["coordinates"]] == [1, 2]
    assert found["s"]["type"] == "Polygon" and len(found["s"]["coordinates"]) == 1


def test_sixteen_bits_are_clamped(spark):
    r = one(spark, a=I.scale_int16(F.lit(9.9)), b=I.scale_int16(F.lit(-9.9)), c=I.scale_int16(F.lit(None).cast("double")), d=I.scale_int16(F.lit(0.5)))
    assert tuple(r) == (32767, -32767, None, 5000)


def test_null_keys_and_ties_of_zones(spark):
    grid = Grid(0.0, 0.0, 1.0, 1.0, 4, 4)
    px = spark.createDataFrame([("t", r, c, float(r + c)) for r in range(4) for c in range(4)], "time string, row int, col int, v double")
    z = spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "key string, rank int").withColumn("geom", G.rect(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0)))
    assert {r["key"] for r in zonal.zonal_stats(px, z, grid, "key", "v", ["count"]).collect()} == {"a", "b"}
    assert {r["key"] for r in zonal.rasterize(z, grid, "key", "rank").collect()} == {"b"}


def test_csv_columns_by_name(spark, tmp_path):
    for name, text in (("a", "k,time,red,nir\nx,2024-01-01,10,20\n"), ("b", '"nir",k,time,"red"\n40,y,2024-01-02,30\n'), ("c", "k,time\nz,2024-01-03\n"), ("d", "other\n1\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    both, summary = files.compile_csvs(spark, str(tmp_path), "k", "k string, time date, red double, nir double")
    assert [(r["k"], r["red"], r["nir"]) for r in both.collect()] == [("x", 10, 20), ("y", 30, 40), ("z", None, None)]
    s = summary.first()
    assert (s["files"], s["failed"], s["rows"], s["unique_keys"]) == (3, 1, 3, 3)


def test_year_is_a_number_of_its_own(spark, tmp_path):
    for name in ("S2_T32631_2021_x", "2020_v1999a", "T32631"):
        spark.range(1).write.parquet(str(tmp_path / name))
    found = cube.read_by_year(spark, str(tmp_path), by_folder=True)
    assert sorted((r["year"] or 0) for r in found.collect()) == [0, 1999, 2021]


def test_box_over_the_antimeridian(spark):
    box = spark.createDataFrame([(179.0, 1.0, -179.0, 2.0), (1.0, 1.0, 2.0, 2.0)], "minx double, miny double, maxx double, maxy double")
    found = raster.tile_cover(box, 6, ["minx"]).groupBy("minx").agg(F.collect_set("tx").alias("tx")).collect()
    assert {r["minx"]: sorted(r["tx"]) for r in found} == {179.0: [0, 63], 1.0: [32]}


def test_weather_gap_months_and_unreadable_dates(spark):
    w = spark.createDataFrame([("20240115", "1", "5"), ("20240310", "2", "7")], "`Date` string, `Rain` string, `T.Max` string")
    got = [(str(r["month"]), r["Rain"], r["T.Max"]) for r in series.weather_monthly(series.detect_date(w)).orderBy("month").collect()]
    assert got == [("2024-01-31", 1.0, 5.0), ("2024-02-29", 0.0, None), ("2024-03-31", 2.0, 7.0)]
    with pytest.raises(Exception, match="no column holds dates"):
        series.detect_date(spark.createDataFrame([("x", "1")], "`Date` string, `Rain` string")).collect()
