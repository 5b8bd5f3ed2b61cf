from __future__ import annotations

import json
import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

import geo
from pixelfold.functions import geometry as G
from pixelfold.operators.grid import Grid
from pixelfold.sources import catalog, cube, files, sensors, zones


def tile(item, time, band, row0, col0, data):
    h, w = len(data), len(data[0])
    return (item, time, band, row0, col0, h, w, [float(v) for r in data for v in r])


NAN = float("nan")
T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def tiles(spark):
    rows = [
        tile("a", T1, "red", 0, 0, [[1, NAN], [3, 4]]),
        tile("b", T1, "red", 0, 0, [[9, 2], [9, 9]]),
        tile("a", T1, "nir", 0, 0, [[NAN, 7], [7, -1]]),
        tile("a", T1, "red", 0, 2, [[5, 6], [7, 8]]),
        tile("c", T2, "red", 0, 0, [[1, 1], [1, 1]]),
        tile("z", T2, "red", 0, 0, [[0, 0], [0, 0]]),
        tile("a", T1, "swir", 0, 0, [[0, 0], [0, 0]]),
    ]
    return spark.createDataFrame(rows, cube.TILE_DDL)


def test_cube_fuses_equal_times_in_item_order(spark, tiles):
    items = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "item_id string, item_order bigint")
    px = {(r["time"], r["row"], r["col"]): (r["red"], r["nir"]) for r in cube.load_cube(tiles, items, ["red", "nir"], nodata=-1).collect()}
    assert px[(T1, 0, 0)] == (1.0, None)
    assert px[(T1, 0, 1)] == (2.0, 7.0)
    assert px[(T1, 1, 1)] == (4.0, None)
    assert px[(T1, 1, 3)] == (8.0, None)
    assert px[(T2, 0, 0)] == (1.0, None)
    assert len(px) == 12
    turned = items.withColumn("item_order", -F.col("item_order"))
    assert cube.load_cube(tiles, turned, ["red"]).where("row = 0 AND col = 0").where(F.col("time") == T1).first()["red"] == 9.0


def test_cube_of_tiles_off_the_lattice_is_fused_by_pixel(spark, tiles):
    moved = spark.createDataFrame([tile("b", T1, "red", 1, 1, [[70, 71], [72, 73]]), tile("a", T1, "red", 0, 0, [[1, NAN], [3, NAN]])], cube.TILE_DDL)
    items = spark.createDataFrame([("a", 1), ("b", 2)], "item_id string, item_order bigint")
    px = {(r["row"], r["col"]): r["red"] for r in cube.load_cube(moved, items, ["red"]).collect()}
    assert px == {(0, 0): 1.0, (0, 1): None, (1, 0): 3.0, (1, 1): 70.0, (1, 2): 71.0, (2, 1): 72.0, (2, 2): 73.0}
    copies = tiles.union(tiles)
    both = [sorted(cube.load_cube(t, items, ["red", "nir"]).select("row", "col", F.coalesce("red", F.lit(-9.0)), F.coalesce("nir", F.lit(-9.0))).collect()) for t in (tiles, copies)]
    assert both[0] == both[1] and len(both[0]) == 8


def test_cube_on_one_lattice_needs_no_exchange_of_pixels(spark, tiles):
    items = spark.createDataFrame([("a", 1), ("b", 2)], "item_id string, item_order bigint")
    plan = cube.load_cube(tiles, items, ["red", "nir"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("ObjectHashAggregate") and "_b" not in plan.split("Generate")[0]


def test_cube_crops_to_a_box(spark, tiles, rows):
    items = spark.createDataFrame([("a",)], "item_id string")
    grid = Grid(10, 20, 1, -1, 4, 2)
    px = cube.load_cube(tiles, items, ["red"], grid, bbox=(11.5, 18.5, 12.5, 18.9))
    assert rows(px, "row", "col", "red") == [(1, 1, 4.0), (1, 2, 7.0)]


def test_tile_round_trip(spark, rows):
    px = spark.createDataFrame([(T1, r, c, float(r * 10 + c)) for r in range(5) for c in range(7) if (r + c) % 3], "time timestamp_ntz, row int, col int, v double")
    t = cube.pixels_to_tiles(px, ["v"], F.lit("s"), size=4)
    assert {r[0] for r in t.select(F.size("data")).collect()} == {16}
    back = cube.load_cube(t, t.select("item_id"), ["v"]).where("v IS NOT NULL")
    assert rows(back, "row", "col", "v") == rows(px, "row", "col", "v")
    assert cube.cube_size_gb(t).first()[0] == pytest.approx(4 * 16 * 4 / 1024**3)


def test_year_from_file_name(spark, tmp_path):
    for y in (2019, 2021):
        spark.createDataFrame([(0, 0, float(y))], "row int, col int, v double").coalesce(1).write.parquet(str(tmp_path / "w"), mode="overwrite")
        part = next(f for f in os.listdir(tmp_path / "w") if f.endswith(".parquet"))
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{y}.parquet").write_bytes((tmp_path / "w" / part).read_bytes())
    got = {(r["year"], r["v"]) for r in cube.read_by_year(spark, str(tmp_path / "in")).collect()}
    assert got == {(2019, 2019.0), (2021, 2021.0)}


def test_sensor_presets(spark):
    t = sensors.sensors_table(spark)
    assert t.count() == len(sensors.PRESETS)
    assert t.where("name = 'landsat-c2-l2'").select(F.col("bands")["nir"]).first()[0] == "nir08"
    df = spark.createDataFrame([(1, 2, 3)], ["nbart_nir_1", "oa_fmask", "other"])
    assert sensors.apply_band_aliases(df, "ga_s2bm_ard_3").columns == ["nir", "fmask", "other"]
    assert sensors.safe_columns(spark.createDataFrame([(1, 2)], ["eo:cloud cover", "a.b/c"])).columns == ["eo_cloud_cover", "a_b_c"]


ITEM = {
    "id": "i1",
    "collection": "s2",
    "bbox": [1, 2, 3, 4],
    "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 5], [0, 0]]], [[[7, 1], [8, 1], [8, 2], [7, 1]]]]},
    "assets": {"B04": {"href": "s3/b4.tif", "type": "x"}, "thumb": "t.png"},
    "properties": {
        "datetime": None, "acquired": "2024-03-01T10:00:00Z", "eo:cloud_cover": 0, "cloud_cover": 12.5, "mission": "m1",
        "instruments": ["msi"], "proj:shape": [1, 2], "note a": "x", "deep": {"k": 1},
    },
}


def test_item_flattening(spark):
    bare = {"id": "i2", "bbox": [1, 2, 3, 4], "geometry": None, "assets": {}, "properties": {}}
    df = spark.createDataFrame([(json.dumps(ITEM),), (json.dumps(bare),)], "value string")
    keys = sorted(r[0] for r in catalog.discover_property_keys(df).collect())
    flat = {r["item_id"]: r for r in catalog.flatten_items(df, keys).collect()}
    a = flat["i1"]
    assert a["cloud_cover"] == 0.0 and a["platform"] == "m1" and a["acquired"] == datetime(2024, 3, 1, 10)
    assert (a["minx"], a["miny"], a["maxx"], a["maxy"]) == (0, 0, 8, 5)
    assert a["assets"] == {"B04": "s3/b4.tif", "thumb": "t.png"} and json.loads(a["assets_json"]) == a["assets"]
    assert a["raw_eo_cloud_cover"] == "0" and json.loads(a["prop_deep"]) == {"k": 1} and a["prop_note_a"] == "x"
    assert (flat["i2"]["minx"], flat["i2"]["maxy"]) == (1, 4) and flat["i2"]["cloud_cover"] is None
    assert catalog.flatten_items(df, keys, truthy=True).where("item_id = 'i1'").first()["cloud_cover"] == 12.5
    slim = catalog.flatten_items(df, keys, drop_prefixes=["eo:", "view:", "proj:"]).columns
    assert "prop_proj_shape" not in slim and "raw_eo_cloud_cover" not in slim and "prop_deep" in slim


def test_links(spark, rows):
    html = '<html><a href="../">up</a> <A HREF="no">x</A><a class="k" href=\'b.tif\'>b</a><a name="q">n</a><a href="c d.tif">c</a>'
    df = spark.createDataFrame([(1, "http://h/", html), (2, "http://g/", "none")], "page_id int, url string, html string")
    got = rows(catalog.extract_links(df), "page_id", "link")
    assert got == [(1, "http://h/b.tif"), (1, "http://h/c d.tif"), (1, "http://h/no")]
    assert rows(catalog.extract_links(df, base="z:"), "link")[0] == ("z:b.tif",)


def test_zone_layers(spark, tmp_path):
    p = str(tmp_path)
    spark.createDataFrame([("a", "POLYGON ((0 0, 0 2, 2 2, 2 0, 0 0))", 3857)], "zone string, wkt string, srid int").write.parquet(p + "/hex")
    spark.createDataFrame([("b", "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "zone string, wkt string").write.option("header", "true").csv(p + "/adm")
    h = zones.read_zones(spark, p, "hex")
    assert h.select(G.ring_signed_area(F.col("geom")[0])).first()[0] == 4.0
    fields, info = catalog.layer_info(h)
    assert "zone" in fields and info.first().asDict() == {"srid": 3857, "rows": 1}
    a = zones.read_zones(spark, p, "adm", fmt="csv", schema="zone string, wkt string", srid=4326)
    assert a.select(G.area("geom"), "srid").first()[:] == (0.5, 4326)
    zones.write_geojson_lines(h, p + "/lines", srid=3857, drop=("srid",))
    f = json.loads(spark.read.text(p + "/lines").first()[0])
    assert f["properties"] == {"zone": "a"} and f["geometry"]["coordinates"][0][0] == [0.0, 0.0]


def test_csv_sinks_and_compiler(spark, tmp_path, rows):
    out = str(tmp_path / "per_key")
    df = spark.createDataFrame(
        [("h/1 a", "2024-02-29", 2.0), ("h/1 a", "2024-01-31", 1.0), ("h2", "2024-01-31", 5.0), (None, "2024-01-31", 9.0)],
        "zone string, time string, red_mean double",
    )
    files.write_per_key(df, "zone", out, ["zone", "time", "red_mean", "nir_mean"])
    assert sorted(d for d in os.listdir(out) if d.startswith("file=")) == ["file=BANDS_h2", "file=BANDS_h_1_a"]
    part = next(f for f in os.listdir(out + "/file=BANDS_h_1_a") if f.endswith(".csv"))
    lines = open(f"{out}/file=BANDS_h_1_a/{part}").read().split()
    assert lines[0] == "zone,time,red_mean,nir_mean"
    both, summary = files.compile_csvs(spark, out, "zone", "zone string, time date, red_mean double, nir_mean double", recursive=True)
    got = [(r["zone"], str(r["time"]), r["red_mean"]) for r in both.collect()]
    assert got == [("h/1 a", "2024-01-31", 1.0), ("h/1 a", "2024-02-29", 2.0), ("h2", "2024-01-31", 5.0)]
    s = summary.first()
    assert (s["files"] >= 2, s["rows"], s["unique_keys"], str(s["first_time"]), str(s["last_time"])) == (True, 3, 2, "2024-01-31", "2024-02-29")


def test_year_and_wide_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [(datetime(2023, 5, 1), "a", "NDVI", 0.5), (datetime(2024, 5, 1), "b", "NDVI", 0.25), (datetime(2024, 5, 1), "a", "EVI", 1.0)],
        "time timestamp, aoi string, metric string, value double",
    )
    files.write_by_year(df, str(tmp_path / "y"))
    assert sorted(d for d in os.listdir(tmp_path / "y") if d.startswith("year")) == ["year=2023", "year=2024"]
    files.write_by_year(df, str(tmp_path / "yc"), fmt="csv")
    assert spark.read.option("header", "true").csv(str(tmp_path / "yc")).count() == 3
    files.write_wide(df, str(tmp_path / "w"), ["NDVI", "EVI"], ["a", "b"])
    wide = spark.read.option("header", "true").csv(str(tmp_path / "w" / "combined"))
    assert wide.columns == ["time", "NDVI_a", "NDVI_b", "EVI_a", "EVI_b"] and wide.count() == 2
    assert spark.read.option("header", "true").csv(str(tmp_path / "w" / "NDVI")).columns == ["time", "a", "b"]


def test_parcel_series(spark, tmp_path):
    (tmp_path / "s.csv").write_text("date,feature_index,band_unnamed\n2024-05-01T00:00:00.000Z,0,0.25\n2024-05-06T00:00:00.000Z,1,\n")
    got = files.read_parcel_series(spark, str(tmp_path / "s.csv")).orderBy("time").collect()
    assert [(r["time"], r["feature_index"], r["value"]) for r in got] == [(datetime(2024, 5, 1), 0, 0.25), (datetime(2024, 5, 6), 1, None)]


def test_layers_of_a_folder(spark, tmp_path, rows):
    for name, n in (("fields", 1), ("roads", 2)):
        spark.range(4).repartition(n).write.parquet(str(tmp_path / "layers" / name))
    assert rows(catalog.list_layers(spark, str(tmp_path / "layers"))) == [("fields", 1), ("roads", 2)]
