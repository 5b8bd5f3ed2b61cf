"""Overview pyramids, discovered metadata columns, bins and file names."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from pixelfold.operators import raster, series
from pixelfold.operators.pyramid import Pyramid
from pixelfold.sources import catalog, files


@pytest.fixture(scope="module")
def holes(spark):
    """A raster of 21 x 13 cells at two times with NULLs and absent cells."""
    cells = spark.range(2 * 21 * 13).select(
        (F.col("id") % 2).alias("time"), (F.col("id") / 26).cast("int").alias("row"), ((F.col("id") / 2).cast("int") % 13).alias("col")
    )
    v = F.when((F.col("row") + F.col("col")) % 5 != 0, (F.col("row") * 31 + F.col("col") * 7 + F.col("time")) % 50)
    return cells.withColumn("v", v.cast("double")).where("NOT (row % 4 = 0 AND col = 8)")


@pytest.fixture(scope="module")
def pyramid(holes, tmp_path_factory):
    return Pyramid(holes, str(tmp_path_factory.mktemp("levels")), 3, ("v",)).write()


@pytest.mark.parametrize("k", [1, 2, 3, 4, 6, 8, 16])
def test_a_pyramid_equals_the_raster(holes, pyramid, rows, k):
    names = ["time", "row", "col", "v"]
    assert rows(pyramid.decimated(k), *names) == rows(raster.decimate(holes, k), *names)
    got, want = rows(pyramid.mean(k), *names), rows(raster.resample_grid(holes, k, ["v"]), *names)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == [pytest.approx(r[3]) for r in want]


def test_a_coarse_read_opens_one_level(pyramid):
    files_read = pyramid.decimated(8).inputFiles()
    assert files_read and all("/level_3/" in f for f in files_read)
    assert pyramid.best_level(6) == 1 and pyramid.best_level(7) == 0 and pyramid.best_level(64) == 3


ITEMS = [
    '{"id":"a","properties":{"eo:x":1.5,"n":3,"mixed":"s","o":{"z":1},"l":[1,"b"],"none":null,"t":true,"it\'s":"q","eo.x":"dot"}}',
    '{"id":"b","properties":{"n":4,"mixed":2,"eo:x":2,"big":123456789012345678901}}',
    '{"id":"c"}',
    "no json",
    None,
]


def test_columns_are_found_with_their_types(spark):
    out = catalog.flatten_found(spark.createDataFrame([(i,) for i in ITEMS], "value string"))
    kinds = dict(out.dtypes)
    assert kinds["prop_n"] == "bigint" and kinds["prop_t"] == "boolean" and kinds["prop_mixed"] == "string"
    # Two names that are equal when made safe, in the order of the names.
    assert kinds["prop_eo_x"] == "string" and kinds["prop_eo_x_2"] == "double"
    got = {r["item_id"]: r.asDict() for r in out.collect() if r["item_id"]}
    a, b = got["a"], got["b"]
    assert (a["prop_eo_x"], a["prop_eo_x_2"], a["prop_n"], a["prop_mixed"], a["prop_o"], a["prop_l"]) == ("dot", 1.5, 3, "s", '{"z":1}', '[1,"b"]')
    assert a["prop_none"] is None and a["prop_t"] is True and a["prop_it's"] == "q"
    assert (b["prop_eo_x_2"], b["prop_n"], b["prop_mixed"], int(b["prop_big"])) == (2.0, 4, "2", 123456789012345678901)
    assert out.count() == 5 and all(v is None for k, v in got["c"].items() if k != "item_id")
    assert "prop_eo_x" not in catalog.flatten_found(spark.createDataFrame([(ITEMS[1],)], "value string"), drop_prefixes=["eo:"]).columns
    assert catalog.flatten_found(spark.createDataFrame([], "value string")).columns == ["item_id"]


def test_empty_bins_are_counted(spark, rows):
    df = spark.createDataFrame([(1.0,), (1.1,), (5.0,), (-3.0,)], "v double")
    assert rows(series.histogram(df, "v", 4, empty_bins=True)) == [(0, 2), (1, 0), (2, 0), (3, 1)]
    assert rows(series.histogram(df.where("false"), "v", 2, empty_bins=True)) == [(0, 0), (1, 0)]


def test_keys_of_one_folder_are_an_error(spark, tmp_path):
    day = datetime.date(2024, 1, 1)
    df = spark.createDataFrame([("a/b", day, 1.0), ("a b", day, 2.0)], "zone string, time date, v double")
    with pytest.raises(ValueError, match="share the folder"):
        files.write_per_key(df, "zone", str(tmp_path / "out"), ["zone", "time", "v"])
    assert not (tmp_path / "out").exists()
