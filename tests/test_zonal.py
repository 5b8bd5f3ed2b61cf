from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import geo
from pixelfold.functions.crs import reproject
from pixelfold.operators import zonal
from pixelfold.operators.grid import Grid

GRID = Grid(0, 0, 1, 1, 6, 6)


@pytest.fixture(scope="module")
def cube(spark):
    rng = np.random.default_rng(3)
    data = []
    for t in ("2024-01-31", "2024-02-29"):
        for r in range(6):
            for c in range(6):
                v = None if (t > "2024-02" and r < 4 and c < 4) else float(rng.integers(0, 1000))
                data.append((t, r, c, v))
    return spark.createDataFrame(data, "time string, row int, col int, v double")


def brute(cube, geom, t, weight):
    vals = [(r["v"], weight(geom, r["row"], r["col"])) for r in cube.collect() if r["time"] == t]
    return [(v, w) for v, w in vals if w > 0]


def centre(geom, r, c):
    return 1.0 if geo.inside(geom, c + 0.5, r + 0.5) else 0.0


ZONES = dict(hexagon=geo.HEXAGON, ell=geo.L_SHAPE, hole=geo.WITH_HOLE, tiny=geo.TINY, outside=geo.OUTSIDE)


def test_mean_rows_and_values(spark, cube):
    z = geo.layer(spark, **ZONES)
    got = {(r["zone"], r["time"]): r["v_mean"] for r in zonal.zonal_mean(cube, z, GRID, "zone", ["v"]).collect()}
    assert {k for k, _ in got} == {"hexagon", "ell", "hole"}
    for k in ("hexagon", "ell", "hole"):
        for t in ("2024-01-31", "2024-02-29"):
            vals = [v for v, _ in brute(cube, ZONES[k], t, centre) if v is not None]
            assert got[(k, t)] == (pytest.approx(np.mean(vals)) if vals else None)


def test_stats_keep_zones_without_pixels(spark, cube):
    z = geo.layer(spark, **ZONES)
    out = zonal.zonal_stats(cube, z, GRID, "zone", "v", ["mean", "sum", "count", "std", "min", "max"]).collect()
    assert len(out) == len(ZONES) * 2
    for r in out:
        vals = [v for v, _ in brute(cube, ZONES[r["zone"]], r["time"], centre) if v is not None]
        assert r["count"] == len(vals)
        assert r["std"] == (pytest.approx(np.std(vals)) if len(vals) > 1 else None)
        assert r["sum"] == (sum(vals) if vals else None)


def test_weighted_mean_sees_the_tiny_zone(spark, cube):
    z = geo.layer(spark, **ZONES)
    got = {(r["zone"], r["time"]): r for r in zonal.zonal_weighted(cube, z, GRID, "zone", ["v"], ["mean", "min"]).collect()}
    assert {k for k, _ in got} == {"hexagon", "ell", "hole", "tiny"}
    for (k, t), r in got.items():
        vals = [(v, w) for v, w in brute(cube, ZONES[k], t, geo.cell_area) if v is not None]
        if vals:
            assert r["v_mean"] == pytest.approx(sum(v * w for v, w in vals) / sum(w for _, w in vals))
            assert r["v_min"] == min(v for v, _ in vals)
        else:
            assert r["v_mean"] is None


def test_full_weights_equal_the_plain_mean(spark, cube, rows):
    z = geo.layer(spark, a=geo.SQUARE)
    assert rows(zonal.zonal_weighted(cube, z, GRID, "zone", ["v"])) == rows(zonal.zonal_mean(cube, z, GRID, "zone", ["v"]))


def test_three_algorithms_agree_on_disjoint_zones(spark, cube, rows):
    left = [[(0, 0), (3, 0), (3, 6), (0, 6), (0, 0)]]
    right = [[(3, 0), (6, 0), (6, 6), (3, 6), (3, 0)]]
    z = geo.layer(spark, left=left, right=right)
    a = rows(zonal.zonal_mean(cube, z, GRID, "zone", ["v"]))
    b = rows(zonal.zonal_mean_of_labels(cube, zonal.rasterize(z, GRID, "zone", "ord"), "zone", ["v"]))
    c = rows(zonal.zonal_stats(cube, z, GRID, "zone", "v", ["mean"]), "zone", "time", "mean")
    assert a == b == c


def test_all_touched_zero_fill(spark, cube):
    z = geo.layer(spark, t=geo.TRIANGLE)
    out = zonal.clip_all_touched(cube, z, GRID, "zone", ["v"], outside="zero").where("time = '2024-01-31'").collect()
    assert len(out) == 16
    data = {(r["row"], r["col"]): r["v"] for r in cube.collect() if r["time"] == "2024-01-31"}
    for r in out:
        touched = r["row"] + r["col"] < 4
        assert r["v"] == (data[(r["row"], r["col"])] if touched else 0.0)
    kept = zonal.clip_all_touched(cube, z, GRID, "zone", ["v"]).where("time = '2024-01-31'").count()
    assert kept == 10


def test_null_keys_are_skipped(spark, cube):
    z = geo.layer(spark, a=geo.SQUARE, b=geo.L_SHAPE).withColumn("zone", F.when(F.col("zone") != "b", F.col("zone")))
    assert {r["zone"] for r in zonal.zonal_mean(cube, z, GRID, "zone", ["v"]).collect()} == {"a"}


def test_shuffled_join_equals_broadcast(spark, cube, rows, monkeypatch):
    z = geo.layer(spark, **ZONES)
    small = rows(zonal.zonal_mean(cube, z, GRID, "zone", ["v"]))
    monkeypatch.setattr(zonal, "BROADCAST_CELLS", 0)
    big = zonal.zonal_mean(cube, z, GRID, "zone", ["v"])
    text = big._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text and "SortMergeJoin" in text
    assert rows(big) == small


def test_percentiles_and_mad_with_many_buckets(spark):
    from pixelfold.operators.quantiles import group_mad, group_quantiles

    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(size=3000), 2), rng.normal(size=7)
    df = spark.createDataFrame(
        [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("c", 1.5), ("a", None)], "k string, v double"
    )
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r["k"]: r for r in group_quantiles(df, ["k"], F.col("v"), probs, cuts=16, one_bucket=4).collect()}
    for k, vals in (("a", a), ("b", b), ("c", [1.5])):
        for n, p in probs.items():
            assert got[k][n] == pytest.approx(np.quantile(vals, p), abs=1e-12)
    mad = {r["k"]: r["mad"] for r in group_mad(df, ["k"], F.col("v"), cuts=16, one_bucket=4).collect()}
    for k, vals in (("a", a), ("b", b), ("c", [1.5])):
        assert mad[k] == pytest.approx(np.median(np.abs(vals - np.median(vals))), abs=1e-12)


def test_user_statistic_sees_all_values_of_any_band(spark, cube):
    z = geo.layer(spark, **ZONES)

    def geometric(values, counts):
        return float(np.exp(np.sum(np.log(values + 1) * counts) / counts.sum()))

    out = zonal.zonal_user_stat(cube, z, GRID, "zone", "v", geometric, "g").collect()
    assert out
    for r in out:
        vals = np.array([v for v, _ in brute(cube, ZONES[r["zone"]], r["time"], centre) if v is not None])
        assert r["g"] == pytest.approx(np.exp(np.log(vals + 1).mean()))
    halves = cube.withColumn("v", F.col("v") / 8 + 0.03)
    for r in zonal.zonal_user_stat(halves, z, GRID, "zone", "v", geometric, "g").collect():
        vals = np.array([v for v, _ in brute(halves, ZONES[r["zone"]], r["time"], centre) if v is not None])
        assert r["g"] == pytest.approx(np.exp(np.log(vals + 1).mean()))


def test_crosstab_rows_sum_to_hundred(spark):
    zones = spark.createDataFrame([(r, c, r % 2) for r in range(4) for c in range(4)], "row int, col int, z int")
    cats = spark.createDataFrame([(r, c, (r + c) % 3) for r in range(4) for c in range(4)], "row int, col int, k int")
    for r in zonal.crosstab(zones, cats, "z", "k", [0, 1, 2]).collect():
        assert r["cat_0"] + r["cat_1"] + r["cat_2"] == pytest.approx(100)


def test_mask_bands_are_left_out():
    assert zonal.data_bands(["red", "SCL", "oa_fmask", "nir"]) == ["red", "nir"]
    assert zonal.data_bands(["red", "SCL"], include_categorical=True) == ["red", "SCL"]


def test_layers_are_moved_to_the_grid(spark, rows):
    grid = Grid(500000.0, 5500000.0, 10.0, -10.0, 40, 40, srid=32632)
    shapes = {"a": [[(500050, 5499900), (500200, 5499900), (500120, 5499750), (500050, 5499900)]], "b": geo_box(500210, 5499650, 500333, 5499801)}
    utm = geo.layer(spark, **shapes).withColumn("srid", F.lit(32632))
    lonlat = utm.withColumn("geom", reproject("geom", 32632, 4326)).withColumn("srid", F.lit(4326))
    mixed = lonlat.where("zone = 'a'").unionByName(utm.where("zone = 'b'"))
    want = rows(zonal.rasterize(utm, grid, "zone"), "row", "col", "zone")
    assert len(want) > 100
    assert rows(zonal.rasterize(lonlat, grid, "zone"), "row", "col", "zone") == want
    assert rows(zonal.rasterize(mixed, grid, "zone"), "row", "col", "zone") == want
    with pytest.raises(ValueError):
        zonal.rasterize(utm.withColumn("srid", F.lit(None).cast("int")), grid, "zone")


def geo_box(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]
