"""Warping and conservative resampling against cell-by-cell arithmetic."""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
import pytest
from pixelfold.functions.crs import NUMPY, reproject_xy
from pixelfold.operators import raster, warp
from pixelfold.operators.grid import Grid
from pyspark.sql import functions as F

SYSTEMS = [4326, 3857, 32631, 32731, 3035]


@pytest.mark.parametrize("a", SYSTEMS)
@pytest.mark.parametrize("b", SYSTEMS)
def test_array_transforms_equal_the_columns(spark, a, b):
    lon, lat = np.array([2.0, 3.5, 5.9]), np.array([48.0, 51.25, 60.5])
    x, y = reproject_xy(lon, lat, 4326, a, NUMPY)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    got = df.select(*[c.alias(n) for c, n in zip(reproject_xy(F.col("x"), F.col("y"), a, b), "uv")]).collect()
    u, v = reproject_xy(x, y, a, b, NUMPY)
    assert np.allclose([r["u"] for r in got], u, rtol=1e-13, atol=1e-9) and np.allclose([r["v"] for r in got], v, rtol=1e-13, atol=1e-9)


@pytest.mark.parametrize("a", SYSTEMS)
@pytest.mark.parametrize("b", SYSTEMS)
def test_array_transforms_take_a_copy_of_the_functions(a, b):
    """Functions sent to a task bring a copy of the namespace along."""
    x, y = reproject_xy(np.array([2.0, 3.5, 5.9]), np.array([48.0, 51.25, 60.5]), 4326, a, NUMPY)
    copied = reproject_xy(x, y, a, b, SimpleNamespace(**vars(NUMPY)))
    assert np.array_equal(copied, reproject_xy(x, y, a, b, NUMPY))


def naive(cells, source, target, how):
    """cells: {(row, col): value}; one target cell after the other."""
    out = {}
    for r in range(target.height):
        for c in range(target.width):
            x, y = reproject_xy(np.array([target.x0 + (c + 0.5) * target.dx]), np.array([target.y0 + (r + 0.5) * target.dy]), target.srid, source.srid, NUMPY)
            sr, sc = (y[0] - source.y0) / source.dy, (x[0] - source.x0) / source.dx
            if how == "nearest":
                at = (math.floor(sr), math.floor(sc))
                if at in cells:
                    out[r, c] = cells[at]
                continue
            total = weight = 0.0
            for i in (0, 1):
                for j in (0, 1):
                    at = (math.floor(sr - 0.5) + i, math.floor(sc - 0.5) + j)
                    w = (1 - abs(sr - 0.5 - at[0])) * (1 - abs(sc - 0.5 - at[1]))
                    if w > 0 and cells.get(at) is not None:
                        total, weight = total + w * cells[at], weight + w
            if weight:
                out[r, c] = total / weight
    return out


@pytest.mark.parametrize("how", ["nearest", "bilinear"])
@pytest.mark.parametrize("block", [4, 256])
@pytest.mark.parametrize(
    "source, target",
    [
        (Grid(430000, 5762000, 500, -500, 30, 30, 32631), Grid(1.95, 52.05, 0.004, -0.003, 60, 70, 4326)),
        (Grid(2.0, 52.0, 0.01, -0.01, 30, 30, 4326), Grid(215000, 6805000, 4000, -4000, 14, 16, 3857)),
        (Grid(2.0, 51.0, 0.01, 0.01, 30, 30, 4326), Grid(3740000, 3100000, 900, 900, 60, 70, 3035)),
        (Grid(0, 0, 1, 1, 12, 12), Grid(-0.3, 0.2, 0.7, 0.6, 20, 21)),
    ],
)
def test_warp_equals_each_cell(spark, monkeypatch, source, target, how, block):
    monkeypatch.setattr(warp, "BLOCK", block)
    rng = np.random.default_rng(2)
    cells = {(r, c): None if rng.random() < 0.1 else float(rng.integers(0, 1000)) for r in range(source.height) for c in range(source.width) if rng.random() < 0.9}
    rows = [(t, r, c, None if v is None else v + t) for t in (1, 2) for (r, c), v in cells.items()]
    px = spark.createDataFrame(rows, "time int, row int, col int, v double").repartition(3)
    got = {(r["time"], r["row"], r["col"]): r["v"] for r in warp.warp(px, source, target, ["v"], how).collect()}
    want = {(t, *k): None if v is None else v + t for t in (1, 2) for k, v in naive(cells, source, target, how).items()}
    assert len(want) > 200 and set(got) == set(want)
    assert all(got[k] == want[k] if want[k] is None else got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_warp_is_one_exchange_and_keeps_types(spark):
    px = spark.createDataFrame([(1, 0, 0, 7, "a"), (1, 0, 1, None, "b")], "time int, row int, col int, scl int, note string")
    source, target = Grid(2.0, 52.0, 0.01, -0.01, 2, 1, 4326), Grid(222640.0, 6800124.0, 400.0, -400.0, 5, 4, 3857)
    out = warp.warp(px, source, target, ["scl", "note"])
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "int", "int", "int", "string"]
    assert {(r["scl"], r["note"]) for r in out.collect()} == {(7, "a"), (None, "b")}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "CartesianProduct" not in plan
    assert raster.resample_nearest(px, source, target).columns == ["time", "scl", "note", "row", "col"]
    assert warp.warp(px.where("row > 5"), source, target, ["scl"]).count() == 0
    assert warp.warp(px, source, Grid(1e6, 1e6, 10.0, 10.0, 3, 3, 3857), ["scl"]).count() == 0


@pytest.mark.parametrize("target", [Grid(0, 0, 25, 25, 4, 4), Grid(-3, 7, 13, 17, 9, 6), Grid(0, 100, 40, -30, 2, 3), Grid(0, 0, 4, 4, 25, 25), Grid(20, 20, 10, 10, 5, 5)])
def test_conservative_resampling_keeps_the_mass(spark, target):
    source = Grid(0, 0, 10, 10, 10, 10)
    rng = np.random.default_rng(4)
    v = rng.integers(1, 100, (10, 10)).astype(float)
    v[3, 4] = np.nan
    px = spark.createDataFrame([(1, r, c, None if np.isnan(v[r, c]) else float(v[r, c])) for r in range(10) for c in range(10)], "time int, row int, col int, v double")

    def share(i, s0, sd, k, t0, td):
        a, b = sorted((s0 + i * sd, s0 + (i + 1) * sd))
        lo, hi = sorted((t0 + k * td, t0 + (k + 1) * td))
        return max(0.0, min(b, hi) - max(a, lo)) / abs(sd)

    wr = np.array([[share(i, 0, 10, k, target.y0, target.dy) for i in range(10)] for k in range(target.height)])
    wc = np.array([[share(i, 0, 10, k, target.x0, target.dx) for i in range(10)] for k in range(target.width)])
    held, filled = ~np.isnan(v), np.nan_to_num(v)
    sums, weights, met = wr @ filled @ wc.T, wr @ held @ wc.T, wr @ np.ones_like(v) @ wc.T
    got = {(r["row"], r["col"]): r["v"] for r in warp.resample_conservative(px, source, target, ["v"], "sum").collect()}
    assert set(got) == {(r, c) for r, c in zip(*np.nonzero(met > 1e-9))}
    assert all((x or 0.0) == pytest.approx(sums[k], abs=1e-9) for k, x in got.items())
    mean = warp.resample_conservative(px, source, target, ["v"]).collect()
    assert all(r["v"] is None if weights[r["row"], r["col"]] < 1e-9 else r["v"] == pytest.approx(sums[r["row"], r["col"]] / weights[r["row"], r["col"]]) for r in mean)
    if (target.x0, target.y0, target.width * target.dx, target.height * target.dy) == (0, 0, 100, 100):
        assert sum(x or 0.0 for x in got.values()) == pytest.approx(np.nansum(v))
    with pytest.raises(ValueError):
        warp.resample_conservative(px, source, Grid(0, 0, 1, 1, 2, 2, 3857), ["v"])
