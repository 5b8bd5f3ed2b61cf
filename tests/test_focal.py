from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelfold.operators import focal

H, W = 11, 13


@pytest.fixture(scope="module")
def image(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 50, (H, W)).astype(float)
    a[rng.random((H, W)) < 0.2] = np.nan
    rows = [("t", r, c, float(a[r, c])) for r in range(H) for c in range(W) if not np.isnan(a[r, c])]
    return a, spark.createDataFrame(rows, "time string, row int, col int, v double")


def brute(a, kernel):
    k = np.asarray(kernel)
    h = k.shape[0] // 2
    z = np.nan_to_num(a)
    out = np.zeros_like(z)
    for r in range(H):
        for c in range(W):
            for i in range(-h, h + 1):
                for j in range(-h, h + 1):
                    if 0 <= r + i < H and 0 <= c + j < W:
                        out[r, c] += k[i + h, j + h] * z[r + i, c + j]
    return out


def check(df, col, a, want):
    got = {(r["row"], r["col"]): r[col] for r in df.collect()}
    assert got.keys() == {(r, c) for r in range(H) for c in range(W) if not np.isnan(a[r, c])}
    for (r, c), v in got.items():
        assert v == pytest.approx(want[r, c], abs=1e-9)


@pytest.mark.parametrize("size", [4, 256])
def test_kernel_over_block_borders(image, size):
    a, df = image
    k = np.arange(25.0).reshape(5, 5)
    check(focal.apply_kernel(df, k, "v", "s", size=size), "s", a, brute(a, k))


def test_sobel(image):
    a, df = image
    gx = np.array(focal.SOBEL_X)
    check(focal.sobel(df, "v", size=5), "edge", a, np.hypot(brute(a, gx), brute(a, gx.T)))


def test_dilation(image):
    a, df = image
    mask = (np.nan_to_num(a) > 45).astype(float)
    g = focal.gaussian_weights()
    want = brute(np.where(np.isnan(a), 0, mask), np.outer(g, g)) > 0.1
    out = focal.dilate_mask(df.withColumn("m", F.col("v") > 45), "m", block=6)
    got = {(r["row"], r["col"]): r["m"] for r in out.collect()}
    assert all(got[k] == want[k] for k in got) and 0 < sum(got.values()) < len(got)


def test_copies_of_a_cell_are_folded(spark, image):
    a, df = image
    many = df.union(df).union(df)
    k = np.ones((3, 3))
    check(focal.apply_kernel(many, k, "v", "s", size=5), "s", a, brute(a, k))


def test_blocks_have_the_full_window(image):
    a, df = image
    seen = focal.apply_neighborhood(df, lambda b: {"n": np.full(b["v"].shape, b["v"].size)}, ["v"], ["n"], size=4, overlap=2)
    assert {r["n"] for r in seen.collect()} == {64.0}
    local = focal.apply_neighborhood(df, lambda b: {"m": b["v"] - np.nanmean(b["v"])}, ["v"], ["m"], size=4, overlap=2)
    r = local.where("row = 5 AND col = 6").first()
    if r is not None:
        assert r["m"] == pytest.approx(a[5, 6] - np.nanmean(a[2:10, 2:10]))


def test_even_kernel_is_refused(image):
    with pytest.raises(ValueError):
        focal.apply_kernel(image[1], np.ones((2, 2)), "v")


def test_function_per_pixel(spark):
    df = spark.createDataFrame(
        [(t, r, c, float(t * r + c)) for t in range(4) for r in range(5) for c in range(3)], "time int, row int, col int, v double"
    )
    out = focal.evaluate_pixels(df, lambda s: {"last": s["v"].iloc[-1], "n": len(s)}, ["v"], ["last", "n"], block=2)
    got = {(r["row"], r["col"]): (r["last"], r["n"]) for r in out.collect()}
    assert got == {(r, c): (float(3 * r + c), 4.0) for r in range(5) for c in range(3)}


def test_function_per_pixel_and_period(spark):
    df = spark.createDataFrame(
        [(t // 3, t, r, c, float(t * r + c)) for t in range(6) for r in range(5) for c in range(3)], "p int, time int, row int, col int, v double"
    )
    want = {(p, r, c): (float((3 * p + 2) * r + c), 3.0) for p in range(2) for r in range(5) for c in range(3)}
    for rows, unique in ((df, True), (df.union(df), False)):
        out = focal.evaluate_pixels(rows, lambda s: {"last": s["v"].iloc[-1], "n": len(s)}, ["v"], ["last", "n"], 2, ["p"], unique)
        assert {(r["p"], r["row"], r["col"]): (r["last"], r["n"]) for r in out.collect()} == want
    assert focal.evaluate_pixels(df.where("false"), lambda s: {"n": len(s)}, ["v"], ["n"]).collect() == []


def test_columns_are_carried_through_blocks(image):
    a, df = image
    named = df.withColumn("name", F.concat_ws("-", "row", "col"))
    out = focal.apply_neighborhood(named, lambda b: {"n": b["v"] * 2}, ["v"], ["n"], 4, 2, carry=["name", "v"]).collect()
    assert {r["name"] for r in out} == {f"{r}-{c}" for r in range(H) for c in range(W) if not np.isnan(a[r, c])}
    assert all(r["name"] == f"{r['row']}-{r['col']}" and r["v"] == a[r["row"], r["col"]] and r["n"] == 2 * r["v"] for r in out)
