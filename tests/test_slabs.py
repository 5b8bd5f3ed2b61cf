"""The plane sweep over slabs: areas, shapes and covers against independent clipping."""

from __future__ import annotations

import math
import random
import time

import geo
import numpy as np
import pyarrow as pa
import pytest
from pixelfold.functions import slabs
from pixelfold.operators import overlay
from pyspark.sql import functions as F

SHAPES = [geo.SQUARE, geo.HALF_SHIFTED, geo.TRIANGLE, geo.HEXAGON, geo.L_SHAPE, geo.WITH_HOLE, geo.TINY, geo.OUTSIDE]


def column(geoms):
    return pa.array([[[{"x": float(x), "y": float(y)} for x, y in r] for r in g] for g in geoms], slabs.GEOM)


def box(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def star(rng, n, cx, cy, r):
    """A simple polygon with ``n`` corners around a centre."""
    at = sorted(rng.random() * 2 * math.pi for _ in range(n))
    far = [r * (0.3 + rng.random()) for _ in at]
    ring = [(cx + f * math.cos(a), cy + f * math.sin(a)) for a, f in zip(at, far)]
    return [[*ring, ring[0]]]


def share(geoms, others, at, n=400):
    """Share of a fine lattice over ``at`` inside both."""
    x0, y0, x1, y1 = at
    hits = 0
    for i in range(n):
        for j in range(n):
            x, y = x0 + (i + 0.5) * (x1 - x0) / n, y0 + (j + 0.5) * (y1 - y0) / n
            hits += geo.inside(geoms, x, y) and geo.inside(others, x, y)
    return hits / n**2 * (x1 - x0) * (y1 - y0)


def test_intersections_with_cells():
    cells = [(box(c, r, c + 1, r + 1), r, c) for r in range(5) for c in range(5)]
    left, right = [s for s in SHAPES for _ in cells], [c[0] for _ in SHAPES for c in cells]
    want = [geo.cell_area(s, r, c) for s in SHAPES for _, r, c in cells]
    area, shape = slabs.intersections(column(left), column(right))
    assert np.abs(area - want).max() < 1e-12
    for g, w in zip(shape.to_pylist(), want):
        parts = [geo.shoelace([(p["x"], p["y"]) for p in ring]) for ring in g]
        assert sum(parts) == pytest.approx(w, abs=1e-12) and all(a > 0 for a in parts)
    sliced, _ = slabs.intersections(column(left).slice(30, 50), column(right).slice(30, 50), False)
    assert (sliced == area[30:80]).all()
    swapped, _ = slabs.intersections(column(right), column(left), False)
    assert np.abs(swapped - want).max() < 1e-12


def test_intersections_of_stars():
    rng = random.Random(3)
    for n in (5, 40):
        a, b = star(rng, n, 0, 0, 1), star(rng, n, 0.3, 0.2, 1)
        area, _ = slabs.intersections(column([a]), column([b]))
        assert area[0] == pytest.approx(share(a, b, (-1.4, -1.4, 1.8, 1.7)), abs=0.01)
        both, _ = slabs.intersections(column([a, a, b]), column([b, a, b]))
        assert both[0] == pytest.approx(area[0], rel=1e-12) and both[1:] == pytest.approx([geo.area(a), geo.area(b)], rel=1e-9)


def comb(n, seed):
    rng = random.Random(seed)
    ring = [(0, 0)]
    for i in range(n):
        ring += [(i, 0.1), (i, 1 + rng.random() * 10), (i + 0.5, 1 + rng.random() * 10), (i + 0.5, 0.1)]
    return [[*ring, (n, 0.1), (n, 0), (0, 0)]]


def test_combs_are_swept_in_linear_time():
    def seconds(n):
        a, b = column([comb(n, 1)]), column([[[(x + 0.25, y + 0.01) for x, y in r] for r in comb(n, 2)]])
        times = []
        for _ in range(5):
            t = time.perf_counter()
            slabs.intersections(a, b)
            times.append(time.perf_counter() - t)
        return min(times)

    # 2,000 corners against 2,000, and eight times that: within three times of linear.
    assert seconds(4000) < 3 * 8 * seconds(500)


def test_uncovered():
    square = column([geo.SQUARE])
    assert slabs.uncovered(square, column([])) == 4
    assert slabs.uncovered(square, column([box(1, 1, 2, 3), box(1.5, 1, 3, 2)])) == 1  # the overlap does not make up for the gap
    assert slabs.uncovered(square, column([geo.WITH_HOLE])) == pytest.approx(2.25)
    assert slabs.uncovered(square, column([geo.WITH_HOLE]), 2, 2.5) == pytest.approx(0.75)
    assert slabs.uncovered(square, column([geo.WITH_HOLE, box(1.5, 1.5, 3.5, 3.5)])) == 0


@pytest.mark.parametrize("corners", [7, 100_000])
def test_within_union_with_overlaps(spark, monkeypatch, corners):
    monkeypatch.setattr(overlay, "SWEPT_CORNERS", corners)
    children = {"gap": box(0, 0, 4, 4), "hole": box(10, 0, 14, 4), "full": box(20, 0, 24, 4), "alone": box(50, 0, 51, 1), "line": [[(20, 0), (24, 0), (20, 0)]]}
    ring = [[(9, -1), (15, -1), (15, 5), (9, 5), (9, -1)], [(11, 1), (11, 3), (13, 3), (13, 1), (11, 1)]]
    parents = {"a": box(0, 0, 3, 4), "b": box(1, 0, 3.5, 4), "c": box(0, 0, 3, 4), "ring": ring, "over": box(10, 0, 14, 1), "over2": box(10, 0, 14, 1), "p": box(19, -1, 22.5, 5), "q": box(21.5, -1, 25, 2), "r": box(22, 1, 25, 5)}
    z, p = geo.layer(spark, **children), geo.layer(spark, **parents)
    key = z.columns[0]
    assert {r[0] for r in overlay.within_union(z, p, key).select(key).collect()} == {"full", "line"}
    assert overlay.within_union(z.where(F.lit(False)), p, key).count() == 0


def test_many_cornered_overlay_on_both_sides(spark):
    rng = random.Random(5)
    a = {f"a{i}": star(rng, 500, i * 1.5, 0, 1) for i in range(3)}
    b = {f"b{i}": star(rng, 500, i * 1.5 + 0.4, 0.3, 1) for i in range(3)}
    za, zb = geo.layer(spark, **a), geo.layer(spark, **b)
    key = za.columns[0]
    zb = zb.withColumnRenamed(key, "other")
    got = {(r[0], r[1]): r["area"] for r in overlay.overlay_intersection(za, zb, [key], ["other"]).collect()}
    for (i, x), (j, y) in ((p, q) for p in a.items() for q in b.items()):
        want = slabs.intersections(column([x]), column([y]), False)[0][0]
        assert got.get((i, j), 0.0) == pytest.approx(want, rel=1e-9)
    counted = {r[0]: r["children"] for r in overlay.children_per_parent(za, zb, key, "other").collect()}
    assert counted == {j: sum(k[1] == j for k in got) for j in {k[1] for k in got}}


def test_many_children_are_swept_as_each_alone():
    rng = random.Random(8)
    children, others, of = [], [], []
    for i in range(40):
        x, y = i * 3.0, rng.choice([0.0, 1e6])
        children.append(star(rng, 12, x, y, 1) if i % 2 else box(x, y, x + 1, y + 1))
        for _ in range(i % 4):
            others.append(box(x + rng.uniform(-1, 0.5), y - 2, x + rng.uniform(0.5, 3), y + 2))
            of.append(i)
    of = np.array(of)
    low = np.array([min(v for r in c for _, v in r) for c in children]) + 0.1
    got = slabs.uncovered_each(column(children), column(others), of, low, low + 0.7)
    for i, c in enumerate(children):
        alone = slabs.uncovered(column([c]), column([o for o, j in zip(others, of) if j == i]), low[i], low[i] + 0.7)
        assert got[i] == pytest.approx(alone, abs=1e-9)
    assert 0 < np.count_nonzero(got) < 40


def test_no_common_area_is_a_float_too():
    assert slabs.intersections(column([box(0, 0, 1, 1)]), column([box(2, 2, 3, 3)]), False)[0].dtype == float
    assert slabs.uncovered_each(column([geo.SQUARE]), column([geo.SQUARE]), np.zeros(1, int), np.array([-9.0]), np.array([9.0])).dtype == float


def test_union_cover_needs_no_group_per_child(spark):
    children, parents = {f"c{i}": box(i * 3, 0, i * 3 + (1 if i % 3 else 2), 1) for i in range(300)}, {f"p{i}": box(i * 3, 0, i * 3 + 1, 1) for i in range(300)}
    z, p = geo.layer(spark, **children), geo.layer(spark, **parents)
    key = z.columns[0]
    found = overlay.within_union(z, p, key)
    assert "FlatMapCoGroups" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r[0] for r in found.select(key).collect()} == {f"c{i}" for i in range(300) if i % 3}
