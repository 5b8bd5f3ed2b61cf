from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import geo
from pixelfold.functions import geometry as G
from pixelfold.operators import overlay, tables


@pytest.fixture(scope="module")
def layers(spark):
    """Boxes of very different sizes, copies included."""
    rng = np.random.default_rng(11)

    def box(x, y, w, h):
        return [[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]

    left = {f"l{i}": box(*rng.integers(-40, 40, 2) / 4, *(rng.integers(1, 9, 2) / 4) * 2.0 ** rng.integers(-3, 4)) for i in range(60)}
    left.update({f"copy{i}": box(0.25, 0.25, 1, 1) for i in range(20)})
    right = {f"r{i}": box(*rng.integers(-40, 40, 2) / 4, *(rng.integers(1, 9, 2) / 4) * 2.0 ** rng.integers(-3, 4)) for i in range(25)}
    right.update({f"rc{i}": box(0, 0, 2, 2) for i in range(3)})
    return left, right


def bounds(g):
    xs, ys = [p[0] for p in g[0]], [p[1] for p in g[0]]
    return min(xs), min(ys), max(xs), max(ys)


def meet(a, b):
    a, b = bounds(a), bounds(b)
    return a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]


def shared(a, b):
    a, b = bounds(a), bounds(b)
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def test_join_gives_every_pair_once(spark, layers, rows):
    left, right = layers
    got = rows(overlay.sjoin(geo.layer(spark, **left), geo.layer(spark, **right), ["zone"], ["zone"]))
    assert got == sorted((k, m) for k, a in left.items() for m, b in right.items() if meet(a, b))


def test_keep_and_drop_intersecting(spark, layers, rows):
    left, right = layers
    right = {k: right[k] for k in list(right)[:6]}
    l, r = geo.layer(spark, **left), geo.layer(spark, **right)
    want = sorted((k,) for k, a in left.items() if any(meet(a, b) for b in right.values()))
    assert 0 < len(want) < len(left)
    assert rows(overlay.keep_intersecting(l, r, "zone"), "zone") == want
    rest = sorted((k,) for k in left if (k,) not in want)
    assert rows(overlay.keep_intersecting(l, r, "zone", anti=True), "zone") == rest


def test_overlay_areas(spark, layers):
    left, right = layers
    out = overlay.overlay_intersection(geo.layer(spark, **left), geo.layer(spark, **right), ["zone"], ["zone"])
    got = {(r["zone_1"], r["zone_2"]): r["area"] for r in out.collect()}
    want = {(k, m): shared(a, b) for k, a in left.items() for m, b in right.items() if shared(a, b) > 0}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_overlay_of_general_shapes_with_a_hexagon(spark):
    z = geo.layer(spark, ell=geo.L_SHAPE, hole=geo.WITH_HOLE, tri=geo.TRIANGLE)
    unit = {f"{r},{c}": [[(c, r), (c + 1, r), (c + 1, r + 1), (c, r + 1), (c, r)]] for r in range(5) for c in range(5)}
    out = overlay.overlay_intersection(z, geo.layer(spark, **unit), ["zone"], ["zone"])
    got = {(r["zone_1"], r["zone_2"]): r["area"] for r in out.collect()}
    for name, g in (("ell", geo.L_SHAPE), ("hole", geo.WITH_HOLE), ("tri", geo.TRIANGLE)):
        for key in unit:
            r, c = map(int, key.split(","))
            assert got.get((name, key), 0.0) == pytest.approx(geo.cell_area(g, r, c))
    hexagon = overlay.overlay_intersection(z, geo.layer(spark, h=geo.HEXAGON), ["zone"], ["zone"])
    back = overlay.overlay_intersection(geo.layer(spark, h=geo.HEXAGON), geo.layer(spark, t=geo.TRIANGLE), ["zone"], ["zone"])
    tri = [r["area"] for r in hexagon.collect() if r["zone_1"] == "tri"]
    assert tri[0] == pytest.approx(back.first()["area"])


def test_overlay_with_concave_holed_and_two_part_right_sides(spark):
    """Each side as the right one gives the areas that unit cells have in the shape."""
    unit = {f"{r},{c}": [[(c, r), (c + 1, r), (c + 1, r + 1), (c, r + 1), (c, r)]] for r in range(5) for c in range(5)}
    two = [unit["0,0"][0], unit["3,3"][0]]
    shapes = {"ell": geo.L_SHAPE, "hole": geo.WITH_HOLE, "tri": geo.TRIANGLE, "hex": geo.HEXAGON, "two": two}
    out = overlay.overlay_intersection(geo.layer(spark, **unit), geo.layer(spark, **shapes), ["zone"], ["zone"])
    got = {(r["zone_1"], r["zone_2"]): r["area"] for r in out.withColumn("area", G.area("geom")).collect()}
    for name, g in shapes.items():
        for key in unit:
            want = float(key in ("0,0", "3,3")) if name == "two" else geo.cell_area(g, *map(int, key.split(",")))
            assert got.get((key, name), 0.0) == pytest.approx(want, abs=1e-12), (name, key)


def test_overlay_of_two_concave_polygons_is_symmetric(spark):
    shapes = {"ell": geo.L_SHAPE, "hole": geo.WITH_HOLE, "tri": geo.TRIANGLE, "hex": geo.HEXAGON}
    z = geo.layer(spark, **shapes)
    out = overlay.overlay_intersection(z, z, ["zone"], ["zone"])
    got = {(r["zone_1"], r["zone_2"]): r["area"] for r in out.collect()}
    own = {r["zone"]: r["a"] for r in z.select("zone", G.area(G.orient("geom")).alias("a")).collect()}
    for a in shapes:
        assert got[a, a] == pytest.approx(own[a])
        for b in shapes:
            # Shapes that only touch may share an area of rounding size.
            assert got.get((a, b), 0.0) == pytest.approx(got.get((b, a), 0.0), abs=1e-12)


def test_within_and_within_union(spark, rows):
    def box(x, y, w, h):
        return [[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]

    parents = geo.layer(spark, p=box(0, 0, 4, 4), q=box(4, 0, 4, 4))
    kids = geo.layer(spark, a=box(1, 1, 1, 1), b=box(3, 1, 2, 1), c=box(7, 3, 2, 2), d=box(0, 0, 4, 4), e=box(20, 20, 1, 1))
    assert rows(overlay.within(kids, parents.withColumnRenamed("zone", "p"), "zone", "p")) == [("a", "p"), ("d", "p")]
    assert rows(overlay.within_union(kids, parents, "zone"), "zone") == [("a",), ("b",), ("d",)]


def test_children_per_parent_counts_split_children_twice(spark, rows):
    def box(x, y, w, h):
        return [[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]

    parents = geo.layer(spark, p=box(0, 0, 4, 4), q=box(4, 0, 4, 4)).withColumnRenamed("zone", "parent")
    kids = geo.layer(spark, a=box(1, 1, 1, 1), b=box(3, 1, 2, 1), c=box(4, 0, 1, 1))
    assert rows(overlay.children_per_parent(kids, parents, "zone", "parent")) == [("p", 2), ("q", 2)]


def test_touching_and_nested_polygons_intersect(spark):
    def hit(a, b):
        df = geo.layer(spark, a=a).select(F.col("geom").alias("g1")).join(
            geo.layer(spark, b=b).select(F.col("geom").alias("g2")), F.lit(True)
        )
        return df.select(G.intersects("g1", "g2")).first()[0]

    assert hit(geo.SQUARE, [[(3, 3), (4, 3), (4, 4), (3, 4), (3, 3)]])
    assert hit(geo.WITH_HOLE, geo.TINY[:]) is False
    assert hit(geo.L_SHAPE, [[(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]]) is False
    assert hit(geo.SQUARE, geo.HALF_SHIFTED) and hit(geo.HALF_SHIFTED, geo.SQUARE)


def test_bounds_and_centroid(spark):
    z = geo.layer(spark, ell=geo.L_SHAPE, hole=geo.WITH_HOLE)
    b = tables.total_bounds(z).first()
    assert (b["minx"], b["miny"], b["maxx"], b["maxy"]) == (0, 0, 5, 5)
    c = {r[0]: r[1] for r in z.select("zone", G.centroid("geom")).collect()}
    assert (c["hole"]["x"], c["hole"]["y"]) == (pytest.approx(2.5), pytest.approx(2.5))
    assert c["ell"]["x"] == pytest.approx((4 * 2 + 3 * 0.5) / 7)


def test_within_concave_and_holed_parents(spark, rows):
    u = [[(0, 0), (6, 0), (6, 6), (4, 6), (4, 2), (2, 2), (2, 6), (0, 6), (0, 0)]]
    box = lambda x0, y0, x1, y1: [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]
    children = geo.layer(spark, bar=box(1, 3, 5, 4), arm=box(0, 3, 2, 6), foot=box(1, 0, 5, 2), left=box(0.5, 0.5, 1.5, 5))
    found = overlay.within(children, geo.layer(spark, u=u).withColumnRenamed("zone", "parent"), "zone", "parent")
    assert rows(found, "zone") == [("arm",), ("foot",), ("left",)]
    holed = geo.layer(spark, holed=geo.WITH_HOLE).withColumnRenamed("zone", "parent")
    around = geo.layer(spark, around=box(1, 1, 4, 4), beside=box(0, 0, 1, 5))
    assert rows(overlay.within(around, holed, "zone", "parent"), "zone") == [("beside",)]


def test_plans_do_not_leave_the_broadcast_to_the_planner(spark, layers, monkeypatch):
    left, right = (geo.layer(spark, **side) for side in layers)
    plan = lambda: overlay.sjoin(left, right, ["zone"], ["zone"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan() and "SortMergeJoin" not in plan()
    monkeypatch.setattr(overlay, "BROADCAST_ROWS", 0)
    assert "SortMergeJoin" in plan() and "BroadcastHashJoin" not in plan()


def test_within_union_notices_gaps_and_holes(spark, rows):
    box = lambda x0, y0, x1, y1: [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]
    kids = geo.layer(spark, over=box(1, 1, 9, 2), inside=box(1, 1, 3, 2), bridge=box(3, 0, 5, 4), edge=box(4, 4, 5, 4))
    gap = geo.layer(spark, p=box(0, 0, 4, 4), q=box(6, 0, 10, 4))
    assert rows(overlay.within_union(kids, gap, "zone"), "zone") == [("inside",)]
    filled = geo.layer(spark, p=box(0, 0, 4, 4), m=box(4, 0, 6, 4), q=box(6, 0, 10, 4))
    assert rows(overlay.within_union(kids, filled, "zone"), "zone") == [("bridge",), ("edge",), ("inside",), ("over",)]
    around = geo.layer(spark, around=box(0, 0, 5, 5), beside=box(0, 0, 1, 5))
    assert rows(overlay.within_union(around, geo.layer(spark, h=geo.WITH_HOLE), "zone"), "zone") == [("beside",)]
