"""Hand-made polygons and an independent clipping routine."""

from __future__ import annotations

import math

SQUARE = [[(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]]
HALF_SHIFTED = [[(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5), (1.5, 1.5)]]
TRIANGLE = [[(0, 0), (4, 0), (0, 4), (0, 0)]]
HEXAGON = [[(3 + 2 * math.cos(math.pi * k / 3), 3 + 2 * math.sin(math.pi * k / 3)) for k in (0, 1, 2, 3, 4, 5, 0)]]
L_SHAPE = [[(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4), (0, 0)]]
WITH_HOLE = [
    [(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)],
    [(1.5, 1.5), (1.5, 3.5), (3.5, 3.5), (3.5, 1.5), (1.5, 1.5)],
]
TINY = [[(2.1, 2.1), (2.3, 2.1), (2.3, 2.3), (2.1, 2.3), (2.1, 2.1)]]
OUTSIDE = [[(20, 20), (22, 20), (22, 22), (20, 22), (20, 20)]]


def shoelace(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def area(geom):
    return abs(sum(shoelace(r) for r in geom))


def _cut(points, inside, meet):
    out = []
    for a, b in zip(points, points[1:] + points[:1]):
        if inside(a):
            out.append(a)
            if not inside(b):
                out.append(meet(a, b))
        elif inside(b):
            out.append(meet(a, b))
    return out


def cell_area(geom, r, c):
    """Area of the geometry in the unit cell, ring by ring."""
    total = 0.0
    for ring in geom:
        pts = list(ring[:-1])
        for axis, bound, keep_above in ((0, c, True), (0, c + 1, False), (1, r, True), (1, r + 1, False)):
            def inside(p):
                return p[axis] >= bound if keep_above else p[axis] <= bound

            def meet(a, b):
                t = (bound - a[axis]) / (b[axis] - a[axis])
                return (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))

            pts = _cut(pts, inside, meet) if pts else pts
        if len(pts) > 2:
            total += shoelace(pts + pts[:1])
    return abs(total)


def inside(geom, x, y):
    """Even-odd rule with low borders in and high borders out."""
    n = 0
    for ring in geom:
        for (xa, ya), (xb, yb) in zip(ring, ring[1:]):
            if (ya <= y) != (yb <= y) and xa + (y - ya) * (xb - xa) / (yb - ya) <= x:
                n += 1
    return n % 2 == 1


def layer(spark, **geoms):
    data = [(k, i, [[(float(x), float(y)) for x, y in r] for r in g]) for i, (k, g) in enumerate(geoms.items())]
    return spark.createDataFrame(data, "zone string, ord int, geom array<array<struct<x:double,y:double>>>")
