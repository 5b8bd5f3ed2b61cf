"""Polygon overlays by a plane sweep over slabs, for many pairs at once, as arrays inside a task.

The heights of all corners and crossings cut the plane into slabs in which no two edges cross. In each slab the edges are sorted
from left to right; counting which polygons they enter and leave gives what lies between two neighbours. Shared borders,
touching corners and holes need no special case: they give parts without area. Each group of polygons is swept along the axis
with fewer (edge, slab) incidences, which is linear for combs and strips.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Differences below this share of the largest coordinate are rounding.
TOLERANCE = 1e-12
POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
GEOM = pa.list_(pa.list_(POINT))


def edges_of(geoms: pa.Array) -> tuple[np.ndarray, ...]:
    """Row and ends (x0, y0, x1, y1) of all edges of a column of geometries; open rings are closed."""
    geoms = geoms.combine_chunks() if isinstance(geoms, pa.ChunkedArray) else geoms
    rings = geoms.flatten()
    points = rings.flatten()
    x, y = (np.asarray(c) for c in points.flatten())  # of the slice only
    sizes = np.asarray(rings.value_lengths().fill_null(0), np.int64)
    row = np.repeat(np.repeat(np.arange(len(geoms)), np.asarray(geoms.value_lengths().fill_null(0), np.int64)), sizes)
    after = np.arange(1, len(x) + 1)
    ends = np.cumsum(sizes)
    full = sizes > 0
    after[ends[full] - 1] = (ends - sizes)[full]
    return row, x, y, x[after], y[after]


@dataclass
class Slabs:
    """The edges in each slab, sorted by group, slab and place: heights of the slab, x at both, the edge's number."""

    slab: np.ndarray
    low: np.ndarray
    high: np.ndarray
    at_low: np.ndarray
    at_high: np.ndarray
    edge: np.ndarray


def _incidences(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, extra_group: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Heights of all events, their group, and the first and the end slab of every edge."""
    values, rank = np.unique(np.concatenate((lo, hi, extra)), return_inverse=True)
    n = len(values)
    codes = np.concatenate((group, group, extra_group)) * n + rank
    events, at = np.unique(codes, return_inverse=True)
    m = len(lo)
    return values[events % n], events // n, at[:m], at[m : 2 * m]


def sweep(group: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> Slabs:
    """Slabs of each group of edges (y0 < y1), cut at every corner and crossing of the group."""
    scale = np.full(int(group.max(initial=-1)) + 1, 1e-300)
    np.maximum.at(scale, group, np.maximum(np.abs(x0), np.abs(x1)))
    scale *= TOLERANCE
    cut_group, cut = np.zeros(0, np.int64), np.zeros(0)
    while True:
        heights, _, first, end = _incidences(group, y0, y1, cut_group, cut)
        spans = end - first
        edge = np.repeat(np.arange(len(group)), spans)
        slab = np.arange(len(edge)) - np.repeat(np.cumsum(spans) - spans, spans) + first[edge]
        low, high = heights[slab], heights[slab + 1]
        slope = (x1 - x0) / (y1 - y0)
        at_low = np.where(low == y0[edge], x0[edge], x0[edge] + (low - y0[edge]) * slope[edge])
        at_high = np.where(high == y1[edge], x1[edge], x1[edge] + (high - y1[edge]) * slope[edge])
        order = np.lexsort((at_high, at_low, slab))
        s, a, b = slab[order], at_low[order], at_high[order]
        gap_low, gap_high = a[1:] - a[:-1], b[:-1] - b[1:]
        least = scale[group[edge[order[1:]]]]
        crossed = np.flatnonzero((s[1:] == s[:-1]) & (gap_low > least) & (gap_high > least))
        if len(crossed):
            t = gap_low[crossed] / (gap_low[crossed] + gap_high[crossed])
            lo, hi = low[order][crossed], high[order][crossed]
            height = lo + t * (hi - lo)
            inside = (height > lo) & (height < hi)
            if inside.any():
                cut_group = np.concatenate((cut_group, group[edge[order][crossed[inside]]]))
                cut = np.concatenate((cut, height[inside]))
                continue
        order = np.lexsort((at_low + at_high, slab))
        return Slabs(slab[order], low[order], high[order], at_low[order], at_high[order], edge[order])


def _swept(group: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> tuple[Slabs, np.ndarray, np.ndarray]:
    """Slabs along each group's cheaper axis; with the number of each kept edge among those given, and whether its axes are swapped."""
    n = int(group.max(initial=-1)) + 1
    none = np.zeros(0, np.int64)

    def cost(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        _, _, first, end = _incidences(group, np.minimum(a, b), np.maximum(a, b), none, none.astype(float))
        return np.bincount(group, end - first, n)

    swapped = (cost(x0, x1) < cost(y0, y1))[group]
    u0, v0, u1, v1 = np.where(swapped, y0, x0), np.where(swapped, x0, y0), np.where(swapped, y1, x1), np.where(swapped, x1, y1)
    kept = np.flatnonzero(v0 != v1)
    up = v0[kept] < v1[kept]
    ends = [np.where(up, p[kept], q[kept]) for p, q in ((u0, u1), (v0, v1), (u1, u0), (v1, v0))]
    return sweep(group[kept], *ends), kept, swapped


def _entered(s: Slabs, polygon: np.ndarray) -> np.ndarray:
    """+1 where a polygon is entered at an edge of its slab, from left to right, -1 where it is left."""
    n = int(polygon.max(initial=-1)) + 1
    code = s.slab * n + polygon
    order = np.argsort(code, kind="stable")
    c = code[order]
    start = np.flatnonzero(np.append(True, c[1:] != c[:-1])) if len(c) else np.zeros(0, np.int64)
    place = np.arange(len(c)) - np.repeat(start, np.diff(np.append(start, len(c))))
    out = np.empty(len(c), np.int64)
    out[order] = 1 - 2 * (place & 1)
    return out


def _running(s: Slabs, steps: np.ndarray) -> np.ndarray:
    """Sum of ``steps`` up to each edge, within its slab. Every polygon entered in a slab is left in it, so sums end at zero."""
    return np.cumsum(steps)


def _parts(s: Slabs, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Left edge of every part between two neighbours of a slab for which ``inside`` holds, and its area."""
    left = np.flatnonzero(inside[:-1] & (s.slab[1:] == s.slab[:-1]))
    wide = (s.at_low[left + 1] - s.at_low[left] + s.at_high[left + 1] - s.at_high[left]) / 2
    return left, np.maximum(wide, 0.0) * (s.high[left] - s.low[left])


def intersections(left: pa.Array, right: pa.Array, shapes: bool = True) -> tuple[np.ndarray, pa.Array | None]:
    """Area of the intersection of each row's two geometries and, if asked for, its shape: touching parts, counter-clockwise."""
    n = len(left)
    pieces = [edges_of(left), edges_of(right)]
    group = np.concatenate([p[0] for p in pieces])
    side = np.repeat([0, 1], [len(p[0]) for p in pieces])
    s, kept, swapped = _swept(group, *[np.concatenate([p[k] for p in pieces]) for k in range(1, 5)])
    own = side[kept][s.edge]
    step = _entered(s, own)
    both = (_running(s, np.where(own == 0, step, 0)) > 0) & (_running(s, np.where(own == 1, step, 0)) > 0)
    at, area = _parts(s, both)
    of = group[kept][s.edge[at]]
    total = np.bincount(of, area, n).astype(float)  # without any part they are whole numbers
    if not shapes:
        return total, None
    some = area > TOLERANCE * total[of]  # rounding leaves slivers where corners nearly meet
    at, of = at[some], of[some]
    # A part goes on in the next slab if the same two edges bound it: one trapezoid from its first slab to its last.
    first, second = s.edge[at], s.edge[at + 1]
    order = np.lexsort((s.slab[at], second, first))
    at, of, first, second = at[order], of[order], first[order], second[order]
    goes_on = (first[1:] == first[:-1]) & (second[1:] == second[:-1]) & (s.slab[at][1:] == s.slab[at][:-1] + 1)
    start = np.flatnonzero(np.append(True, ~goes_on)) if len(at) else np.zeros(0, np.int64)
    stop = np.append(start[1:], len(at)) - 1 if len(at) else start
    a, z = at[start], at[stop]
    u = np.stack([s.at_low[a], s.at_low[a + 1], s.at_high[z + 1], s.at_high[z], s.at_low[a]], 1)
    v = np.stack([s.low[a], s.low[a], s.high[z], s.high[z], s.low[a]], 1)
    turned = swapped[kept][s.edge[a]]
    x, y = np.where(turned[:, None], v, u), np.where(turned[:, None], u, v)
    x[turned], y[turned] = x[turned, ::-1], y[turned, ::-1]
    order = np.argsort(of[start], kind="stable")
    points = pa.StructArray.from_arrays([pa.array(x[order].ravel()), pa.array(y[order].ravel())], fields=list(POINT))
    rings = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32) * 5), points)
    offsets = np.searchsorted(of[start][order], np.arange(n + 1)).astype(np.int32)
    return total, pa.ListArray.from_arrays(pa.array(offsets), rings).cast(GEOM)


def uncovered_each(children: pa.Array, others: pa.Array, of: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Area of each child between its two heights that none of its others covers; ``of`` is the child of each other."""
    n = len(children)
    pieces = [edges_of(children), edges_of(others)]
    group = np.concatenate((pieces[0][0], of[pieces[1][0]]))
    polygon = np.concatenate((pieces[0][0], pieces[1][0] + n))
    x0, y0, x1, y1 = (np.concatenate([p[k] for p in pieces]) for k in range(1, 5))
    up = y0 < y1
    x0, y0, x1, y1 = np.where(up, x0, x1), np.where(up, y0, y1), np.where(up, x1, x0), np.where(up, y1, y0)
    kept = (y0 != y1) & (y1 > low[group]) & (y0 < high[group])
    group, polygon, x0, y0, x1, y1 = group[kept], polygon[kept], x0[kept], y0[kept], x1[kept], y1[kept]
    bottom, top = low[group], high[group]
    slope = (x1 - x0) / (y1 - y0)
    x0, x1 = np.where(y0 < bottom, x0 + (bottom - y0) * slope, x0), np.where(y1 > top, x1 - (y1 - top) * slope, x1)
    s = sweep(group, x0, np.maximum(y0, bottom), x1, np.minimum(y1, top))
    own = polygon[s.edge]
    step = _entered(s, own)
    bare = (_running(s, np.where(own < n, step, 0)) > 0) & (_running(s, np.where(own >= n, step, 0)) == 0)
    at, area = _parts(s, bare)
    return np.bincount(group[s.edge[at]], area, n).astype(float)  # without any part they are whole numbers


def uncovered(child: pa.Array, others: pa.Array, low: float = -np.inf, high: float = np.inf) -> float:
    """``uncovered_each`` of one geometry (a column of one row)."""
    return float(uncovered_each(child, others, np.zeros(len(others), np.int64), np.array([low]), np.array([high]))[0])
