"""Polygon functions on coordinate arrays.

A geometry is ``ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>``: closed rings,
shells counter-clockwise and holes clockwise (``orient`` brings shell/hole lists
into that form). All functions are higher-order Column expressions: no Python
runs per row and no geometry library is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GEOM_DDL = "array<array<struct<x:double,y:double>>>"
ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _struct(**members: Column) -> Column:
    """Struct with explicit names, which survive every rewrite of the analyzer."""
    return F.named_struct(*[v for name, c in members.items() for v in (F.lit(name), c)])


def _pt(x: Column, y: Column) -> Column:
    return _struct(x=x, y=y)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once; a plain Python call would
    repeat the expression at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rect(minx: ColumnLike, miny: ColumnLike, maxx: ColumnLike, maxy: ColumnLike) -> Column:
    """Closed counter-clockwise rectangle as a one-ring geometry."""
    x0, y0, x1, y1 = (_c(v).cast("double") for v in (minx, miny, maxx, maxy))
    return F.array(F.array(_pt(x0, y0), _pt(x1, y0), _pt(x1, y1), _pt(x0, y1), _pt(x0, y0)))


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, 1, n),
        F.slice(ring, 2, n),
        lambda a, b: _struct(xa=a["x"], ya=a["y"], xb=b["x"], yb=b["y"]),
    )


def edges(geom: ColumnLike) -> Column:
    """All edges of all rings."""
    return F.flatten(F.transform(_c(geom), ring_edges))


def bounds(geom: ColumnLike) -> Column:
    """STRUCT(minx, miny, maxx, maxy)."""
    pts = F.flatten(_c(geom))
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return _struct(minx=F.array_min(xs), miny=F.array_min(ys), maxx=F.array_max(xs), maxy=F.array_max(ys))


def bounds_geom(bbox: Column) -> Column:
    """Footprint rectangle of a bbox struct or of [minx, miny, maxx, maxy]."""
    return rect(bbox["minx"], bbox["miny"], bbox["maxx"], bbox["maxy"])


def ring_signed_area(ring: ColumnLike) -> Column:
    """Shoelace area; positive for counter-clockwise rings."""
    return F.aggregate(
        ring_edges(_c(ring)),
        F.lit(0.0),
        lambda s, e: s + e["xa"] * e["yb"] - e["xb"] * e["ya"],
        lambda s: s / F.lit(2.0),
    )


def ring_area(ring: ColumnLike) -> Column:
    return F.abs(ring_signed_area(ring))


def area(geom: ColumnLike) -> Column:
    """Area of an oriented geometry: shells count plus, holes minus."""
    return F.abs(
        F.aggregate(
            edges(geom),
            F.lit(0.0),
            lambda s, e: s + e["xa"] * e["yb"] - e["xb"] * e["ya"],
            lambda s: s / F.lit(2.0),
        )
    )


def centroid(geom: ColumnLike) -> Column:
    """Area centroid STRUCT(x, y); NULL members for a zero-area geometry."""
    acc0 = _struct(a=F.lit(0.0), x=F.lit(0.0), y=F.lit(0.0))

    def step(s: Column, e: Column) -> Column:
        cross = e["xa"] * e["yb"] - e["xb"] * e["ya"]
        return _struct(
            a=s["a"] + cross,
            x=s["x"] + (e["xa"] + e["xb"]) * cross,
            y=s["y"] + (e["ya"] + e["yb"]) * cross,
        )

    return F.aggregate(
        edges(geom),
        acc0,
        step,
        lambda s: _pt(
            F.try_divide(s["x"], F.lit(3.0) * s["a"]), F.try_divide(s["y"], F.lit(3.0) * s["a"])
        ),
    )


def ring_centroid(ring: ColumnLike) -> Column:
    return centroid(F.array(_c(ring)))


def orient(geom: ColumnLike, first_is_shell: bool = True) -> Column:
    """Shell counter-clockwise, the other rings (holes) clockwise."""

    def fix(ring: Column, i: Column) -> Column:
        want_ccw = (i == 0) if first_is_shell else F.lit(True)
        return F.when((ring_signed_area(ring) >= 0) == want_ccw, ring).otherwise(F.reverse(ring))

    return F.transform(_c(geom), fix)


def point_in_polygon(x: Column, y: Column, geom: ColumnLike) -> Column:
    """Even-odd test with the half-open rule of the rasteriser: a point on a
    left or bottom border is inside, on a right or top border outside."""
    crossing = F.filter(
        edges(geom),
        lambda e: ((e["ya"] <= y) != (e["yb"] <= y))
        & (F.try_divide((y - e["ya"]) * (e["xb"] - e["xa"]), e["yb"] - e["ya"]) + e["xa"] <= x),
    )
    return F.size(crossing) % 2 == 1


def covers_point(x: Column, y: Column, geom: ColumnLike) -> Column:
    """Point inside the polygon or on its border."""

    def on_edge(e: Column) -> Column:
        cross = (e["xb"] - e["xa"]) * (y - e["ya"]) - (e["yb"] - e["ya"]) * (x - e["xa"])
        return (
            (cross == 0)
            & x.between(F.least(e["xa"], e["xb"]), F.greatest(e["xa"], e["xb"]))
            & y.between(F.least(e["ya"], e["yb"]), F.greatest(e["ya"], e["yb"]))
        )

    return point_in_polygon(x, y, geom) | F.exists(edges(geom), on_edge)


def _segments_meet(e: Column, f: Column) -> Column:
    def side(o: Column, px: Column, py: Column) -> Column:
        return F.signum((o["xb"] - o["xa"]) * (py - o["ya"]) - (o["yb"] - o["ya"]) * (px - o["xa"]))

    boxes = (
        (F.greatest(e["xa"], e["xb"]) >= F.least(f["xa"], f["xb"]))
        & (F.greatest(f["xa"], f["xb"]) >= F.least(e["xa"], e["xb"]))
        & (F.greatest(e["ya"], e["yb"]) >= F.least(f["ya"], f["yb"]))
        & (F.greatest(f["ya"], f["yb"]) >= F.least(e["ya"], e["yb"]))
    )
    return (
        boxes
        & (side(e, f["xa"], f["ya"]) * side(e, f["xb"], f["yb"]) <= 0)
        & (side(f, e["xa"], e["ya"]) * side(f, e["xb"], e["yb"]) <= 0)
    )


def intersects(g1: ColumnLike, g2: ColumnLike) -> Column:
    """True when the polygons share at least one point, borders included."""
    g1, g2 = _c(g1), _c(g2)
    borders = _let(
        edges(g2), lambda e2: F.exists(edges(g1), lambda e: F.exists(e2, lambda f: _segments_meet(e, f)))
    )


    def part_inside(g: Column, other: Column) -> Column:
        # Without meeting borders a ring lies wholly inside or outside: one corner of each decides.
        return F.exists(g, lambda ring: covers_point(ring[0]["x"], ring[0]["y"], other))

    return borders | part_inside(g1, g2) | part_inside(g2, g1)


def _contacts(e: Column, others: Column) -> Column:
    """Ascending places 0..1 along edge e: both ends and every contact with the other edges."""
    dx, dy = e["xb"] - e["xa"], e["yb"] - e["ya"]

    def places(f: Column) -> Column:
        fx, fy = f["xb"] - f["xa"], f["yb"] - f["ya"]
        gx, gy = f["xa"] - e["xa"], f["ya"] - e["ya"]
        cross = dx * fy - dy * fx
        # On one line: the ends of the other edge, projected.
        along = lambda px, py: F.try_divide((px - e["xa"]) * dx + (py - e["ya"]) * dy, dx * dx + dy * dy)
        return F.when(cross != 0, F.array(F.try_divide(gx * fy - gy * fx, cross))).otherwise(
            F.array(along(f["xa"], f["ya"]), along(f["xb"], f["yb"]))
        )

    found = F.filter(F.flatten(F.transform(others, places)), lambda t: (t > 0) & (t < 1))
    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0)), found, F.array(F.lit(1.0)))))


def within(inner: ColumnLike, outer: ColumnLike) -> Column:
    """True when ``inner`` lies in ``outer``, borders included, whatever their shapes.

    Every edge of ``inner`` is cut where it meets a line of ``outer``'s edges and the middle of
    each part must be covered; a hole of ``outer`` may not have a corner strictly inside ``inner``.
    A hole whose corners all lie on the border of ``inner`` is not noticed.
    """
    inner, outer = _c(inner), _c(outer)

    def covered(e: Column) -> Column:
        def middles(t: Column) -> Column:
            return F.zip_with(F.slice(t, 1, F.size(t) - 1), F.slice(t, 2, F.size(t) - 1), lambda a, b: (a + b) / F.lit(2.0))

        return F.forall(
            _let(_contacts(e, edges(outer)), middles),
            lambda m: covers_point(e["xa"] + m * (e["xb"] - e["xa"]), e["ya"] + m * (e["yb"] - e["ya"]), outer),
        )

    def strictly_inside(p: Column) -> Column:
        touches = F.exists(edges(inner), lambda e: _segments_meet(e, _struct(xa=p["x"], ya=p["y"], xb=p["x"], yb=p["y"])))
        return point_in_polygon(p["x"], p["y"], inner) & ~touches

    return F.forall(edges(inner), covered) & ~F.exists(F.flatten(outer), strictly_inside)


def is_convex_ring(ring: ColumnLike) -> Column:
    """No turn to both sides along the ring."""

    def turns(es: Column) -> Column:
        following = F.concat(F.slice(es, 2, F.greatest(F.size(es) - 1, F.lit(0))), F.slice(es, 1, 1))
        return F.zip_with(
            es,
            following,
            lambda e, f: F.signum(
                (e["xb"] - e["xa"]) * (f["yb"] - f["ya"]) - (e["yb"] - e["ya"]) * (f["xb"] - f["xa"])
            ),
        )

    signs = _let(ring_edges(_c(ring)), turns)
    return ~_let(signs, lambda t: F.array_contains(t, 1.0) & F.array_contains(t, -1.0))


def _clip_by_line(ring: Column, e: Column) -> Column:
    """Part of a closed ring to the left of the directed line of edge e."""
    dx, dy = e["xb"] - e["xa"], e["yb"] - e["ya"]

    def side(px: Column, py: Column) -> Column:
        return dx * (py - e["ya"]) - dy * (px - e["xa"])

    def piece(s: Column) -> Column:
        end = _pt(s["xb"], s["yb"])

        def kept(d: Column) -> Column:
            t = F.try_divide(d["a"], d["a"] - d["b"])
            cut = _pt(s["xa"] + t * (s["xb"] - s["xa"]), s["ya"] + t * (s["yb"] - s["ya"]))
            return (
                F.when((d["a"] >= 0) & (d["b"] >= 0), F.array(end))
                .when(d["a"] >= 0, F.array(cut))
                .when(d["b"] >= 0, F.array(cut, end))
                .otherwise(F.slice(F.array(end), 1, 0))
            )

        return _let(_struct(a=side(s["xa"], s["ya"]), b=side(s["xb"], s["yb"])), kept)

    open_ring = F.flatten(F.transform(ring_edges(ring), piece))
    return _let(open_ring, lambda points: F.concat(points, F.slice(points, 1, 1)))


def clip_to_convex(geom: ColumnLike, clip_ring: ColumnLike) -> Column:
    """Geometry cut to a convex counter-clockwise ring; empty rings dropped.

    The rings are clipped one by one, so holes stay holes. A ring that does not
    survive (fewer than three corners) is removed.
    """
    cut = _let(
        ring_edges(_c(clip_ring)),
        lambda clip: F.transform(_c(geom), lambda ring: F.aggregate(clip, ring, _clip_by_line)),
    )
    return F.filter(cut, lambda r: F.size(r) > 3)


def clip_with_area(geom: ColumnLike, clip_ring: ColumnLike) -> Column:
    """STRUCT(geom, area) of the clipped geometry, computed once."""
    return _let(clip_to_convex(geom, clip_ring), lambda g: _struct(geom=g, area=area(g)))


def _trapezoids(geom: Column) -> Column:
    """Counter-clockwise trapezoids that fill a geometry of any shape: cut at the height of every corner,
    then between the odd and the even borders from left to right."""

    def at(e: Column, y: Column) -> Column:
        along = e["xa"] + F.try_divide((y - e["ya"]) * (e["xb"] - e["xa"]), e["yb"] - e["ya"])
        return F.when(e["ya"] == y, e["xa"]).when(e["yb"] == y, e["xb"]).otherwise(along)

    def between(es: Column, lo: Column, hi: Column) -> Column:
        crossing = F.filter(es, lambda e: (F.least(e["ya"], e["yb"]) <= lo) & (F.greatest(e["ya"], e["yb"]) >= hi))
        borders = F.array_sort(F.transform(crossing, lambda e: _struct(m=at(e, lo) + at(e, hi), u=at(e, lo), v=at(e, hi))))

        def ring(a: Column, b: Column) -> Column:
            first = _pt(a["u"], lo)
            return F.array(first, _pt(b["u"], lo), _pt(b["v"], hi), _pt(a["v"], hi), first)

        return _let(
            borders, lambda s: F.transform(F.filter(s, lambda _, i: i % 2 == 0), lambda a, k: ring(a, F.get(s, k * 2 + 1)))
        )

    def slabs(ys: Column) -> Column:
        n = F.greatest(F.size(ys) - 1, F.lit(0))
        return _let(edges(geom), lambda es: F.flatten(F.zip_with(F.slice(ys, 1, n), F.slice(ys, 2, n), lambda lo, hi: between(es, lo, hi))))

    return _let(F.array_sort(F.array_distinct(F.transform(F.flatten(geom), lambda p: p["y"]))), slabs)


def convex_pieces(geom: ColumnLike) -> Column:
    """Convex counter-clockwise rings that fill the geometry without overlap: itself, or its trapezoids."""
    g = _c(geom)
    return F.when((F.size(g) == 1) & is_convex_ring(g[0]), F.array(orient(g)[0])).otherwise(_trapezoids(g))


def clip_to_pieces(geom: ColumnLike, pieces: ColumnLike) -> Column:
    """STRUCT(geom, area) of the geometry cut to each convex ring; the cuts with an area are put together."""
    cuts = F.filter(F.transform(_c(pieces), lambda ring: clip_with_area(geom, ring)), lambda s: s["area"] > 0)
    return _let(
        cuts,
        lambda c: _struct(
            geom=F.flatten(F.transform(c, lambda s: s["geom"])), area=F.aggregate(c, F.lit(0.0), lambda a, s: a + s["area"])
        ),
    )


def edge_slabs(edge_list: Column, y0: Column, y1: Column) -> Column:
    """Edges cut to the horizontal slab [y0, y1]: STRUCT(u, v, s) with the smaller
    and larger x and the signed height (minus for upward edges). Edges outside the
    slab and horizontal ones are dropped: they have no height in it."""

    def slab(e: Column) -> Column:
        down = e["yb"] < e["ya"]
        slope = F.try_divide(e["xb"] - e["xa"], e["yb"] - e["ya"])

        def ends(d: Column) -> Column:
            a, b = e["xa"] + slope * (d["lo"] - e["ya"]), e["xa"] + slope * (d["hi"] - e["ya"])
            height = d["hi"] - d["lo"]
            return _struct(u=F.least(a, b), v=F.greatest(a, b), s=F.when(down, height).otherwise(-height))

        lo = F.greatest(F.least(e["ya"], e["yb"]), y0)
        hi = F.least(F.greatest(e["ya"], e["yb"]), y1)
        return _let(_struct(lo=lo, hi=hi), ends)

    crossing = F.filter(
        edge_list,
        lambda e: (e["ya"] != e["yb"]) & (F.least(e["ya"], e["yb"]) < y1) & (F.greatest(e["ya"], e["yb"]) > y0),
    )
    return F.transform(crossing, slab)


def slab_area(slabs: Column, x0: Column, x1: Column) -> Column:
    """Exact area of an oriented polygon between x0 and x1 in the slab of ``slabs``.

    Green's theorem by rows: each edge adds its signed height times the mean of the
    distance from x0, clamped to the width. Concave rings and holes need no special
    case because opposite edges cancel.
    """
    w = x1 - x0

    def clamp(v: Column) -> Column:
        return F.least(F.greatest(v, F.lit(0.0)), w)

    def term(e: Column) -> Column:
        def mean(d: Column) -> Column:
            inside = (d["chi"] - d["clo"]) * (d["chi"] + d["clo"]) / F.lit(2.0)
            beyond = w * (F.greatest(d["hi"], w) - F.greatest(d["lo"], w))
            return F.coalesce(F.try_divide(inside + beyond, d["hi"] - d["lo"]), d["clo"])

        lo, hi = e["u"] - x0, e["v"] - x0
        sloped = _let(_struct(lo=lo, hi=hi, clo=clamp(lo), chi=clamp(hi)), mean)
        # Edges wholly to one side of the cell are the common case.
        return e["s"] * F.when(e["u"] >= x1, w).when(e["v"] <= x0, F.lit(0.0)).otherwise(sloped)

    return F.abs(F.aggregate(slabs, F.lit(0.0), lambda total, e: total + term(e)))


# ---- text formats ----------------------------------------------------------

def wkt_to_geom(wkt: ColumnLike) -> Column:
    """POLYGON / MULTIPOLYGON text to oriented rings."""
    s = F.regexp_replace(F.trim(_c(wkt)), r"^[A-Za-z ]+", "")
    s = F.regexp_replace(s, r"\s*([(),])\s*", "$1")

    def point(p: Column) -> Column:
        xy = F.split(p, r"\s+")
        return _pt(F.element_at(xy, 1).cast("double"), F.element_at(xy, 2).cast("double"))

    def polygon(body: Column) -> Column:
        rings = F.split(body, r"\),\(")
        parsed = F.transform(rings, lambda r: F.transform(F.split(r, ","), point))
        return orient(parsed)

    is_multi = F.upper(F.trim(_c(wkt))).startswith("MULTI")
    polys = F.when(is_multi, F.split(F.regexp_replace(s, r"^\(\(\(|\)\)\)$", ""), r"\)\),\(\(")).otherwise(
        F.array(F.regexp_replace(s, r"^\(\(|\)\)$", ""))
    )
    return F.flatten(F.transform(polys, polygon))


def parts(geom: ColumnLike, shown, kind: str) -> Column:
    """Rings of each part as one array: a counter-clockwise ring opens a part, its holes follow.

    ``shown`` turns a ring into a value of the SQL type ``kind``."""
    none = F.array().cast(f"array<array<{kind}>>")

    def add(done: Column, ring: Column) -> Column:
        own = F.array(shown(ring))
        hole = (ring_signed_area(ring) < 0) & (F.size(done) > 0)
        last = F.concat(F.element_at(done, -1), own)
        return F.when(hole, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(last))).otherwise(F.concat(done, F.array(own)))

    return F.aggregate(_c(geom), none, add)


def geom_to_wkt(geom: ColumnLike) -> Column:
    """POLYGON text, MULTIPOLYGON with more than one part."""
    ring = lambda r: F.concat(
        F.lit("("),
        F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "),
        F.lit(")"),
    )
    bodies = F.transform(parts(geom, ring, "string"), lambda p: F.concat(F.lit("("), F.array_join(p, ", "), F.lit(")")))

    def text(b: Column) -> Column:
        many = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(b, ", "), F.lit(")"))
        return F.when(F.size(b) > 1, many).otherwise(F.concat(F.lit("POLYGON "), F.coalesce(F.get(b, F.lit(0)), F.lit("()"))))

    return _let(bodies, text)


def geom_to_coordinates(geom: ColumnLike) -> Column:
    """Rings as nested [x, y] arrays, the coordinate member of a GeoJSON polygon."""
    return F.transform(_c(geom), lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))


def geom_to_part_coordinates(geom: ColumnLike) -> Column:
    """Parts as nested rings, the coordinate member of a GeoJSON multi-polygon."""
    return parts(geom, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])), "array<array<double>>")


def map_points(geom: ColumnLike, fn) -> Column:
    """Apply ``fn(x, y) -> (x', y')`` to every vertex."""
    return F.transform(_c(geom), lambda r: F.transform(r, lambda p: _pt(*fn(p["x"], p["y"]))))
