"""Polygon-polygon joins as equi-joins on a hierarchy of square cells.

Every polygon has a level: the power of two at least as large as its longer
side, so it touches at most four cells of its own level. Two polygons meet at
the coarser of their two levels: one of them is there with its own cells, the
other with the cells of its box at that level. The work therefore follows the
number of pairs that are close at their own scale, whatever mix of sizes the
layers hold. A pair is kept only in the cell that holds the lower-left corner of
the two boxes' intersection, so no de-duplication shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructType

from ..functions import geometry as G, slabs
from ..plans.sizing import BROADCAST_ROWS

MIN_LEVEL, MAX_LEVEL = -30, 40
# A corner is two doubles in a nested array: about 32 bytes.
BROADCAST_CORNERS = 2_000_000
#: Share of a child's area that rounding may leave uncovered.
COVER_SHARE = 1e-9
#: Corners that are swept together: of the pairs of one batch, and of the parents in one band of a child.
SWEPT_CORNERS = 100_000


def _with_box(df: DataFrame, prefix: str) -> DataFrame:
    side = F.greatest(F.col("_b.maxx") - F.col("_b.minx"), F.col("_b.maxy") - F.col("_b.miny"))
    level = F.when(side <= 0, F.lit(MIN_LEVEL)).otherwise(
        F.least(F.greatest(F.ceil(F.log2(side)), F.lit(MIN_LEVEL)), F.lit(MAX_LEVEL))
    )
    return (
        df.withColumn("_b", G.bounds("geom"))
        .withColumn("_level", level.cast("int"))
        .withColumnRenamed("_b", f"{prefix}__b")
        .withColumnRenamed("_level", f"{prefix}__level")
    )


def _levels(df: DataFrame, prefix: str) -> dict[int, tuple[int, int]]:
    """Level -> (polygons, corners): at most MAX_LEVEL - MIN_LEVEL + 1 rows of three numbers."""
    level, geom = f"{prefix}__level", F.col(f"{prefix}__geom")
    corners = F.aggregate(geom, F.lit(0).cast("long"), lambda n, ring: n + F.size(ring))
    found = df.where(F.col(level).isNotNull()).groupBy(level).agg(F.count("*"), F.sum(corners))
    return {r[0]: (r[1], r[2]) for r in sorted(found.collect())}


def _sized(df: DataFrame, own: Mapping[int, tuple[int, int]], levels: Sequence[int] | None = None, strict: bool = False) -> DataFrame:
    """``df``, the rows in cells, marked for a broadcast if the counts per level prove it small.

    A row has four cells at most on each level that it is repeated on (its own without ``levels``).
    Otherwise a sort-merge join is asked for: the planner does not see how far ``explode`` multiplies rows.
    """
    rows = corners = 0
    for level, (n, points) in own.items():
        times = 4 if levels is None else 4 * sum(v > level if strict else v >= level for v in levels)
        rows, corners = rows + n * times, corners + points * times
    return F.broadcast(df) if rows <= BROADCAST_ROWS and corners <= BROADCAST_CORNERS else df.hint("merge")


def _in_cells(df: DataFrame, prefix: str, level: Column) -> DataFrame:
    """One row per cell of the given level that the box touches."""
    size = F.pow(F.lit(2.0), F.col("_l").cast("double"))

    def index(name: str) -> Column:
        return F.floor(F.col(f"{prefix}__b.{name}") / size).cast("long")

    return (
        df.withColumn("_l", level)
        .withColumn("_cx", F.explode(F.sequence(index("minx"), index("maxx"))))
        .withColumn("_cy", F.explode(F.sequence(index("miny"), index("maxy"))))
    )


def _at_coarser(df: DataFrame, prefix: str, levels: Sequence[int], strict: bool) -> DataFrame:
    """Rows repeated at each of ``levels`` that is coarser than their own."""
    own = F.col(f"{prefix}__level")
    chosen = F.filter(
        F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>"),
        lambda v: (v > own) if strict else (v >= own),
    )
    return _in_cells(df, prefix, F.explode(chosen))


def _box_condition(l: str, r: str) -> Column:
    a, b = F.col(f"{l}__b"), F.col(f"{r}__b")
    boxes = (
        (a["minx"] <= b["maxx"])
        & (b["minx"] <= a["maxx"])
        & (a["miny"] <= b["maxy"])
        & (b["miny"] <= a["maxy"])
    )
    size = F.pow(F.lit(2.0), F.col("_l").cast("double"))
    home = (F.floor(F.greatest(a["minx"], b["minx"]) / size) == F.col("_cx")) & (
        F.floor(F.greatest(a["miny"], b["miny"]) / size) == F.col("_cy")
    )
    return boxes & home


def _prefixed(df: DataFrame, p: str, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` renamed with the side's prefix, plus box, level and geometry."""
    boxed = _with_box(df.select(*keep, "geom").where(F.col("geom").isNotNull()), p)
    return boxed.select(
        *[F.col(c).alias(f"{p}_{c}") for c in keep], F.col("geom").alias(f"{p}__geom"), f"{p}__b", f"{p}__level"
    )


def candidate_pairs(
    left: DataFrame, right: DataFrame, left_cols: Sequence[str], right_cols: Sequence[str], exact: Column | None = None
) -> DataFrame:
    """Pairs with meeting boxes that pass ``exact``, once each; columns ``l_*`` and ``r_*``."""
    a, b = _prefixed(left, "l", left_cols), _prefixed(right, "r", right_cols)
    keys = ["_l", "_cx", "_cy"]
    cond = _box_condition("l", "r")
    if exact is not None:
        cond = cond & exact
    a_levels, b_levels = _levels(a, "l"), _levels(b, "r")
    left_coarse = _in_cells(a, "l", F.col("l__level")).join(
        _sized(_at_coarser(b, "r", list(a_levels), strict=False), b_levels, list(a_levels)), keys
    )
    right_coarse = _at_coarser(a, "l", list(b_levels), strict=True).join(
        _sized(_in_cells(b, "r", F.col("r__level")), b_levels), keys
    )
    out = [f"l_{c}" for c in left_cols] + [f"r_{c}" for c in right_cols] + ["l__geom", "r__geom"]
    return left_coarse.where(cond).select(*out).unionByName(right_coarse.where(cond).select(*out))


def sjoin(
    left: DataFrame, right: DataFrame, left_cols: Sequence[str], right_cols: Sequence[str]
) -> DataFrame:
    """Inner join on intersects, one row per matching pair."""
    pairs = candidate_pairs(left, right, left_cols, right_cols, G.intersects("l__geom", "r__geom"))
    return pairs.drop("l__geom", "r__geom")


def keep_intersecting(
    left: DataFrame, right: DataFrame, key: str, anti: bool = False
) -> DataFrame:
    """Rows of ``left`` that intersect any row of ``right`` (or none, with ``anti``).

    Copies of one reference polygon are folded first, and the match is a
    semi-join: no pair is ever emitted.
    """
    ref = right.select("geom").dropDuplicates(["geom"])
    a, b = _prefixed(left, "l", [key]), _prefixed(ref, "r", [])
    keys = ["_l", "_cx", "_cy"]
    exact = G.intersects("l__geom", "r__geom")
    a_levels, b_levels = _levels(a, "l"), _levels(b, "r")

    def matched(x: DataFrame, y: DataFrame) -> DataFrame:
        y = y.select(*[F.col(k).alias(f"y{k}") for k in keys], "r__b", "r__geom")
        on = F.lit(True)
        for k in keys:
            on = on & (F.col(k) == F.col(f"y{k}"))
        a_, b_ = F.col("l__b"), F.col("r__b")
        near = (
            (a_["minx"] <= b_["maxx"]) & (b_["minx"] <= a_["maxx"]) & (a_["miny"] <= b_["maxy"]) & (b_["miny"] <= a_["maxy"])
        )
        return x.join(y, on & near & exact, "left_semi").select(f"l_{key}")

    b_coarse = _sized(_at_coarser(b, "r", list(a_levels), strict=False), b_levels, list(a_levels))
    b_own = _sized(_in_cells(b, "r", F.col("r__level")), b_levels)
    hits = matched(_in_cells(a, "l", F.col("l__level")), b_coarse).unionByName(
        matched(_at_coarser(a, "l", list(b_levels), strict=True), b_own)
    )
    hits = hits.distinct().withColumnRenamed(f"l_{key}", key)
    return left.join(hits, key, "left_anti" if anti else "left_semi")


def _swept(pairs: DataFrame, ids: Sequence[str], shapes: bool) -> DataFrame:
    """``ids``, area and (with ``shapes``) geom of the intersection of ``l__geom`` and ``r__geom``, for pairs that have an area in common.

    Sweeping costs far more than moving a pair, so pairs of one crowded cell are spread first.
    """
    fields = [f for f in pairs.schema.fields if f.name in ids]
    schema = StructType(list(fields)).add("area", DoubleType())
    schema = schema.add("geom", pairs.schema["l__geom"].dataType) if shapes else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.zeros(b.num_rows, np.int64)
            for side in ("l__geom", "r__geom"):
                sizes += np.bincount(slabs.edges_of(b.column(side))[0], minlength=b.num_rows)
            part = np.cumsum(sizes) // SWEPT_CORNERS
            for start, end in zip(*_runs(part)):
                own = b.slice(start, end - start)
                area, geom = slabs.intersections(own.column("l__geom"), own.column("r__geom"), shapes)
                columns = [own.column(f.name) for f in fields] + [pa.array(area)] + ([geom] if shapes else [])
                yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(area > 0))

    return pairs.repartition(*ids).mapInArrow(run, schema)


def _runs(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal values."""
    if not len(part):
        return part, part
    start = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    return start, np.append(start[1:], len(part))


def overlay_intersection(
    left: DataFrame, right: DataFrame, left_cols: Sequence[str], right_cols: Sequence[str]
) -> DataFrame:
    """Intersection pieces of two layers with the suffixes _1 and _2.

    Polygons of any shape may stand on both sides; many pairs are swept together, in time that follows their corners and
    crossings. A piece is made of touching trapezoids, counter-clockwise. A pair without a common area is dropped.
    """
    pairs = candidate_pairs(left, right, left_cols, right_cols)
    cut = _swept(pairs, [f"l_{c}" for c in left_cols] + [f"r_{c}" for c in right_cols], True)
    return cut.select(
        *[F.col(f"l_{c}").alias(f"{c}_1") for c in left_cols],
        *[F.col(f"r_{c}").alias(f"{c}_2") for c in right_cols],
        "geom",
        "area",
    )


def children_per_parent(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Number of child pieces in each parent that has any; areas only, no shape is made."""
    pairs = candidate_pairs(children, parents, [child_key], [parent_key])
    pieces = _swept(pairs, [f"l_{child_key}", f"r_{parent_key}"], False)
    return pieces.groupBy(F.col(f"r_{parent_key}").alias(parent_key)).agg(F.count("*").alias("children"))


def within(children: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """(key, parent_key) where the child lies in one parent, border included.

    Corners decide for a convex parent; for any other the child's edges are tested
    piece by piece, and no corner of the parent (of a hole) may lie inside the child."""
    corners = F.forall(F.flatten("l__geom"), lambda p: G.covers_point(p["x"], p["y"], F.col("r__geom")))
    convex = (F.size("r__geom") == 1) & G.is_convex_ring(F.col("r__geom")[0])
    pairs = candidate_pairs(children, parents, [key], [parent_key], corners & (convex | G.within("l__geom", "r__geom")))
    return pairs.select(F.col(f"l_{key}").alias(key), F.col(f"r_{parent_key}").alias(parent_key))


def within_union(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children that the parents cover together, borders included, whatever the parents' shapes and overlaps.

    A child is swept together with the parents that meet its box; no part of it may lie in none of them (but for a
    rounding share of ``COVER_SHARE`` of its area, so gaps and holes count, whatever overlaps elsewhere). ``key`` names one child. Many
    children are swept in one pass over arrays. One with many parents is cut into bands of about ``SWEPT_CORNERS`` corners, dealt out by themselves. A child without an
    area (a line) counts as covered if all its corners are.
    """
    flat = children.where(G.area("geom") <= 0).select(key, F.array_distinct(F.flatten("geom")).alias("_p"))
    points = flat.select(key, F.size("_p").alias("_all"), F.posexplode("_p").alias("_i", "_p")).select(key, "_all", "_i", F.array(F.array("_p", "_p")).alias("geom"))
    at = F.col("l__geom")[0][0]
    hits = candidate_pairs(points, parents, [key, "_all", "_i"], [], G.covers_point(at["x"], at["y"], F.col("r__geom")))
    lines = hits.groupBy(F.col(f"l_{key}").alias(key), F.col("l__all").alias("_all")).agg(F.count_distinct("l__i").alias("_n")).where("_n = _all").select(key)

    box, area = G.bounds("geom"), G.area("geom")
    shown = children.where(F.col(key).isNotNull()).where(area > 0).select(key, "geom", box["miny"].alias("_y0"), box["maxy"].alias("_y1"), (area * F.lit(COVER_SHARE)).alias("_share"))
    corners = F.aggregate("r__geom", F.lit(0).cast("long"), lambda n, ring: n + F.size(ring))
    names = [key, "_y0", "_y1", "_share"]
    met = candidate_pairs(shown, parents, names, []).select(*[F.col(f"l_{c}").alias(c) for c in names], F.col("r__geom").alias("geom"), corners.alias("_corners"), F.lit(True).alias("_other"))
    every = shown.withColumns({"_corners": F.lit(0).cast("long"), "_other": F.lit(False)}).unionByName(met)
    of_child = Window.partitionBy(key)
    every = every.withColumn("_n", F.greatest(F.ceil(F.sum("_corners").over(of_child) / SWEPT_CORNERS), F.lit(1)).cast("int"))

    def band(y: Column) -> Column:
        at = F.floor((y - F.col("_y0")) / (F.col("_y1") - F.col("_y0")) * F.col("_n")).cast("int")
        return F.least(F.greatest(at, F.lit(0)), F.col("_n") - 1)

    bands = F.when(F.col("_n") == 1, F.array(F.lit(0))).when(F.col("_other"), F.sequence(band(box["miny"]), band(box["maxy"]))).otherwise(F.sequence(F.lit(0), F.col("_n") - 1))
    # Of the rows of one band the child comes first.
    line = every.withColumn("_band", F.explode(bands)).drop("_corners").repartition(key, "_band").sortWithinPartitions(key, "_band", "_other")
    left = line.mapInArrow(_bare_parts(key), StructType([line.schema[key], line.schema["_share"]]).add("_bare", DoubleType()))
    whole = left.groupBy(key).agg(F.sum("_bare").alias("_bare"), F.max("_share").alias("_share")).where("_bare <= _share").select(key)
    return children.join(whole.unionByName(lines), key, "left_semi")


def _bare_parts(key: str):
    """Rows of children and their parents, band by band, to (key, share, uncovered area): many bands are swept together."""

    def measured(b: pa.RecordBatch, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        of = np.repeat(np.arange(len(at)), np.diff(np.append(at, b.num_rows)))
        sizes = np.bincount(of[slabs.edges_of(b.column("geom"))[0]], minlength=len(at))
        other = b.column("_other").to_numpy(zero_copy_only=False)
        ends = np.append(at, b.num_rows)
        for start, end in zip(*_runs(np.cumsum(sizes) // SWEPT_CORNERS)):
            first, rows = b.take(pa.array(at[start:end])), np.arange(ends[start], ends[end])
            rows = rows[other[rows]]
            y0, y1, n, place = (first.column(c).to_numpy() for c in ("_y0", "_y1", "_n", "_band"))
            step = (y1 - y0) / n
            high = np.where(place == n - 1, y1, y0 + (place + 1) * step)
            bare = slabs.uncovered_each(first.column("geom"), b.column("geom").take(pa.array(rows)), of[rows] - start, y0 + place * step, high)
            yield pa.RecordBatch.from_arrays([first.column(key), first.column("_share"), pa.array(bare)], names=[key, "_share", "_bare"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for b in batches:
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            new = np.arange(b.num_rows) == 0
            for c in (b.column(key), b.column("_band")):
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, max(len(c) - 1, 0))).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(new)
            if len(at):
                yield from measured(b.slice(0, at[-1]), at[:-1])
                held = b.slice(at[-1])
        if held is not None:
            yield from measured(held, np.zeros(1, np.int64))

    return run
