"""Approximate nearest neighbours along shifted space-filling curves.

Each curve projects the unit vectors onto a few random orthogonal directions, shifts the coordinates at
random and orders them along a Hilbert curve. Sorting by key is a range partitioning; ranks along a
curve cut it into blocks, a query visits the blocks its window of neighbouring ranks touches, and the
best of every window are merged and reranked with the exact measure. Equal vectors are one entry of the index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.sizing import materialize
from .common import batch_of


@dataclass(frozen=True)
class Curves:
    """``curves`` orderings of ``dims`` projected coordinates of ``bits`` bits, which two longs hold: ``dims`` x ``bits`` is 124 at most.

    Coordinates are cut that finely so that near-equal vectors, which share all coarse cells, are ordered by their differences too.
    The window is ``window_factor`` x sqrt(entries) ranks to either side, ``least_window`` at least, and grows with the index.
    """

    curves: int = 36
    dims: int = 8
    bits: int = 14
    window_factor: float = 2.4
    least_window: int = 128
    seed: int = 17

    def window(self, entries: int) -> int:
        return max(self.least_window, math.ceil(self.window_factor * math.sqrt(entries)))


def hilbert_keys(cells: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Place on the Hilbert curve of each row of integer coordinates below 2**bits: its high and its low half."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
    x ^= turn
    halves = []
    for levels in (range(bits - 1, bits // 2 - 1, -1), range(bits // 2 - 1, -1, -1)):
        key = np.zeros(x.shape[1], np.int64)
        for b in levels:
            for i in range(n):
                key = key << 1 | (x[i] >> b) & 1
        halves.append(key)
    return halves[0], halves[1]


def curve_keys(unit: np.ndarray, c: Curves) -> tuple[np.ndarray, np.ndarray]:
    """High and low keys of unit vectors (rows) on every curve (columns)."""
    width = unit.shape[1]
    dims = min(c.dims, width)
    rng = np.random.default_rng(c.seed)
    high, low = (np.empty((len(unit), c.curves), np.int64) for _ in range(2))
    for k in range(c.curves):
        axes = np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dims]
        y = unit @ axes * math.sqrt(width) + rng.uniform(-0.5, 0.5, dims)
        high[:, k], low[:, k] = hilbert_keys(np.clip((y + 2.6) / 5.2 * (1 << c.bits), 0, (1 << c.bits) - 1).astype(np.int64), c.bits)
    return high, low


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """True for vectors with a direction: not NULL or empty, all components finite, one not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def search(vectors: DataFrame, is_query: Column, k: int = 5, c: Curves = Curves(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query the ``k`` nearest found by cosine, ties to the smaller id.

    Vectors that are NULL, empty, zero or hold a NULL or a non-finite component, and rows with a NULL id, take no part. Vectors
    of each length are searched among themselves. Repeated rows count once. A query's own id is no candidate of it; if there are fewer
    candidates than ``k``, all are returned. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v"))).dropDuplicates(["id", "v"])
    rows = materialize(rows.withColumn("uid", F.xxhash64("v")), "vectors")
    lengths = [r[0] for r in rows.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    found = [_search(rows.where(F.size("v") == n), k, c) for n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _search(rows: DataFrame, k: int, c: Curves) -> DataFrame:
    """The search among vectors of one length: id, v, q (asked), uid."""
    # One entry per different vector, with its k + 1 smallest ids: any query's own is among them or not needed.
    smallest = Window.partitionBy("uid", "v").orderBy("id")
    entries = rows.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1)
    asked = rows.where("q").groupBy("uid", "v").agg(F.lit(True).alias("asked"))
    index = entries.where("r = 1").select("uid", "v").join(asked, ["uid", "v"], "left").select("uid", "v", F.coalesce("asked", F.lit(False)).alias("asked"))
    index = materialize(index, "entries")
    n = index.count()
    window = c.window(n)
    block = 4 * window
    keys_schema = pa.schema([("curve", pa.int32()), ("code", pa.int64()), ("fine", pa.int64()), ("uid", pa.int64()), ("asked", pa.bool_())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"))
            codes, fine = curve_keys(x / np.linalg.norm(x, axis=1, keepdims=True), c)
            uid, ask = b.column("uid").to_numpy(), b.column("asked").to_numpy(zero_copy_only=False)
            yield batch_of(keys_schema, curve=np.tile(np.arange(c.curves), len(uid)), code=codes.ravel(), fine=fine.ravel(), uid=np.repeat(uid, c.curves), asked=np.repeat(ask, c.curves))

    codes = index.select("uid", "v", "asked").mapInArrow(keyed, "curve int, code long, fine long, uid long, asked boolean")
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = codes.repartitionByRange(parts, "curve", "code", "fine", "uid").sortWithinPartitions("curve", "code", "fine", "uid")
    place_schema = pa.schema([("curve", pa.int32()), ("uid", pa.int64()), ("asked", pa.bool_()), ("part", pa.int32()), ("at", pa.int64())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for b in batches:
            yield batch_of(place_schema, curve=b.column("curve"), uid=b.column("uid"), asked=b.column("asked"), part=b.column("part"), at=np.arange(at, at + b.num_rows))
            at += b.num_rows

    line = materialize(line.withColumn("part", F.spark_partition_id()).mapInArrow(placed, "curve int, uid long, asked boolean, part int, at long"), "curve_line")
    # One number per partition comes to the driver; all curves have n entries each, so the rank on a curve follows.
    sizes = {r["part"]: r["count"] for r in line.groupBy("part").count().collect()}
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    start = F.element_at(F.create_map(*(F.lit(x) for p in sorted(before.items()) for x in p)), F.col("part"))
    rank = (F.col("at") + start - F.col("curve").cast("long") * n).cast("long")
    ranked = line.select("curve", "uid", "asked", rank.alias("rank"))
    home = F.floor(F.col("rank") / block).cast("long")
    first_visit, last_visit = F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / block).cast("long"), F.floor(F.least(F.col("rank") + window, F.lit(n - 1)) / block).cast("long")
    visits = F.when(F.col("asked"), F.sequence(first_visit, last_visit)).otherwise(F.array(home))
    seats = ranked.select("uid", "curve", "rank", "asked", home.alias("home"), F.explode(visits).alias("block"))
    seats = seats.select("uid", "curve", "rank", "asked", "block", (F.col("home") == F.col("block")).alias("member"))
    full = seats.join(index.select("uid", F.col("v").cast("array<float>").alias("v")), "uid")
    near = k + 3

    def best(table: pa.Table) -> pa.Table:
        x = np.asarray(table.column("v").combine_chunks().flatten(), np.float32).reshape(table.num_rows, -1)
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
        uid, rank = table.column("uid").to_numpy(), table.column("rank").to_numpy()
        member, ask = table.column("member").to_numpy(), table.column("asked").to_numpy()
        inside = np.flatnonzero(member)
        inside = inside[np.argsort(rank[inside])]
        xs, rs = x[inside], rank[inside]
        a, b = [], []
        for i in np.flatnonzero(ask):
            low, high = np.searchsorted(rs, (rank[i] - window, rank[i] + window + 1))
            if low < high:
                s = xs[low:high] @ x[i]
                top = np.argpartition(-s, near)[:near] if len(s) > near else np.arange(len(s))
                b.append(uid[inside[low + top]])
                a.append(np.full(len(top), uid[i]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate(a) if a else none, "b": np.concatenate(b) if b else none})

    # A block holds ``block`` entries and the queries whose windows reach in: bounded by the window, not by the data.
    found = full.groupBy("curve", "block").applyInArrow(best, "a long, b long").distinct()
    pairs = found.join(index.select(F.col("uid").alias("a"), F.col("v").alias("va")), "a").join(index.select(F.col("uid").alias("b"), F.col("v").alias("vb")), "b")
    score_schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("score", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            x, y = _matrix(t.column("va")), _matrix(t.column("vb"))
            cosine = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
            yield batch_of(score_schema, a=t.column("a"), b=t.column("b"), score=cosine)

    scores = pairs.mapInArrow(scored, "a long, b long, score double")
    # Only the best k + 1 entries of a query vector can matter: each brings at least one id.
    order = Window.partitionBy("a").orderBy(F.desc("score"), "least")
    ids = entries.select(F.col("uid").alias("b"), F.col("id").alias("vec_id"))
    least = entries.where("r = 1").select(F.col("uid").alias("b"), F.col("id").alias("least"))
    kept = scores.join(least, "b").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).select("a", "b", "score")
    asking = rows.where("q").select(F.col("uid").alias("a"), F.col("id").alias("query_id"))
    out = asking.join(kept, "a").join(ids, "b").where(F.col("vec_id") != F.col("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
