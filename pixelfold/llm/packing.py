"""Best-fit packing of token sequences into bins with several capacities.

Every document is tokenized and closed with an end id; only longer ones are cut. Pieces
of one length are alike to the packer, so it sees nothing but how many there are of each
length (at most ``capacity`` numbers, whatever the corpus). It takes lengths from the
longest down and puts them into the open bins whose residual vector (tokens, documents,
attention cost) fits best: either the largest weighted dot product of the piece with the
residual, or the smallest weighted norm of what would remain. Bins of equal contents are
handled as one run of bin numbers, so a step places up to a whole run at once. The
result is a list of placements (length, first rank, count, first bin, offset), which the
executors apply to the ranked pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.sizing import materialize
from .bpe import encoder
from .common import batch_of, slices, texts_of

END_ID = 1
PART_ROWS = 20_000


@dataclass(frozen=True)
class Limits:
    """Capacities of a bin: tokens, documents, and attention cost (the sum of squared lengths)."""

    tokens: int = 4096
    documents: int = 4096
    cost: int = 4096 * 4096

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], np.float64)


def pieces_of(docs: DataFrame, path: str, capacity: int, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """One row per piece: key, piece (from 0), start, length, ids_crc32.

    A document is its ids and then ``end_id``; NULL and empty texts are the end id alone.
    Documents of more than ``capacity`` ids become pieces of ``capacity``, the last one shorter.
    """
    schema = pa.schema([("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    close = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, step = encoder(path), 4 * capacity
        for b in slices(batches, "text"):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(enc.encode(texts_of(b.column("text")))):
                ids += close
                for k, s in enumerate(range(0, len(ids), step)):
                    part = ids[s : s + step]
                    row.append(i)
                    piece.append(k)
                    start.append(s // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield batch_of(schema, key=b.column("key").take(pa.array(row, pa.int64())), piece=piece, start=start, length=length, ids_crc32=crc)

    narrow = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    return narrow.mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long").withColumnRenamed("key", key)


def plan_bins(counts: dict[int, int], limits: Limits = Limits(), rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.25, 0.25)) -> np.ndarray:
    """Placements (length, first rank, count, first bin, offset) of ``counts[length]`` pieces each.

    ``rule``: "norm" takes the bin with the smallest weighted residual norm, "dot" the largest weighted dot product.
    A piece that exceeds a capacity by itself is an error.
    """
    cap, w = limits.vector(), np.array(weights)
    # Runs of bins alike: residual vector, first bin, number of bins.
    residual = np.zeros((1024, 3))
    first, many = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
    runs = bins = 0
    placed: list[tuple[int, int, int, int, int]] = []

    def add(r: np.ndarray, at: int, n: int) -> None:
        nonlocal residual, first, many, runs
        if runs == len(first):
            residual, first, many = np.vstack((residual, np.zeros_like(residual))), np.append(first, np.zeros_like(first)), np.append(many, np.zeros_like(many))
        residual[runs], first[runs], many[runs] = r, at, n
        runs += 1

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        need = np.array([length, 1, length * length], np.float64)
        if (need > cap).any():
            raise ValueError(f"a piece of {length} tokens exceeds {limits}")
        while left:
            fits = np.flatnonzero((residual[:runs] >= need).all(1) & (many[:runs] > 0))
            if len(fits):
                if rule == "dot":
                    score = -(residual[fits] / cap * (need / cap) * w).sum(1)
                else:
                    score = ((((residual[fits] - need) / cap) ** 2) * w).sum(1)
                k = fits[np.argmin(score)]
                n = int(min(left, many[k]))
                at, have = int(first[k]), residual[k].copy()
                first[k] += n
                many[k] -= n
            else:
                # New bins, each with as many pieces of this length as every capacity allows.
                each = int(min(cap[0] // need[0], cap[1], cap[2] // need[2]))
                n = max(1, left // each)
                at, have = bins, cap
                bins += n
            placed.append((length, rank, n, at, int(cap[0] - have[0])))
            add(have - need, at, n)
            left, rank = left - n, rank + n
        if runs > 256 and (many[:runs] > 0).sum() * 2 < runs:
            live = np.flatnonzero(many[:runs] > 0)
            residual[: len(live)], first[: len(live)], many[: len(live)] = residual[live], first[live], many[live]
            runs = len(live)
    return np.array(placed, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, limits: Limits = Limits(), key: str = "doc_id", rule: str = "norm") -> DataFrame:
    """``pieces`` (key, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``.

    Repeated rows are pieces of their own; which of several pieces of one length gets which place is arbitrary.
    The pieces are written once with a number each, and a length is ranked in as many parts as it has rows for, about
    ``PART_ROWS`` each, so no task holds a hot length, however large the table. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    numbered = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    # At most ``tokens`` numbers, whatever the corpus; then these and one for every ``PART_ROWS`` rows.
    counts = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}
    parts = [max(1, -(-counts.get(length, 0) // PART_ROWS)) for length in range(limits.tokens + 1)]
    first = np.concatenate(([0], np.cumsum(parts)))
    own = F.get(F.lit(parts), F.col("length").cast("int"))
    salted = numbered.withColumn("_salt", F.pmod(F.xxhash64("_row"), own).cast("int"))
    bases = np.zeros(first[-1], np.int64)
    if any(n > 1 for n in parts):
        for r in salted.groupBy("length", "_salt").count().collect():
            bases[first[r["length"]] + r["_salt"]] = r["count"]
        for length in range(limits.tokens + 1):
            own_part = slice(first[length], first[length + 1])
            bases[own_part] = np.cumsum(bases[own_part]) - bases[own_part]
    plan = plan_bins(counts, limits, rule)
    order = np.lexsort((plan[:, 1], plan[:, 0])) if len(plan) else np.zeros(0, np.int64)
    plan = plan[order]
    shift = 1 << 40
    keys = plan[:, 0] * shift + plan[:, 1]
    shared = spark.sparkContext.broadcast((keys, plan, first, bases))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")) - 1)
    schema = pa.schema([("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, plan, first, bases = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            length = b.column("length").to_numpy()
            rank = b.column("_rank").to_numpy() + bases[first[length] + b.column("_salt").to_numpy()]
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            bin_ = plan[at, 3] + rank - plan[at, 1]
            yield batch_of(schema, **{n: b.column(n) for n in ("key", "piece", "start", "length", "ids_crc32")}, sequence_id=bin_, offset=plan[at, 4])

    out = ranked.select(ranked[key].alias("key"), "piece", "start", "length", "ids_crc32", "_salt", "_rank")
    return out.mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").withColumnRenamed("key", key)


def pack_documents(docs: DataFrame, path: str, limits: Limits = Limits(), key: str = "doc_id", text: str = "text", rule: str = "norm") -> DataFrame:
    """Tokenize, cut and pack whole documents; see ``pieces_of`` and ``pack``."""
    return pack(pieces_of(docs, path, limits.tokens, key, text), limits, key, rule)
