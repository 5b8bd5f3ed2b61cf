"""User statistics as mergeable states, for groups of any size.

Each input part folds its rows to one state a group in Arrow batches, and only states travel: first to one of
``SPREAD`` helpers of their group, then to the group's last task. A zone with half of all pixels costs a task
no more than its own share of the rows, and at the end one state of every helper.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

#: Helpers that merge the states of one group before its last task does.
SPREAD = 64
#: Groups a task holds before it sends their states on and starts afresh.
OPEN_GROUPS = 50_000


@dataclass(frozen=True)
class UserAggregate:
    """A state is a one-dimensional array of doubles; ``merge`` must not depend on the order of its states.

    ``update(state, values)`` takes the non-null values of one group in one batch.
    """

    init: Callable[[], np.ndarray]
    update: Callable[[np.ndarray, np.ndarray], np.ndarray]
    merge: Callable[[np.ndarray, np.ndarray], np.ndarray]
    finish: Callable[[np.ndarray], float]


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Key tuple and row numbers of every group of a batch; NULL keys are keys like any other."""
    codes = np.zeros(batch.num_rows, dtype=np.int64)
    for k in keys:
        own = batch.column(k).dictionary_encode(null_encoding="encode")
        codes = np.unique(codes * max(len(own.dictionary), 1) + own.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
        yield tuple(batch.column(k)[int(rows[0])].as_py() for k in keys), rows


def aggregate_by(df: DataFrame, keys: Sequence[str], value: str, agg: UserAggregate, name: str) -> DataFrame:
    """keys, name: the statistic of the non-null values of ``value`` in each group.

    A group without values has no row; a result that is not a number becomes NULL.
    """
    keys = list(keys)
    source = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    key_fields = [source.schema[k] for k in keys]
    part = T.StructType([*key_fields, T.StructField("_helper", T.IntegerType()), T.StructField("_state", T.ArrayType(T.DoubleType()))])

    def frame(like: pa.Schema, rows: list[tuple[tuple, object]], **last: pa.Array) -> pa.RecordBatch:
        cols = {k: pa.array([r[0][i] for r in rows], like.field(k).type) for i, k in enumerate(keys)}
        return pa.RecordBatch.from_pydict(cols | last)

    def states(like: pa.Schema, rows: list[tuple[tuple, np.ndarray]], helper: int) -> pa.RecordBatch:
        held = pa.array([np.asarray(s, dtype=float) for _, s in rows], pa.list_(pa.float64()))
        return frame(like, rows, _helper=pa.array([helper] * len(rows), pa.int32()), _state=held)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        helper, held, like = TaskContext.get().partitionId() % SPREAD, {}, None
        for b in batches:
            like, values = b.schema, b.column("_v").to_numpy()
            for key, rows in _groups(b, keys):
                held[key] = agg.update(held[key] if key in held else agg.init(), values[rows])
            if len(held) > OPEN_GROUPS:
                yield states(like, list(held.items()), helper)
                held = {}
        if held:
            yield states(like, list(held.items()), helper)

    def merged(batches: Iterator[pa.RecordBatch], done: Callable[[pa.Schema, list], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams sorted states: memory holds a batch and one state."""
        now, state, like = None, None, None
        for b in batches:
            like, out = b.schema, []
            for *key, s in zip(*(b.column(k).to_pylist() for k in keys), b.column("_state").to_pylist()):
                if state is not None and tuple(key) == now:
                    state = agg.merge(state, np.array(s))
                    continue
                if state is not None:
                    out.append((now, state))
                now, state = tuple(key), np.array(s)
            if out:
                yield done(like, out)
        if state is not None:
            yield done(like, [(now, state)])

    def finished(like: pa.Schema, rows: list[tuple[tuple, np.ndarray]]) -> pa.RecordBatch:
        results = [float(agg.finish(s)) for _, s in rows]
        return frame(like, rows, **{name: pa.array([None if r != r else r for r in results], pa.float64())})

    parts = source.mapInArrow(fold, part)
    # A group's states lie together in a helper's partition, for it is sorted by the keys.
    first = parts.repartition(*keys, "_helper").sortWithinPartitions(*keys)
    helped = first.mapInArrow(lambda bs: merged(bs, lambda like, rows: states(like, rows, 0)), part)
    last = helped.repartition(*keys).sortWithinPartitions(*keys)
    return last.mapInArrow(lambda bs: merged(bs, finished), T.StructType([*key_fields, T.StructField(name, T.DoubleType())]))
