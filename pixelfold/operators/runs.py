"""Runs of equal keys in a sorted Arrow stream.

One Python call handles all groups of a batch, so many small groups cost no more
than a few large ones. Memory holds one batch and the open group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa


@dataclass
class Groups:
    """Whole groups of a table: ``starts`` are their first row numbers."""

    table: pa.Table
    starts: np.ndarray


def _starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    n = table.num_rows
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for k in keys:
        # Codes compare cheaply and treat two NULLs as equal.
        codes = table[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[Groups]:
    """Complete groups of a partition that is sorted by ``keys``."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if table.num_rows == 0:
            continue
        starts = _starts(table, keys)
        held = table.slice(starts[-1])
        if len(starts) > 1:
            yield Groups(table.slice(0, starts[-1]), starts[:-1])
    if held is not None and held.num_rows:
        yield Groups(held, np.array([0]))
