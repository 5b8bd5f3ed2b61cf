"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 4 << 20
#: ASCII white space, the only characters that separate words here: [^\x20\x09-\x0D]+ is a word.
SPACES = "\x20\x09-\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; NULL keys count as the empty text."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "utf-8")) % folds


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of the text column, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = int(total[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def texts_of(column: pa.Array) -> list[str]:
    """Python strings; NULL counts as the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def batch_of(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    """A record batch in the order of ``schema``."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)


def bounded_sample(df: DataFrame, key: Column, most: int, seed: int) -> DataFrame:
    """About ``most`` rows of ``df``, picked by a hash of ``key`` so that a repeated run takes the same ones.

    Takes all rows when there are fewer. One count runs over ``df``; no sort and no limit.
    """
    total = df.count()
    if total <= most:
        return df
    share = most / total
    return df.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
