"""Overview pyramids: coarser levels written once, so that a coarse read never touches the full raster.

Level ``n`` is made from the level below it and holds, for each cell of ``2**n`` source cells a side, the value
of its first source cell and the sum and number of its valid values. A read with factor ``k`` opens the coarsest level that
divides ``k`` and folds what is left of the factor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

CELL = ["row", "col"]


def _half(level: DataFrame, by: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """The next level; rows are combined map-side, four to one."""
    first = (F.col("row") % 2 == 0) & (F.col("col") % 2 == 0) & F.col("_first")
    aggs = [F.max(first).alias("_first")]
    for b in bands:
        aggs += [F.max(F.when(first, F.col(b))).alias(b), F.sum(f"{b}_sum").alias(f"{b}_sum"), F.sum(f"{b}_n").alias(f"{b}_n")]
    return level.groupBy(*by, *_cells(2)).agg(*aggs)


def _cells(k: int) -> list[Column]:
    return [F.floor(F.col(c) / F.lit(k)).cast("int").alias(c) for c in CELL]


@dataclass(frozen=True)
class Pyramid:
    """``pixels`` is the raster itself (level 0); levels 1 to ``levels`` lie under ``path``."""

    pixels: DataFrame
    path: str
    levels: int
    bands: tuple[str, ...]
    by: tuple[str, ...] = ("time",)

    def _base(self) -> DataFrame:
        parts = [F.lit(True).alias("_first")]
        for b in self.bands:
            parts += [F.col(b).cast("double").alias(f"{b}_sum"), F.when(F.col(b).isNotNull(), 1).otherwise(0).cast("long").alias(f"{b}_n")]
        return self.pixels.select(*self.by, *CELL, *self.bands, *parts)

    def level(self, n: int) -> DataFrame:
        return self._base() if n == 0 else self.pixels.sparkSession.read.parquet(f"{self.path}/level_{n}")

    def write(self) -> Pyramid:
        for n in range(1, self.levels + 1):
            _half(self.level(n - 1), self.by, self.bands).write.parquet(f"{self.path}/level_{n}")
        return self

    def best_level(self, k: int) -> int:
        """The coarsest level whose cells divide blocks of ``k`` x ``k``."""
        return max(n for n in range(self.levels + 1) if k % 2**n == 0)

    def decimated(self, k: int) -> DataFrame:
        """Every k-th row and column, renumbered; equals ``raster.decimate`` on the raster."""
        n = self.best_level(k)
        rest = k // 2**n
        kept = self.level(n).where((F.col("row") % rest == 0) & (F.col("col") % rest == 0) & F.col("_first"))
        return kept.select(*self.by, *_cells(rest), *self.bands)

    def mean(self, k: int) -> DataFrame:
        """Mean of the valid values of blocks of ``k`` x ``k``; NULL for a block without any."""
        n = self.best_level(k)
        rest, level = k // 2**n, self.level(n)
        if rest > 1:
            sums = [F.sum(f"{b}{part}").alias(f"{b}{part}") for b in self.bands for part in ("_sum", "_n")]
            level = level.groupBy(*self.by, *_cells(rest)).agg(*sums)
        return level.select(*self.by, *CELL, *[F.try_divide(F.col(f"{b}_sum"), F.col(f"{b}_n")).alias(b) for b in self.bands])
