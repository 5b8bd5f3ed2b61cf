"""Global value ranges as scalar subqueries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def value_range(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[Column, Column]]:
    """Global (minimum, maximum) of each column as Columns: one scalar subquery,
    that is one pass over ``df``, for all of them."""
    members = [F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)] + [F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]
    ends = df.agg(F.struct(*members).alias("ends")).scalar()
    return {c: (ends[f"lo{i}"], ends[f"hi{i}"]) for i, c in enumerate(cols)}
