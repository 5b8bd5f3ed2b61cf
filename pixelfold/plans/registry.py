"""Named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def day(c: str = "time") -> Column:
    """Date as text, equal in both engines."""
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def day_sql(c: str = "time", expr: str | None = None) -> str:
    return f"strftime({expr or c}, '%Y-%m-%d') AS {c}"


def rounded(c: str | Column, digits: int = 6) -> Column:
    """Rounded value without a negative zero."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, digits) + F.lit(0.0)


def rounded_sql(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0::DOUBLE)"
