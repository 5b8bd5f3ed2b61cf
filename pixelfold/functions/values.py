"""Date, string, JSON and masking helpers: Columns in, Column out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- dates ---------------------------------------------------------------

def month_end(t: ColumnLike) -> Column:
    """Month-end label of a date or timestamp."""
    return F.last_day(_c(t))


def parse_day_first(s: ColumnLike) -> Column:
    """dd/MM/yyyy or dd-MM-yyyy text to DATE, NULL when it does not parse."""
    s = F.regexp_replace(F.trim(_c(s).cast("string")), "[-.]", "/")
    return F.coalesce(F.try_to_date(s, "d/M/yyyy"), F.try_to_date(s, "yyyy/M/d"))


def parse_compact_date(s: ColumnLike) -> Column:
    """yyyyMMdd text or number to DATE, NULL when it does not parse."""
    return F.try_to_date(F.trim(_c(s).cast("string")), "yyyyMMdd")


def to_number(s: ColumnLike) -> Column:
    """Numeric coercion; text that is not a number becomes NULL."""
    v = F.trim(_c(s).cast("string")).try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


# ---- strings -------------------------------------------------------------

def safe_name(name: str) -> str:
    """Column name with ``: . /`` and space replaced by an underscore."""
    return name.translate(str.maketrans({c: "_" for c in ":./ "}))


def safe_name_col(s: ColumnLike) -> Column:
    return F.regexp_replace(_c(s), r"[:./ ]", "_")


def safe_file_key(s: ColumnLike) -> Column:
    """File-name-safe key: slash, backslash and space become underscores."""
    return F.regexp_replace(_c(s).cast("string"), r"[/\\ ]", "_")


# ---- truthiness ----------------------------------------------------------

def first_truthy(*cols: ColumnLike) -> Column:
    """First value that is not NULL, 0 or ''; the last value otherwise.

    Matches a chain of Python ``or``: when every value is falsy the last one is
    returned as it is.
    """
    cs = [_c(c) for c in cols]
    text = [c.cast("string") for c in cs]
    out = cs[-1]
    for c, t in list(zip(cs, text))[-2::-1]:
        falsy = c.isNull() | (t == "") | F.coalesce(t.try_cast("double") == 0, F.lit(False))
        out = F.when(~falsy, c).otherwise(out)
    return out


# ---- masks ---------------------------------------------------------------

def keep_classes(v: ColumnLike, cls: ColumnLike, keep: Iterable[int]) -> Column:
    return F.when(_c(cls).isin(list(keep)), _c(v))


def drop_classes(v: ColumnLike, cls: ColumnLike, drop: Iterable[int]) -> Column:
    return F.when(~_c(cls).isin(list(drop)), _c(v))


def positive_only(v: ColumnLike) -> Column:
    """Values at or below zero are nodata."""
    return F.when(_c(v) > 0, _c(v))


def nan_to_null(v: ColumnLike) -> Column:
    v = _c(v)
    return F.when(~F.isnan(v), v)


# ---- grid ----------------------------------------------------------------

def cell_of(x: ColumnLike, x0: float, dx: float) -> Column:
    """Index of the grid cell that holds coordinate x."""
    return F.floor((_c(x) - F.lit(x0)) / F.lit(dx)).cast("int")


def cell_centre(i: ColumnLike, x0: float, dx: float) -> Column:
    return F.lit(x0) + (_c(i) + F.lit(0.5)) * F.lit(dx)
