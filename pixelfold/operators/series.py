"""Zone time series: cleaning, pivoting, filling, smoothing, resampling, weather."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions import values as V
from .selection import select_quantiles
from .ranges import value_range


def clean_index(s: DataFrame, value: str = "value") -> DataFrame:
    """Drops NULL, 0 and values outside -1..1."""
    v = F.col(value)
    return s.where(v.isNotNull() & (v != 0) & v.between(-1, 1))


def clean_report(s: DataFrame, value: str = "value") -> DataFrame:
    """One row: original, kept and removed counts of ``clean_index``."""
    v = F.col(value)
    ok = F.coalesce((v != 0) & v.between(-1, 1), F.lit(False))
    return s.agg(
        F.count("*").alias("original"),
        F.count(F.when(ok, 1)).alias("kept"),
        F.count(F.when(~ok, 1)).alias("removed"),
    )


def average_duplicates(s: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key and time: copies of a point are averaged, map-side combined."""
    return s.groupBy(*keys).agg(F.avg(value).alias(value))


def pivot_series(
    s: DataFrame, time: str, column: str, value: str, values: Sequence, name: Callable[[object], str] | None = None
) -> DataFrame:
    """Long to wide: one column per given value of ``column``, duplicates averaged."""
    name = name or (lambda v: V.safe_name(str(v)))
    return s.groupBy(time).agg(
        *[F.avg(F.when(F.col(column) == F.lit(v), F.col(value))).alias(name(v)) for v in values]
    )


def pivot_metric_aoi(
    s: DataFrame, time: str, pairs: Sequence[tuple[str, str]], metric: str = "metric", aoi: str = "aoi", value: str = "value"
) -> DataFrame:
    """Long to wide with one column per (metric, aoi) pair."""
    return s.groupBy(time).agg(
        *[
            F.avg(F.when((F.col(metric) == F.lit(m)) & (F.col(aoi) == F.lit(a)), F.col(value))).alias(
                V.safe_name(f"{m}_{a}")
            )
            for m, a in pairs
        ]
    )


def unpivot_bands(df: DataFrame, ids: Sequence[str], bands: Sequence[str], var: str = "band", value: str = "value") -> DataFrame:
    """Wide bands to (var, value) rows."""
    return df.select(*ids, *[F.col(b).cast("double").alias(b) for b in bands]).unpivot(
        list(ids), list(bands), var, value
    )


def mean_over_zones(s: DataFrame, bands: Sequence[str], time: str = "time") -> DataFrame:
    return s.groupBy(time).agg(*[F.avg(b).alias(b) for b in bands])


def trend(pixels: DataFrame, bands: Sequence[str], time: str = "time") -> DataFrame:
    """Spatial mean over the whole area per time."""
    return pixels.groupBy(time).agg(*[F.avg(b).alias(b) for b in bands])


# ---- filling and smoothing ------------------------------------------------------

def interpolate_time(s: DataFrame, key: str, time: str, value: str, limit: str = "both") -> DataFrame:
    """Time-weighted linear fill of NULLs per key.

    ``limit="both"`` carries the nearest valid value over both ends,
    ``"inside"`` leaves the ends NULL. Needs one row per (key, time).
    """
    if limit not in ("both", "inside"):
        raise ValueError("limit is 'both' or 'inside'")
    order = W.partitionBy(key).orderBy(time)
    back = order.rowsBetween(W.unboundedPreceding, 0)
    ahead = order.rowsBetween(0, W.unboundedFollowing)
    t = F.unix_seconds(F.col(time).cast("timestamp")).cast("double")
    point = F.when(F.col(value).isNotNull(), F.struct(t.alias("t"), F.col(value).cast("double").alias("v")))
    w = s.withColumn("_t", t).withColumn("_p", point)
    w = w.withColumn("_a", F.last("_p", ignorenulls=True).over(back)).withColumn(
        "_b", F.first("_p", ignorenulls=True).over(ahead)
    )
    share = F.try_divide(F.col("_t") - F.col("_a.t"), F.col("_b.t") - F.col("_a.t"))
    line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * share
    ends = F.coalesce(F.col("_a.v"), F.col("_b.v")) if limit == "both" else F.lit(None).cast("double")
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value).cast("double"))
        .when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), line)
        .otherwise(ends)
    )
    return w.withColumn(value, filled).drop("_t", "_p", "_a", "_b")


def _savgol_weights() -> np.ndarray:
    """Hat matrix of a quadratic least-squares fit on five equidistant points:
    row i are the weights that give the smoothed point i."""
    x = np.vander(np.arange(5) - 2.0, 3)
    return x @ np.linalg.pinv(x)


def savgol_5_2(s: DataFrame, key: str, time: str, value: str, out: str = "smooth") -> DataFrame:
    """Savitzky-Golay smoothing, window 5, order 2; the two points at each end are
    read off the polynomial of the first or last window. Shorter series give NULL."""
    w = W.partitionBy(key).orderBy(time)
    n = F.count(F.lit(1)).over(W.partitionBy(key))
    i = F.row_number().over(w)
    near = {o: (F.lag(value, -o).over(w) if o < 0 else F.lead(value, o).over(w)) for o in range(-4, 5) if o}
    near[0] = F.col(value)
    m = s.select("*", i.alias("_i"), n.alias("_n"), *[near[o].cast("double").alias(f"_o{o + 4}") for o in near])
    h = _savgol_weights()

    def fitted(pos: int) -> Column:
        total = F.lit(0.0)
        for j in range(5):
            total = total + F.lit(float(h[pos, j])) * F.col(f"_o{j - pos + 4}")
        return total

    k, last = F.col("_i"), F.col("_n")
    smooth = (
        F.when(last < 5, F.lit(None).cast("double"))
        .when(k == 1, fitted(0))
        .when(k == 2, fitted(1))
        .when(k == last - 1, fitted(3))
        .when(k == last, fitted(4))
        .otherwise(fitted(2))
    )
    return m.withColumn(out, smooth).drop("_i", "_n", *[f"_o{o}" for o in range(9)])


def apply_along_time(
    s: DataFrame, key: str, time: str, value: str, fn: Callable[[np.ndarray, np.ndarray], np.ndarray], out: str = "value"
) -> DataFrame:
    """User function along one key's series: ``fn(times, values) -> values``.

    Copies of a time are averaged before the group is formed, so a group has at
    most one row per distinct time.
    """
    uniq = average_duplicates(s, [key, time], value)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time)
        return pdf[[key, time]].assign(**{out: np.asarray(fn(pdf[time].to_numpy(), pdf[value].to_numpy(float)), float)})

    schema = T.StructType([s.schema[key], s.schema[time], T.StructField(out, T.DoubleType())])
    return uniq.groupBy(key).applyInPandas(run, schema)


def _cubic_through(x: np.ndarray, y: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Not-a-knot cubic spline: second derivatives by one sweep over a tridiagonal system.

    The end conditions give the first and last derivative from their neighbours, which
    leaves the inner ones with three terms a row.
    """
    n, h = len(x), np.diff(x)
    low, diag, up = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy()
    rhs = 6 * np.diff(np.diff(y) / h)
    p, q = h[0] / h[1], h[-1] / h[-2]
    diag[0] += low[0] * (1 + p)
    up[0] -= low[0] * p
    diag[-1] += up[-1] * (1 + q)
    low[-1] -= up[-1] * q
    for i in range(1, n - 2):
        w = low[i] / diag[i - 1]
        diag[i] -= w * up[i - 1]
        rhs[i] -= w * rhs[i - 1]
    m = np.zeros(n)
    for i in range(n - 3, -1, -1):
        m[i + 1] = (rhs[i] - (up[i] * m[i + 2] if i < n - 3 else 0.0)) / diag[i]
    m[0] = (1 + p) * m[1] - p * m[2]
    m[-1] = (1 + q) * m[-2] - q * m[-3]
    k = np.clip(np.searchsorted(x, xi, side="right") - 1, 0, n - 2)
    d, e = xi - x[k], x[k + 1] - xi
    return (
        (m[k] * e**3 + m[k + 1] * d**3) / (6 * h[k])
        + (y[k] / h[k] - m[k] * h[k] / 6) * e
        + (y[k + 1] / h[k] - m[k + 1] * h[k] / 6) * d
    )


def cubic_resample(s: DataFrame, key: str, time: str, value: str, factor: int = 3) -> DataFrame:
    """key, t (epoch seconds), value: ``factor`` times as many equidistant points on
    the cubic through the series; fewer than four valid points are passed through."""
    secs = F.unix_seconds(F.col(time).cast("timestamp")).cast("double")
    uniq = (
        s.where(F.col(value).isNotNull())
        .select(key, secs.alias("t"), F.col(value).cast("double").alias("value"))
        .groupBy(key, "t")
        .agg(F.avg("value").alias("value"))
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        if len(pdf) < 4:
            return pdf[[key, "t", "value"]]
        x = pdf["t"].to_numpy()
        xi = np.linspace(x[0], x[-1], len(x) * factor)
        unit = x[-1] - x[0]
        yi = _cubic_through((x - x[0]) / unit, pdf["value"].to_numpy(), (xi - x[0]) / unit)
        return pd.DataFrame({key: pdf[key].iloc[0], "t": xi, "value": yi})

    schema = T.StructType(
        [s.schema[key], T.StructField("t", T.DoubleType()), T.StructField("value", T.DoubleType())]
    )
    return uniq.groupBy(key).applyInPandas(run, schema)


# ---- slots, weather, checks --------------------------------------------------------

def slot_edges(start: datetime, end: datetime, n: int) -> list[date]:
    """n dates that start the n equal parts of a range."""
    step = (end - start) / n
    return [(start + i * step).date() for i in range(n)]


def time_slots(df: DataFrame, time: str, start: datetime, end: datetime, n: int, out: str = "slot") -> DataFrame:
    """Rows with their slot 0..n-2; rows outside the n-1 slots are dropped.

    The n edges are dates; slot i runs from edge i to edge i+1, the low edge included.
    """
    edges = slot_edges(start, end, n)
    day = F.col(time).cast("date")
    inside = df.where((day >= F.lit(edges[0])) & (day < F.lit(edges[-1])))
    passed = [F.when(day >= F.lit(e), 1).otherwise(0) for e in edges[1:-1]]
    return inside.withColumn(out, sum(passed, F.lit(0)))


WEATHER_SUMS = ("Rain", "Evap")  # fixed values: columns added up per month
WEATHER_MEANS = ("T.Max", "T.Min", "Radn", "VP", "RHmaxT", "RHminT")  # fixed values: averaged


def detect_date(w: DataFrame, out: str = "date") -> DataFrame:
    """Adds the first of Date2 (day first), Date (yyyymmdd), first column (day
    first) that parses for any row; the choice is global, as one scalar subquery.
    A table with rows of which no column parses is an error."""
    candidates: list[Column] = []
    if "Date2" in w.columns:
        candidates.append(V.parse_day_first("Date2"))
    if "Date" in w.columns:
        candidates.append(V.parse_compact_date("Date"))
    candidates.append(V.parse_day_first(F.col(f"`{w.columns[0]}`")))
    any_parsed = w.agg(F.array(*[F.count(c) > 0 for c in candidates]).alias("_any")).scalar()
    picked = F.array_position(any_parsed, F.lit(True))
    unreadable = F.raise_error(F.lit("no column holds dates")).cast("date")
    chosen = F.when(picked == 0, unreadable)
    for i, c in reversed(list(enumerate(candidates, 1))):
        chosen = F.when(picked == i, c).otherwise(chosen)
    return w.withColumn(out, chosen).where(F.col(out).isNotNull())


def weather_monthly(w: DataFrame, date_col: str = "date") -> DataFrame:
    """Month-end totals of rain and evaporation and means of the other variables
    that the table has; text is coerced to numbers. Months without rows between the
    first and the last are kept: totals 0, means NULL."""
    wanted = [c for c in ("T.Max", "T.Min", "Rain", "Evap", "Radn", "VP", "RHmaxT", "RHminT") if c in w.columns]
    aggs = []
    for c in wanted:
        v = V.to_number(F.col(f"`{c}`"))
        total = F.coalesce(F.sum(v), F.lit(0.0)) if c in WEATHER_SUMS else F.avg(v)
        aggs.append(total.alias(c))
    found = w.groupBy(F.last_day(date_col).alias("month")).agg(*aggs)
    ends = w.agg(F.trunc(F.min(date_col), "month").alias("a"), F.max(date_col).alias("b")).where("a IS NOT NULL")
    months = ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("m")).select(F.last_day("m").alias("month"))
    out = months.join(found, "month", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in wanted if c in WEATHER_SUMS})


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """slope, intercept and r2 of y on x over rows where both are present."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def histogram(df: DataFrame, col: str, bins: int = 50, positive_only: bool = True, empty_bins: bool = False) -> DataFrame:
    """bin 0..bins-1 and count between the smallest and largest value; the last
    bin includes its upper edge. Empty bins are absent, or counted 0 with ``empty_bins``."""
    src = df.where((F.col(col) > 0) if positive_only else F.col(col).isNotNull()).select(col)
    lo, hi = value_range(src, [col])[col]
    pos = F.try_divide((F.col(col) - lo) * F.lit(float(bins)), hi - lo)
    b = F.least(F.coalesce(F.floor(pos).cast("int"), F.lit(0)), F.lit(bins - 1))
    counted = src.groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    if not empty_bins:
        return counted
    # Neither side has more than ``bins`` rows.
    spine = df.sparkSession.range(bins, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counted), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, cols: Sequence[str], quartiles: bool = False) -> DataFrame:
    """column, count, mean, std, min, max per numeric column, in one pass; with
    ``quartiles`` also the exact q25, q50 and q75, which no task sorts as a whole."""
    long = unpivot_bands(df, [], cols, "column", "value")
    if quartiles:
        return describe(df, cols).join(select_quantiles(long, ["column"], F.col("value"), QUARTILES), "column", "left")
    return long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def unique_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def run_summary(results: DataFrame, zones: DataFrame, key: str, value: str, time: str = "time") -> DataFrame:
    """One row: zones processed, without data, empty and skipped (NULL key), result
    rows, distinct keys and date range.

    ``processed`` zones have a valid value, ``empty`` ones only NULLs, ``no_data``
    ones no row at all.
    """
    per_zone = results.groupBy(key).agg(
        F.count("*").alias("_rows"), F.count(value).alias("_valid"), F.min(time).alias("_t0"), F.max(time).alias("_t1")
    )
    j = zones.select(key).join(per_zone, key, "left")
    k = F.col(key)
    return j.agg(
        F.count(F.when(F.col("_valid") > 0, 1)).alias("processed"),
        F.count(F.when(F.col("_valid") == 0, 1)).alias("empty"),
        F.count(F.when(k.isNotNull() & F.col("_rows").isNull(), 1)).alias("no_data"),
        F.count(F.when(k.isNull(), 1)).alias("skipped"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.count("_rows").alias("unique_keys"),
        F.min("_t0").alias("first_time"),
        F.max("_t1").alias("last_time"),
    )
