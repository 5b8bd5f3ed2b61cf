"""Time series, weather tables, checks and set operations."""

from __future__ import annotations

from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from ..functions import indices, values as V
from ..operators import series, tables
from ..sources.files import canonical
from . import bindings as B
from .registry import day, day_sql, query, rounded, rounded_sql

NULLS = "value IS NOT NULL AND value <> 0 AND value BETWEEN -1 AND 1"


def _event_index(spark, d):
    """An index-like series with values beyond 1, zeros and NULLs, one row per event."""
    v = F.floor(F.col("value")) / F.lit(256.0)
    return B.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.when(v < 0.125, 0.0).otherwise(v)).alias("value")
    )


EVENT_INDEX = (
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN CASE WHEN floor(value) / 256.0::DOUBLE < 0.125 THEN 0.0::DOUBLE"
    " ELSE floor(value) / 256.0::DOUBLE END END AS value FROM events"
)


@query("clean_index", B.sql(e=EVENT_INDEX) + f"SELECT event_id, value FROM e WHERE {NULLS}")
def _(spark, d):
    return series.clean_index(_event_index(spark, d))


@query(
    "clean_index_report",
    B.sql(e=EVENT_INDEX)
    + f"SELECT count(*) AS original, count(CASE WHEN {NULLS} THEN 1 END) AS kept, count(CASE WHEN {NULLS} THEN NULL ELSE 1 END) AS removed FROM e",
)
def _(spark, d):
    return series.clean_report(_event_index(spark, d))


PIVOT = ", ".join(f'avg(CASE WHEN zone = {z} THEN value END) AS "{z}"' for z in range(8))


@query("pivot_series", B.sql("se") + f"SELECT {day_sql('day')}, {PIVOT} FROM se GROUP BY day")
def _(spark, d):
    wide = series.pivot_series(B.series(spark, d), "day", "zone", "value", range(8))
    return wide.select(day("day"), *[F.col(str(z)) for z in range(8)])


PAIRS = [(m, z) for m in ("value", "double") for z in map(str, range(8))]


@query(
    "pivot_metric_and_area",
    B.sql("se")
    + f"SELECT {day_sql('day')}, "
    + ", ".join(
        f"avg(CASE WHEN zone = {z} THEN value{' * 2' if m == 'double' else ''} END) AS {m}_{z}" for m, z in PAIRS
    )
    + " FROM se GROUP BY day",
)
def _(spark, d):
    s = B.series(spark, d).select("day", F.col("zone").cast("string").alias("aoi"), "value", (F.col("value") * 2).alias("double"))
    long = s.unpivot(["day", "aoi"], ["value", "double"], "metric", "value")
    return series.pivot_metric_aoi(long, "day", PAIRS).withColumn("day", day("day"))


@query(
    "melted_bands",
    B.sql("px")
    + f"SELECT {day_sql()}, row, col, 'red' AS band, red AS value FROM px UNION ALL SELECT {day_sql()}, row, col, 'nir', nir FROM px",
)
def _(spark, d):
    long = series.unpivot_bands(B.pixels(spark, d), ["time", "row", "col"], ["red", "nir"])
    return long.withColumn("time", day())


# Neighbouring valid points on both sides of every gap.
FILLED = (
    "SELECT zone, day, value, last_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER b AS d0,"
    " last_value(value IGNORE NULLS) OVER b AS v0, first_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER a AS d1,"
    " first_value(value IGNORE NULLS) OVER a AS v1 FROM sg"
    " WINDOW b AS (PARTITION BY zone ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),"
    " a AS (PARTITION BY zone ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
)
LINE = "CASE WHEN value IS NOT NULL THEN value WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * date_diff('day', d0, day) / date_diff('day', d0, d1)"


@query(
    "interpolated_both_ends",
    B.sql("se", "sg", f=FILLED)
    + f"SELECT zone, {day_sql('day')}, {rounded_sql(LINE + ' ELSE coalesce(v0, v1) END')} AS value FROM f",
)
def _(spark, d):
    out = series.interpolate_time(B.gappy_series(spark, d), "zone", "day", "value", "both")
    return out.select("zone", day("day"), rounded("value").alias("value"))


@query(
    "interpolated_inside",
    B.sql("se", "sg", f=FILLED) + f"SELECT zone, {day_sql('day')}, {rounded_sql(LINE + ' END')} AS value FROM f",
)
def _(spark, d):
    out = series.interpolate_time(B.gappy_series(spark, d), "zone", "day", "value", "inside")
    return out.select("zone", day("day"), rounded("value").alias("value"))


def _savgol_sql() -> str:
    # Quadratic five-point smoothing weights times 35, by position in the window.
    weights = {
        0: (31, 9, -3, -5, 3),
        1: (9, 13, 12, 6, -5),
        2: (-3, 12, 17, 12, -3),
        3: (-5, 6, 12, 13, 9),
        4: (3, -5, -3, 9, 31),
    }

    def fit(pos: int) -> str:
        parts = []
        for j, w in enumerate(weights[pos]):
            o = j - pos
            parts.append(f"{w} * " + ("value" if o == 0 else f"{'lead' if o > 0 else 'lag'}(value, {abs(o)}) OVER w"))
        return "(" + " + ".join(parts) + ") / 35"

    return (
        f"CASE WHEN i = 1 THEN {fit(0)} WHEN i = 2 THEN {fit(1)} WHEN i = n - 1 THEN {fit(3)}"
        f" WHEN i = n THEN {fit(4)} ELSE {fit(2)} END"
    )


@query(
    "savitzky_golay",
    B.sql(
        "se",
        c="SELECT *, row_number() OVER (PARTITION BY zone ORDER BY day) AS i, count(*) OVER (PARTITION BY zone) AS n FROM se",
        s=f"SELECT zone, day, {_savgol_sql()} AS smooth FROM c WINDOW w AS (PARTITION BY zone ORDER BY day)",
    )
    + f"SELECT zone, {day_sql('day')}, {rounded_sql('smooth')} AS smooth FROM s",
)
def _(spark, d):
    out = series.savgol_5_2(B.series(spark, d), "zone", "day", "value")
    return out.select("zone", day("day"), rounded("smooth").alias("smooth"))


@query("cubic_resampled")
def _(spark, d):
    out = series.cubic_resample(B.gappy_series(spark, d), "zone", "day", "value")
    return out.select("zone", rounded("t", 3).alias("t"), rounded("value").alias("value"))


# Values on one cubic per zone: the not-a-knot spline through them is that cubic, so its closed form is the answer.
@query(
    "cubic_resampled_on_a_cubic",
    B.sql(
        "se",
        "sg",
        v="SELECT zone, epoch(CAST(day AS TIMESTAMP)) AS t FROM sg WHERE value IS NOT NULL",
        n="SELECT zone, min(t) AS a, max(t) AS b, count(*) * 3 AS n FROM v GROUP BY 1 HAVING count(*) >= 4",
        p="SELECT zone, a + (b - a) * i / (n - 1) AS t FROM (SELECT zone, a, b, n, unnest(range(n)) AS i FROM n)",
        x="SELECT zone, t, (t - epoch(TIMESTAMP '2024-01-01')) / 86400 AS x FROM p",
    )
    + f"SELECT zone, round(t, 3) AS t, {rounded_sql('(zone + 1) + 0.5::DOUBLE * x - 0.25::DOUBLE * x * x + 0.01::DOUBLE * x * x * x')} AS value FROM x",
)
def _(spark, d):
    x = F.datediff("day", F.lit("2024-01-01").cast("date")).cast("double")
    cubic = (F.col("zone") + 1) + x * 0.5 - x * x * 0.25 + x * x * x * 0.01
    s = B.gappy_series(spark, d).where(F.col("value").isNotNull()).withColumn("value", cubic)
    out = series.cubic_resample(s, "zone", "day", "value")
    return out.select("zone", rounded("t", 3).alias("t"), rounded("value").alias("value"))


def _running_max(times, values):
    return np.maximum.accumulate(values)


@query(
    "function_along_time",
    B.sql("se") + f"SELECT zone, {day_sql('day')}, max(value) OVER (PARTITION BY zone ORDER BY day) AS value FROM se",
)
def _(spark, d):
    out = series.apply_along_time(B.series(spark, d), "zone", "day", "value", _running_max)
    return out.select("zone", day("day"), "value")


SLOTS = series.slot_edges(datetime(2024, 1, 1), datetime(2024, 1, 31), 13)


@query(
    "time_slots",
    "SELECT CAST(slot AS BIGINT) AS slot, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM (SELECT event_id, "
    + " + ".join(f"(CASE WHEN CAST(ts AS DATE) >= DATE '{e}' THEN 1 ELSE 0 END)" for e in SLOTS[1:-1])
    + f" AS slot FROM events WHERE CAST(ts AS DATE) >= DATE '{SLOTS[0]}' AND CAST(ts AS DATE) < DATE '{SLOTS[-1]}') GROUP BY 1",
)
def _(spark, d):
    e = series.time_slots(B.table(spark, d, "events"), "ts", datetime(2024, 1, 1), datetime(2024, 1, 31), 13)
    return e.groupBy(F.col("slot").cast("bigint").alias("slot")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    "weather_dates",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS n FROM orders GROUP BY 1",
)
def _(spark, d):
    w = series.detect_date(B.weather(spark, d))
    return w.groupBy(day("date")).agg(F.count("*").alias("n"))


@query(
    "weather_monthly",
    "SELECT strftime(last_day(o_orderdate), '%Y-%m-%d') AS month, avg(CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 1000) END) AS t_max,"
    " CAST(sum(floor(o_totalprice / 1000)) AS DOUBLE) AS rain, CAST(sum(o_custkey) AS DOUBLE) AS evap FROM orders GROUP BY 1",
)
def _(spark, d):
    m = series.weather_monthly(series.detect_date(B.weather(spark, d)))
    return m.select(day("month"), F.col("`T.Max`").alias("t_max"), F.col("Rain").alias("rain"), F.col("Evap").alias("evap"))


@query(
    "linear_fit",
    B.sql("px")
    + f"SELECT year(time) AS year, {rounded_sql('regr_slope(nir, red)')} AS slope, {rounded_sql('regr_intercept(nir, red)')} AS intercept,"
    f" {rounded_sql('regr_r2(nir, red)')} AS r2 FROM px GROUP BY 1",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("year", F.year("time").cast("bigint"))
    fit = series.linear_fit(px, "red", "nir", ["year"])
    return fit.select("year", *[rounded(c).alias(c) for c in ("slope", "intercept", "r2")])


@query(
    "histogram",
    B.sql("px", s="SELECT nir FROM px WHERE nir > 0", b="SELECT min(nir) AS lo, max(nir) AS hi FROM s")
    + "SELECT CAST(least(floor((nir - lo) * 50.0::DOUBLE / (hi - lo)), 49) AS BIGINT) AS bin, count(*) AS n FROM s, b GROUP BY 1",
)
def _(spark, d):
    return series.histogram(B.pixels(spark, d), "nir", 50).select(F.col("bin").cast("bigint"), "n")


@query(
    "histogram_all_bins",
    B.sql("px", s="SELECT nir - red AS v FROM px WHERE nir - red > 0", b="SELECT min(v) AS lo, max(v) AS hi FROM s",
          c="SELECT CAST(least(floor((v - lo) * 5000.0::DOUBLE / (hi - lo)), 4999) AS BIGINT) AS bin, count(*) AS n FROM s, b GROUP BY 1")
    + "SELECT range AS bin, coalesce(n, 0) AS n FROM range(5000) LEFT JOIN c ON range = bin",
)
def _(spark, d):
    px = B.pixels(spark, d).select((F.col("nir") - F.col("red")).alias("v"))
    return series.histogram(px, "v", 5000, empty_bins=True).select(F.col("bin").cast("bigint"), "n")


@query(
    "describe_columns",
    B.sql("px", u="SELECT 'red' AS c, red AS v FROM px UNION ALL SELECT 'nir', nir FROM px UNION ALL SELECT 'blue', blue FROM px")
    + f"SELECT c AS column, count(v) AS count, avg(v) AS mean, {rounded_sql('stddev_samp(v)')} AS std, min(v) AS min, max(v) AS max FROM u GROUP BY 1",
)
def _(spark, d):
    out = series.describe(B.pixels(spark, d), ["red", "nir", "blue"])
    return out.select("column", "count", "mean", rounded("std").alias("std"), "min", "max")


@query(
    "describe_quartiles",
    B.sql("px", u="SELECT 'red' AS c, red AS v FROM px UNION ALL SELECT 'ndvi', (nir - red) / (nir + red) FROM px WHERE nir + red <> 0")
    + "SELECT c AS column, count(v) AS count, "
    + ", ".join(f"{rounded_sql(f'quantile_cont(v, {p})', 9)} AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    + " FROM u GROUP BY 1",
)
def _(spark, d):
    ndvi = indices.ndvi("nir", "red").alias("ndvi")
    out = series.describe(B.pixels(spark, d).select("red", ndvi), ["red", "ndvi"], quartiles=True)
    return out.select("column", "count", *[rounded(q, 9).alias(q) for q in series.QUARTILES])


@query("unique_keys", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
def _(spark, d):
    return series.unique_keys(B.table(spark, d, "orders"), "o_custkey")


@query(
    "numbers_from_text",
    "SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'bad' ELSE CAST(floor(o_totalprice / 1000) AS VARCHAR) END AS DOUBLE) AS v FROM orders",
)
def _(spark, d):
    o = B.table(spark, d, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "bad").otherwise(F.floor(F.col("o_totalprice") / 1000).cast("string"))
    return o.select("o_orderkey", V.to_number(text).alias("v"))


@query(
    "dates_from_text",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS day_first FROM orders",
)
def _(spark, d):
    o = B.table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.date_format(V.parse_compact_date(F.date_format("o_orderdate", "yyyyMMdd")), "yyyy-MM-dd").alias("compact"),
        F.date_format(V.parse_day_first(F.date_format("o_orderdate", "d/M/yyyy")), "yyyy-MM-dd").alias("day_first"),
    )


# ---- set operations -------------------------------------------------------------------

@query(
    "stacked_results",
    B.sql("px")
    + f"SELECT {day_sql()}, row, col, red, NULL::DOUBLE AS nir FROM px UNION ALL SELECT {day_sql()}, row, col, NULL, nir FROM px",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("time", day())
    return tables.stack([px.select("time", "row", "col", "red"), px.select("time", "row", "col", "nir")])


@query(
    "stacked_years",
    B.sql("px")
    + "SELECT CAST(year(time) AS INT) AS year, row, col, max(red) AS red FROM px GROUP BY 1, 2, 3",
)
def _(spark, d):
    px = B.pixels(spark, d)
    years = [r["y"] for r in px.select(F.year("time").alias("y")).distinct().orderBy("y").collect()]
    yearly = {y: px.where(F.year("time") == y).groupBy("row", "col").agg(F.max("red").alias("red")) for y in years}
    return tables.stack_by_year(yearly).select("year", "row", "col", "red")


@query(
    "missing_rows",
    "SELECT DISTINCT o_custkey AS k, CAST(month(o_orderdate) AS INT) AS m FROM orders EXCEPT"
    " SELECT o_custkey, CAST(month(o_orderdate) AS INT) FROM orders WHERE o_orderstatus = 'F'",
)
def _(spark, d):
    o = B.table(spark, d, "orders").select(
        F.col("o_custkey").alias("k"), F.month("o_orderdate").alias("m"), F.col("o_orderstatus").alias("s")
    )
    return tables.missing_rows(o.select("k", "m").distinct(), o.where("s = 'F'"), ["k", "m"])


@query(
    "canonical_header",
    B.sql("se") + f"SELECT zone, {day_sql('day')}, value, NULL::DOUBLE AS red_mean FROM se",
)
def _(spark, d):
    return canonical(B.series(spark, d), ["zone", "day", "value", "red_mean"]).withColumn("day", day("day"))
