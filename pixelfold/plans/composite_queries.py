"""Composites, mosaics, scene selection and change over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import indices as I
from ..operators import change, composite, raster, tables
from . import bindings as B
from .registry import day, day_sql, query, rounded, rounded_sql

CELL = ["row", "col"]
BANDS = ["red", "nir"]
CLEAR = "scl NOT IN (0, 1, 3, 7, 8, 9, 10)"


@query(
    "monthly_median",
    B.sql("px") + f"SELECT {day_sql('month', 'last_day(time)')}, row, col, median(red) AS red, median(nir) AS nir FROM px GROUP BY 1, 2, 3",
)
def _(spark, d):
    return composite.monthly_median(B.pixels(spark, d), BANDS).select(day("month"), *CELL, *BANDS)


@query(
    "monthly_median_gap_filled",
    B.sql(
        "px",
        m="SELECT last_day(time) AS month, row, col, median(red) AS red, median(nir) AS nir FROM px GROUP BY 1, 2, 3",
        cal="SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(time)), max(time), INTERVAL 1 MONTH)) AS DATE)) AS month FROM px",
        cells="SELECT DISTINCT row, col FROM px",
    )
    + f"SELECT {day_sql('month', 'cal.month')}, cells.row, cells.col, red, nir FROM cal CROSS JOIN cells"
    " LEFT JOIN m ON m.month = cal.month AND m.row = cells.row AND m.col = cells.col",
)
def _(spark, d):
    px = B.pixels(spark, d)
    return composite.monthly_median(px, BANDS, fill_gaps=True).select(day("month"), *CELL, *BANDS)


@query(
    "monthly_median_cloud_masked",
    B.sql("px")
    + f"SELECT {day_sql('month', 'last_day(time)')}, row, col, median(CASE WHEN {CLEAR} THEN red END) AS red,"
    f" median(CASE WHEN {CLEAR} THEN nir END) AS nir FROM px GROUP BY 1, 2, 3",
)
def _(spark, d):
    px = tables.mask_classes(B.pixels(spark, d), "scl", BANDS, drop=composite.INVALID_SCENE_CLASSES)
    return composite.monthly_median(px, BANDS).select(day("month"), *CELL, *BANDS)


def _least_cloudy_sql(score: str, month: str) -> str:
    return (
        B.sql(
            "px",
            s=f"SELECT time, {score} AS score FROM px GROUP BY time",
            r=f"SELECT time, row_number() OVER (PARTITION BY {month} ORDER BY score, time) AS rn FROM s",
        )
        + f"SELECT {day_sql('time', 'px.time')}, row, col, red, nir FROM px JOIN r ON r.time = px.time AND rn = 1"
    )


@query("least_cloudy_monthly", _least_cloudy_sql("sum(scl)", "last_day(time)"))
def _(spark, d):
    px = B.pixels(spark, d)
    return composite.least_cloudy_monthly(px, "scl", BANDS).select(day(), *CELL, *BANDS)


@query("least_cloudy_calendar_month", _least_cloudy_sql("sum(scl)", "month(time)"))
def _(spark, d):
    px = B.pixels(spark, d)
    return composite.least_cloudy_monthly(px, "scl", BANDS, calendar_month=True).select(day(), *CELL, *BANDS)


@query("most_valid_monthly", _least_cloudy_sql(f"-(count(CASE WHEN {CLEAR} THEN red END))", "last_day(time)"))
def _(spark, d):
    px = B.pixels(spark, d)
    masked = px.withColumn("ok", F.when(~F.col("scl").isin(*composite.INVALID_SCENE_CLASSES), F.col("red")))
    return composite.least_cloudy_monthly(masked, None, ["ok"]).select(day(), *CELL, *BANDS)


_REDUCERS = {
    "min": "min(red)",
    "max": "max(red)",
    "mean": "avg(red)",
    "median": "median(red)",
    "first": "arg_min(red, CASE WHEN red IS NOT NULL THEN time END)",
    "last": "arg_max(red, CASE WHEN red IS NOT NULL THEN time END)",
}


def _reducer(how: str, expr: str) -> None:
    masked = "SELECT time, row, col, CASE WHEN scl IN (4, 5, 6) THEN red END AS red FROM px"

    @query(f"time_{how}_per_cell", B.sql("px", c=masked) + f"SELECT row, col, {expr} AS red FROM c GROUP BY 1, 2")
    def run(spark, d):
        px = tables.mask_classes(B.pixels(spark, d), "scl", ["red"], keep=(4, 5, 6))
        return composite.reduce_time(px, ["red"], how).select(*CELL, "red")


for _how, _expr in _REDUCERS.items():
    _reducer(_how, _expr)


def _mosaic(order: str, sql_order: str) -> None:
    @query(
        f"mosaic_{order}",
        B.sql(
            "px",
            r=f"SELECT row, col, red, row_number() OVER (PARTITION BY row, col ORDER BY {sql_order}) AS rn FROM px WHERE scl IN (4, 5, 6)",
            cells="SELECT DISTINCT row, col FROM px",
        )
        + "SELECT cells.row, cells.col, r.red FROM cells LEFT JOIN r ON r.row = cells.row AND r.col = cells.col AND rn = 1",
    )
    def run(spark, d):
        px = tables.mask_classes(B.pixels(spark, d), "scl", ["red"], keep=(4, 5, 6))
        return composite.mosaic(px, ["red"], order, cloud="blue").select(*CELL, "red")


_mosaic("most_recent", "time DESC")
_mosaic("least_recent", "time")
_mosaic("least_cloud", "blue, time")


def _quartile_sql(by: str) -> str:
    group = ", ".join(str(i) for i in range(1, 4 if by else 3))
    pick = ", ".join(
        f"list_sort(list({b}) FILTER (WHERE {CLEAR}))[CAST(floor(count(*) FILTER (WHERE {CLEAR}) / 4.0) AS INT) + 1] AS {b}"
        for b in ("red", "nir", "blue")
    )
    return f"SELECT {by}row, col, {pick} FROM px GROUP BY {group}"


@query("first_quartile_composite", B.sql("px", q=_quartile_sql("")) + "SELECT row, col, red, nir, blue FROM q")
def _(spark, d):
    px = B.pixels(spark, d)
    return composite.quartile_composite(px, ["red", "nir", "blue"], "scl").select(*CELL, "red", "nir", "blue")


@query(
    "first_quartile_composite_int16",
    B.sql("px", q=_quartile_sql("last_day(time) AS month, "))
    + f"SELECT {day_sql('month')}, row, col, CAST(coalesce(red * 100, -32768) AS BIGINT) AS red,"
    " CAST(coalesce(blue * 100, -32768) AS BIGINT) AS blue,"
    " CAST(coalesce(round((nir - red) / nullif(nir + red, 0) * 100), -32768) AS BIGINT) AS ndvi FROM q",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("month", F.last_day("time"))
    out = composite.quartile_composite_int16(px, "nir", ["red", "blue"], "scl", by=["month"], k=100.0)
    return out.select(day("month"), *CELL, *[F.col(c).cast("bigint").alias(c) for c in ("red", "blue", "ndvi")])


BEST = "SELECT time, avg(CASE WHEN scl IN (3, 8, 9) THEN 1.0::DOUBLE ELSE 0.0 END) AS cloud_fraction FROM px GROUP BY 1 ORDER BY 2, 1 LIMIT 12"


def _cloudy():
    return F.col("scl").isin(3, 8, 9)


@query("best_timesteps", B.sql("px", b=BEST) + f"SELECT {day_sql()}, cloud_fraction FROM b")
def _(spark, d):
    return composite.best_timesteps(B.pixels(spark, d), _cloudy(), 12).select(day(), "cloud_fraction")


@query(
    "pixels_of_best_timesteps",
    B.sql("px", b=BEST) + f"SELECT {day_sql()}, row, col, red FROM px WHERE time IN (SELECT time FROM b)",
)
def _(spark, d):
    return composite.filter_best_timesteps(B.pixels(spark, d), _cloudy(), 12).select(day(), *CELL, "red")


@query(
    "fused_pixels",
    "SELECT strftime(l_shipdate, '%Y-%m-%d') AS time, CAST(l_suppkey % 16 AS INT) AS row, CAST(l_partkey % 16 AS INT) AS col,"
    " arg_min(l_quantity, (l_orderkey, l_linenumber, l_quantity)) AS red FROM lineitem GROUP BY 1, 2, 3",
)
def _(spark, d):
    raw = B.table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("time"),
        (F.col("l_suppkey") % 16).cast("int").alias("row"),
        (F.col("l_partkey") % 16).cast("int").alias("col"),
        F.col("l_quantity").alias("red"),
        "l_orderkey",
        "l_linenumber",
    )
    return composite.fuse_pixels(raw, ["red"], ["l_orderkey", "l_linenumber"]).select(day(), *CELL, "red")


# ---- change -----------------------------------------------------------------------

YEARLY = "SELECT year(time) AS year, row, col, median(red) AS red, median(nir) AS nir FROM px GROUP BY 1, 2, 3"
FOREST = "CASE WHEN (nir - red) / nullif(nir + red, 0) > 0.4 THEN 1 ELSE 0 END"
CHANGE = f"SELECT year, row, col, {FOREST} - lag({FOREST}) OVER (PARTITION BY row, col ORDER BY year) AS change FROM y"
RES = (10.0, 10.0)


def _yearly(spark, d):
    px = B.pixels(spark, d).withColumn("year", F.year("time").cast("bigint"))
    return composite.reduce_time(px, ["red", "nir"], "median", by=["year"])


def _forest():
    return I.threshold_class(I.ndvi("nir", "red"), 0.4)


@query(
    "class_area_per_year",
    B.sql("px", y=YEARLY) + f"SELECT year, sum({FOREST}) * 100.0::DOUBLE / 1000000.0::DOUBLE AS area_km2 FROM y GROUP BY 1",
)
def _(spark, d):
    return change.class_area_km2(_yearly(spark, d), _forest(), RES, ["year"])


@query(
    "class_change",
    B.sql("px", y=YEARLY, c=CHANGE) + "SELECT year, row, col, CAST(change AS BIGINT) AS change FROM c WHERE change IS NOT NULL",
)
def _(spark, d):
    c = change.class_change(_yearly(spark, d), _forest())
    return c.select("year", *CELL, F.col("change").cast("bigint"))


@query(
    "cumulative_class_loss",
    B.sql(
        "px",
        y=YEARLY,
        c=CHANGE,
        a="SELECT year, sum(CASE WHEN change = -1 THEN 1 ELSE 0 END) * 100.0::DOUBLE / 1000000.0::DOUBLE AS a FROM c WHERE change IS NOT NULL GROUP BY 1",
    )
    + f"SELECT year, {rounded_sql('sum(a) OVER (ORDER BY year)')} AS cum_loss_km2 FROM a",
)
def _(spark, d):
    c = change.cumulative_loss(_yearly(spark, d), _forest(), RES)
    return c.select("year", rounded("cum_loss_km2").alias("cum_loss_km2"))


def _periods(spark, d):
    px = B.pixels(spark, d).withColumn("ndvi", I.ndvi("nir", "red"))
    split = F.to_timestamp_ntz(F.lit("1998-07-01"))
    pre = composite.reduce_time(px.where(F.col("time") < split), ["ndvi", "red"], "max")
    post = composite.reduce_time(px.where(F.col("time") >= split), ["ndvi", "red"], "min")
    return pre, post


PERIODS = {
    "v": "SELECT time, row, col, red, (nir - red) / nullif(nir + red, 0) AS ndvi FROM px",
    "pre": "SELECT row, col, max(ndvi) AS ndvi, max(red) AS red FROM v WHERE time < TIMESTAMP '1998-07-01' GROUP BY 1, 2",
    "post": "SELECT row, col, min(ndvi) AS ndvi, min(red) AS red FROM v WHERE time >= TIMESTAMP '1998-07-01' GROUP BY 1, 2",
}


@query(
    "period_difference",
    B.sql("px", **PERIODS) + "SELECT row, col, pre.red - post.red AS red, pre.ndvi - post.ndvi AS ndvi FROM pre JOIN post USING (row, col)",
)
def _(spark, d):
    return raster.period_difference(*_periods(spark, d), ["red", "ndvi"])


@query(
    "fire_flag",
    B.sql("px", **PERIODS)
    + "SELECT row, col, pre.ndvi - post.ndvi AS diff, CAST(pre.ndvi - post.ndvi > 1.95 AS INT) AS burnt FROM pre JOIN post USING (row, col)",
)
def _(spark, d):
    f = change.fire_flag(*_periods(spark, d), "ndvi", 1.95)
    return f.select(*CELL, "diff", F.col("burnt").cast("int"))


@query(
    "soil_moisture",
    B.sql(
        "px",
        cur="SELECT row, col, arg_max(nir, time) AS v FROM px WHERE time >= TIMESTAMP '2000-01-01' GROUP BY 1, 2",
        ref="SELECT row, col, min(nir) AS lo, max(nir) AS hi, avg(nir) AS mean FROM px WHERE time < TIMESTAMP '2000-01-01' GROUP BY 1, 2",
    )
    + "SELECT row, col, CASE WHEN 10 * log10(mean) BETWEEN 17.2 AND 17.4 THEN (v - lo) / nullif(hi - lo, 0) END AS ssm"
    " FROM cur JOIN ref USING (row, col)",
)
def _(spark, d):
    px = B.pixels(spark, d)
    split = F.to_timestamp_ntz(F.lit("2000-01-01"))
    return change.soil_moisture(px.where(F.col("time") >= split), px.where(F.col("time") < split), "nir", 17.2, 17.4)
