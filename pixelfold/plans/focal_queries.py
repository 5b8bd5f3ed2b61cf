"""Neighbourhood operators over every time slice."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import composite, focal, tables
from . import bindings as B
from .registry import day, day_sql, query, rounded, rounded_sql

CELL = ["row", "col"]
NEAR = "a.time = b.time AND abs(a.row - b.row) <= {r} AND abs(a.col - b.col) <= {r}"
GAUSS = "exp(-0.5 * (power((a.row - b.row) / 1.6::DOUBLE, 2) + power((a.col - b.col) / 1.6::DOUBLE, 2)))"
NORM = "(SELECT power(sum(exp(-0.5 * power((range - 5) / 1.6::DOUBLE, 2))), 2) FROM range(11))"
DILATED = (
    "SELECT a.time, a.row, a.col, a.red, sum(CASE WHEN b.scl IN (3, 8, 9, 10) THEN " + GAUSS + f" ELSE 0 END) / {NORM} AS s"
    " FROM px a JOIN px b ON " + NEAR.format(r=5) + " GROUP BY 1, 2, 3, 4"
)


def _clouds(spark, d):
    return B.pixels(spark, d).select("time", *CELL, F.col("scl").isin(3, 8, 9, 10).alias("mask"))


@query(
    "dilated_cloud_mask",
    B.sql("px", s=DILATED) + f"SELECT {day_sql()}, row, col, CAST(s > 0.1 AS INT) AS mask FROM s",
)
def _(spark, d):
    m = focal.dilate_mask(_clouds(spark, d), "mask", unique=True)
    return m.select(day(), *CELL, F.col("mask").cast("int"))


def _best_available(name: str, reducer: str, pick: str) -> None:
    @query(
        name,
        B.sql("px", s=DILATED)
        + f"SELECT row, col, {pick}(CASE WHEN s <= 0.1 THEN red END, CASE WHEN s <= 0.1 THEN time END) AS red FROM s GROUP BY 1, 2",
    )
    def run(spark, d):
        clouds = B.pixels(spark, d).withColumn("mask", F.col("scl").isin(3, 8, 9, 10))
        px = focal.dilate_mask(clouds, "mask", unique=True, carry=["red"])
        return composite.best_available_pixel(px, ["red"], "mask", reducer)


_best_available("best_available_pixel_first", "first", "arg_min")
_best_available("best_available_pixel_last", "last", "arg_max")

KERNEL = ((1.0, 2.0, 1.0), (2.0, 4.0, 2.0), (1.0, 2.0, 3.0))


@query(
    "kernel_convolution",
    B.sql(
        "px",
        k="SELECT * FROM (VALUES "
        + ", ".join(f"({i - 1}, {j - 1}, {w}::DOUBLE)" for i, r in enumerate(KERNEL) for j, w in enumerate(r))
        + ") AS t(dr, dc, w)",
    )
    + f"SELECT {day_sql('time', 'a.time')}, a.row, a.col, sum(w * b.red) AS value FROM px a JOIN px b ON {NEAR.format(r=1)}"
    " JOIN k ON b.row - a.row = dr AND b.col - a.col = dc GROUP BY 1, 2, 3",
)
def _(spark, d):
    out = focal.apply_kernel(B.pixels(spark, d), KERNEL, "red", "value", unique=True)
    return out.select(day(), *CELL, "value")


@query(
    "sobel_edges",
    B.sql(
        "px",
        g="SELECT a.time, a.row, a.col, sum(b.nir * (b.col - a.col) * (2 - abs(b.row - a.row))) AS gx,"
        f" sum(b.nir * (b.row - a.row) * (2 - abs(b.col - a.col))) AS gy FROM px a JOIN px b ON {NEAR.format(r=1)} GROUP BY 1, 2, 3",
    )
    + f"SELECT {day_sql()}, row, col, {rounded_sql('sqrt(gx * gx + gy * gy)')} AS edge FROM g",
)
def _(spark, d):
    out = focal.sobel(B.pixels(spark, d), "nir", unique=True)
    return out.select(day(), *CELL, rounded("edge").alias("edge"))


def _local_max(block):
    a = np.where(np.isnan(block["red"]), -np.inf, block["red"])
    p = np.pad(a, 2, constant_values=-np.inf)
    n, m = a.shape
    return {"local_max": np.max([p[i : i + n, j : j + m] for i in range(5) for j in range(5)], axis=0)}


@query(
    "function_on_blocks",
    B.sql("px")
    + f"SELECT {day_sql('time', 'a.time')}, a.row, a.col, max(b.red) AS local_max FROM px a JOIN px b ON {NEAR.format(r=2)} GROUP BY 1, 2, 3",
)
def _(spark, d):
    out = focal.apply_neighborhood(B.pixels(spark, d), _local_max, ["red"], ["local_max"], size=8, overlap=2)
    return out.select(day(), *CELL, "local_max")


def _spread(samples):
    return {"spread": samples["red"].max() - samples["red"].min()}


@query("function_per_pixel", B.sql("px") + "SELECT row, col, max(red) - min(red) AS spread FROM px GROUP BY 1, 2")
def _(spark, d):
    return focal.evaluate_pixels(B.pixels(spark, d), _spread, ["red"], ["spread"], block=4)


@query(
    "function_per_pixel_and_month",
    B.sql("px") + "SELECT strftime(time, '%Y-%m') AS month, row, col, max(red) - min(red) AS spread FROM px GROUP BY 1, 2, 3",
)
def _(spark, d):
    px = B.pixels(spark, d).withColumn("month", F.date_format("time", "yyyy-MM"))
    return focal.evaluate_pixels(px, _spread, ["red"], ["spread"], by=["month"], unique=True)
