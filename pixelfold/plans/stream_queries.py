"""Streaming runs over everything that is there; the results equal a batch run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import incremental
from . import bindings as B
from .registry import day, day_sql, query
from .sizing import shared_folder
from .zone_queries import INSIDE, KEY

OBSERVED = (
    "SELECT l_shipdate AS time, CAST(l_suppkey % 16 AS INT) AS row, CAST(l_partkey % 16 AS INT) AS col, l_quantity AS red, l_tax FROM lineitem"
)


def _observations(spark, d):
    """Line items as arriving pixel observations."""
    schema = B.table(spark, d, "lineitem").schema
    raw = incremental.read_pixel_stream(spark, d, schema, pattern="lineitem.parquet")
    return raw.select(
        F.col("l_shipdate").cast("timestamp").alias("time"),
        (F.col("l_suppkey") % 16).cast("int").alias("row"),
        (F.col("l_partkey") % 16).cast("int").alias("col"),
        F.col("l_quantity").alias("red"),
        "l_tax",
    )


@query(
    "streamed_zonal_mean",
    B.sql("zn", o=OBSERVED)
    + f"SELECT zone_key, {day_sql('window_start', 'time')}, avg(red) AS red_mean FROM o JOIN zn ON {INSIDE}"
    " GROUP BY 1, 2",
)
def _(spark, d):
    out, chk = shared_folder(spark, "zonal-stream"), shared_folder(spark, "zonal-stream-checkpoint")
    means = incremental.zonal_mean_stream(_observations(spark, d), B.zones(spark, d), B.PX_GRID, KEY, ["red"])
    incremental.run_available_updates(means, out, chk).awaitTermination()
    return incremental.latest_updates(spark, out, [KEY, "window_start"]).select(KEY, day("window_start"), "red_mean")


@query(
    "streamed_first_valid_pixel",
    B.sql(o=OBSERVED)
    + f"SELECT row, col, arg_min(red, (time, red)) AS value, {day_sql('since', 'min(time)')} FROM o WHERE l_tax >= 0.04 GROUP BY 1, 2",
)
def _(spark, d):
    out, chk = shared_folder(spark, "first-valid"), shared_folder(spark, "first-valid-checkpoint")
    state = incremental.first_valid_stream(_observations(spark, d), "red", mask=F.col("l_tax") < 0.04)
    incremental.run_available_updates(state, out, chk).awaitTermination()
    return incremental.latest_updates(spark, out, ["row", "col"]).select("row", "col", "value", day("since"))


@query(
    "streamed_late_rows",
    B.sql(
        o="SELECT l_shipdate AS time, l_linenumber = 7 AS second FROM lineitem",
        e="SELECT max(time) AS newest FROM o WHERE NOT second",
    )
    + "SELECT CAST(second AS BIGINT) AS batch, count(*) AS rows,"
    " count(CASE WHEN second AND time + INTERVAL 1 DAY <= newest - INTERVAL 30 DAY THEN 1 END) AS late FROM o, e GROUP BY 1",
)
def _(spark, d):
    # The seventh lines of the orders arrive after all others.
    src, out, chk = (shared_folder(spark, n) for n in ("arrivals", "late-rows", "late-rows-checkpoint"))
    lines = B.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("time"), "l_linenumber")
    for arrival in (F.col("l_linenumber") != 7, F.col("l_linenumber") == 7):
        part = lines.where(arrival).select("time")
        part.write.mode("append").parquet(src)
        arriving = incremental.read_pixel_stream(spark, src, part.schema)
        incremental.count_late_rows(arriving, out, chk).awaitTermination()
    return spark.read.parquet(out).select(F.col(incremental.BATCH).cast("bigint").alias("batch"), "rows", "late")
