from __future__ import annotations

from datetime import datetime, timedelta

import geo
from pyspark.sql import functions as F

from pixelfold.operators import zonal
from pixelfold.operators.grid import Grid
from pixelfold.streaming import incremental

GRID = Grid(0, 0, 1, 1, 6, 6)
SCHEMA = "time timestamp_ntz, row int, col int, v double"


def arrive(spark, folder, days, value=1.0):
    t0 = datetime(2024, 1, 1)
    data = [(t0 + timedelta(days=d, hours=r), r, c, value * (d * 7 + r * 3 + c)) for d in days for r in range(6) for c in range(6)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, src, out, chk, z):
    px = incremental.read_pixel_stream(spark, src, SCHEMA)
    q = incremental.run_available(incremental.zonal_mean_stream(px, z, GRID, "zone", ["v"], delay="2 days"), out, chk)
    q.awaitTermination()
    return q


def test_stream_equals_batch_and_late_rows_are_counted(spark, tmp_path, rows):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    z = geo.layer(spark, hexagon=geo.HEXAGON, ell=geo.L_SHAPE)
    arrive(spark, src, range(0, 5))
    run(spark, src, out, chk, z)
    first = rows(spark.read.parquet(out), "zone", "window_start", "v_mean")
    assert first
    arrive(spark, src, range(5, 12))
    run(spark, src, out, chk, z)
    px = spark.read.schema(SCHEMA).parquet(src).withColumn("time", F.date_trunc("day", F.col("time").cast("timestamp")))
    batch = rows(zonal.zonal_mean(px, z, GRID, "zone", ["v"]))
    got = rows(spark.read.parquet(out), "zone", "window_start", "v_mean")
    closed = [b for b in batch if b[1] + timedelta(days=1) <= max(r[1] for r in got) + timedelta(days=1)]
    assert got == closed and set(first) <= set(got) and len(got) > len(first)
    arrive(spark, src, [0], value=100.0)
    q = run(spark, src, out, chk, z)
    assert incremental.dropped_late_rows(q) > 0
    again = rows(spark.read.parquet(out), "zone", "window_start", "v_mean")
    assert again == got


def test_first_valid_pixel_updates(spark, tmp_path, rows):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    arrive(spark, src, [3])
    for days in ([], [1]):
        if days:
            arrive(spark, src, days, value=2.0)
        px = incremental.read_pixel_stream(spark, src, SCHEMA)
        incremental.run_available_updates(incremental.first_valid_stream(px, "v", mask=F.col("v") > 40), out, chk).awaitTermination()
        want = (
            spark.read.schema(SCHEMA).parquet(src).where("v <= 40").groupBy("row", "col").agg(F.min_by("v", "time").alias("value"))
        )
        assert rows(incremental.latest_updates(spark, out, ["row", "col"]), "row", "col", "value") == rows(want)


def test_updates_hold_every_window_and_late_rows_are_counted(spark, tmp_path, rows):
    src, out, chk, late, late_chk = (str(tmp_path / n) for n in ("src", "out", "chk", "late", "late_chk"))
    z = geo.layer(spark, hexagon=geo.HEXAGON, ell=geo.L_SHAPE)
    labels = zonal.rasterize(z, GRID, "zone", overlap=True)
    for days in (range(0, 5), range(5, 12), [0, 11]):
        arrive(spark, src, days)
        px = incremental.read_pixel_stream(spark, src, SCHEMA)
        means = incremental.zonal_mean_stream_of_labels(px, labels, "zone", ["v"], delay="2 days")
        incremental.run_available_updates(means, out, chk).awaitTermination()
        incremental.count_late_rows(px, late, late_chk, delay="2 days").awaitTermination()
    px = spark.read.schema(SCHEMA).parquet(src).withColumn("time", F.date_trunc("day", F.col("time").cast("timestamp")))
    # Day 0 came again too late, day 11 twice: the means stay those of the whole table.
    assert rows(incremental.latest_updates(spark, out, ["zone", "window_start"]), "zone", "window_start", "v_mean") == rows(zonal.zonal_mean(px, z, GRID, "zone", ["v"]))
    assert rows(spark.read.parquet(late), incremental.BATCH, "rows", "late") == [(0, 180, 0), (1, 252, 0), (2, 72, 36)]
