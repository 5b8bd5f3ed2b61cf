"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR: one JSON line.

Each query is run to completion (noop sink) once warm and then three times; the
median counts. Pixel and zone-step rates are given for the main queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from pixelfold.plans import bindings as B  # noqa: E402
from pixelfold.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "zonal_monthly_ndvi",
    "zonal_mean",
    "zonal_stats_all_zones",
    "zonal_weighted_mean_min",
    "zonal_percentiles",
    "monthly_median",
    "monthly_median_gap_filled",
    "first_quartile_composite",
    "least_cloudy_monthly",
    "mosaic_most_recent",
    "crosstab_percentage",
    "class_change",
    "overlay_intersection",
    "spatial_join_intersects",
    "plot_cell_coverage",
    "dilated_cloud_mask",
    "savitzky_golay",
    "interpolated_both_ends",
    "search_items",
    "flattened_items",
    "loaded_cube",
    "page_links",
]
RATED = ["zonal_monthly_ndvi", "zonal_weighted_mean_min", "monthly_median", "first_quartile_composite"]
ZONED = ["zonal_monthly_ndvi", "zonal_weighted_mean_min"]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = sys.argv[1:] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus) if cpus.isdigit() else 8))
        .config("spark.sql.adaptive.enabled", "true")
        # On one machine the smallest useful partition is far below the 64 MB of a cluster.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "true")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    n_px = B.pixels(spark, d).count()
    zone_steps = {n: QUERIES[n](spark, d).count() for n in ZONED if n in names}
    line = {
        "metric": "headline queries, median of warm runs, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "pixels_per_sec": {n: round(n_px / seconds[n]) for n in RATED if n in names},
        "zone_steps_per_sec": {n: round(zone_steps[n] / seconds[n]) for n in zone_steps},
        "sf": os.path.basename(d.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
