"""Properties of the physical plans that matter on large data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from pixelfold.operators import zonal
from pixelfold.plans import bindings as B

SPATIAL = [
    "zonal_mean", "zonal_stats_all_zones", "zonal_weighted_mean_min", "all_touched_zero_filled_stats", "zonal_monthly_ndvi",
    "overlay_intersection", "spatial_join_intersects", "keep_intersecting", "drop_intersecting", "within_parent",
    "within_union_of_parents", "children_per_parent", "nearest_pixel_of_points", "features_by_tile", "zonal_percentiles",
    "crosstab_percentage", "resample_to_other_grid", "period_difference", "least_cloudy_monthly",
]
# Polygons are cut and covered by a sweep over Arrow batches; a user's statistic is Python by nature.
SWEPT = {"zonal_user_statistic"} | {n for n in entry.queries() if n.startswith(("overlay", "within_union"))}
NO_PYTHON = [
    n for n in entry.queries()
    if n.startswith(("zonal_", "monthly_", "mosaic_", "time_", "first_quartile", "crosstab", "within")) and n not in SWEPT
]


@pytest.fixture(autouse=True, scope="module")
def whole_filters(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SPATIAL)
def test_no_nested_loop_join(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_in_the_plan(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert "Python" not in text and "InPandas" not in text and "InArrow" not in text


def test_zone_bounds_and_bands_reach_the_scan(spark, sf, tmp_path):
    B.pixels(spark, sf).write.parquet(str(tmp_path / "px"))
    px = spark.read.parquet(str(tmp_path / "px"))
    corner = B.zones(spark, sf).where("zone_order = 0")
    text = plan(zonal.zonal_mean(px, corner, B.PX_GRID, "zone_key", ["red"]))
    assert "LessThanOrEqual(row,3)" in text and "LessThanOrEqual(col,3)" in text
    assert "ReadSchema: struct<time:timestamp_ntz,row:int,col:int,red:double>" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_pixels_are_not_shuffled_for_scene_selection(spark, sf, tmp_path):
    from pixelfold.operators.composite import least_cloudy_monthly

    B.pixels(spark, sf).write.parquet(str(tmp_path / "px"))
    px = spark.read.parquet(str(tmp_path / "px"))
    text = plan(least_cloudy_monthly(px, "scl", ["red"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_flagship_exchanges(spark, sf, tmp_path):
    """One exchange by cell and month, one by zone and month."""
    from pixelfold.operators.composite import monthly_median

    B.pixels(spark, sf).write.parquet(str(tmp_path / "px"))
    px = spark.read.parquet(str(tmp_path / "px"))
    m = monthly_median(px, ["red"]).withColumnRenamed("month", "time")
    text = plan(zonal.zonal_mean(m, B.zones(spark, sf), B.PX_GRID, "zone_key", ["red"]))
    assert text.count("Exchange hashpartitioning") == 2
