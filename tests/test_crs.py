"""Golden points from published coordinate examples and round trips."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pixelfold.functions.crs import reproject, reproject_xy
from pixelfold.functions.geometry import GEOM_DDL


def move(spark, x, y, a, b):
    df = spark.range(1).select(*[c.alias(n) for c, n in zip(reproject_xy(F.lit(float(x)), F.lit(float(y)), a, b), "xy")])
    return tuple(df.first())


def test_web_mercator(spark):
    x, y = move(spark, -100.3333333333, 24.3817869444, 4326, 3857)
    assert (x, y) == (pytest.approx(-11169055.58, abs=0.05), pytest.approx(2800000.0, abs=0.05))


def test_utm_on_the_central_meridian(spark):
    assert move(spark, 3.0, 0.0, 4326, 32631) == (pytest.approx(500000.0, abs=1e-6), pytest.approx(0.0, abs=1e-6))
    # Meridian arc from the equator to 45 degrees is 4984944.378 m, times the scale factor.
    assert move(spark, 3.0, 45.0, 4326, 32631)[1] == pytest.approx(4984944.378 * 0.9996, abs=0.01)
    assert move(spark, 153.0, -26.0, 4326, 32756)[1] == pytest.approx(10000000 - move(spark, 153.0, 26.0, 4326, 32656)[1], abs=1e-6)


def test_utm_known_tower(spark):
    # 43 38 33.24 N, 79 23 13.7 W lies at 630084 m E, 4833439 m N in zone 17.
    x, y = move(spark, -(79 + 23 / 60 + 13.7 / 3600), 43 + 38 / 60 + 33.24 / 3600, 4326, 32617)
    assert (x, y) == (pytest.approx(630084, abs=1.5), pytest.approx(4833438.6, abs=1.5))


def test_european_equal_area(spark):
    x, y = move(spark, 5.0, 50.0, 4326, 3035)
    assert (x, y) == (pytest.approx(3962799.45, abs=0.02), pytest.approx(2999718.85, abs=0.02))
    assert move(spark, 10.0, 52.0, 4326, 3035) == (pytest.approx(4321000.0), pytest.approx(3210000.0))


@pytest.mark.parametrize("srid,lon,lat", [(3857, 151.2, -33.9), (32756, 152.4, -25.1), (32632, 8.5, 47.4), (3035, 21.0, 61.0), (3035, -8.0, 40.0)])
def test_round_trip(spark, srid, lon, lat):
    x, y = move(spark, lon, lat, 4326, srid)
    assert move(spark, x, y, srid, 4326) == (pytest.approx(lon, abs=1e-8), pytest.approx(lat, abs=1e-8))


def test_unknown_system_is_refused(spark):
    with pytest.raises(ValueError, match="unsupported"):
        move(spark, 1, 1, 4326, 27700)


@pytest.mark.parametrize("a,b,name,times", [(4326, 32631, "ATANH(", 3), (32631, 4326, "ATAN2(", 1), (32631, 4326, "ASIN(", 1), (4326, 3035, "ASIN(", 1), (3035, 4326, "HYPOT(", 1), (3035, 32631, "HYPOT(", 1)])
def test_each_value_is_computed_once(spark, a, b, name, times):
    plan = spark.createDataFrame([], f"geom {GEOM_DDL}").select(reproject("geom", a, b).alias("moved"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(name) == times
