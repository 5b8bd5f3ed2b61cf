from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pixelfold.functions import indices as I
from pixelfold.functions import values as V
from pixelfold.operators import change, series, tables


def frame(spark, values, key="a", step=3):
    d0 = date(2024, 1, 1)
    return spark.createDataFrame(
        [(key, d0 + timedelta(days=i * step + (i % 2)), v) for i, v in enumerate(values)], "k string, day date, value double"
    )


def test_interpolation_against_pandas(spark):
    vals = [None, None, 1.0, None, 4.0, None, None, 2.0, None]
    df = frame(spark, vals)
    s = pd.Series(vals, index=pd.to_datetime([r["day"] for r in df.orderBy("day").collect()]), dtype=float)
    both = [r["value"] for r in series.interpolate_time(df, "k", "day", "value").orderBy("day").collect()]
    assert both == pytest.approx(s.interpolate(method="time", limit_direction="both").tolist())
    inside = [r["value"] for r in series.interpolate_time(df, "k", "day", "value", "inside").orderBy("day").collect()]
    want = s.interpolate(method="time", limit_area="inside").tolist()
    assert [v if v is not None else np.nan for v in inside] == pytest.approx(want, nan_ok=True)


def test_savgol_reproduces_a_parabola_and_skips_short_series(spark):
    quad = [0.5 * i * i - 3 * i + 2 for i in range(9)]
    out = [r["smooth"] for r in series.savgol_5_2(frame(spark, quad), "k", "day", "value").orderBy("day").collect()]
    assert out == pytest.approx(quad)
    assert {r["smooth"] for r in series.savgol_5_2(frame(spark, quad[:4]), "k", "day", "value").collect()} == {None}


def test_savgol_against_local_fits(spark):
    vals = np.random.default_rng(1).normal(size=12).tolist()
    out = [r["smooth"] for r in series.savgol_5_2(frame(spark, vals), "k", "day", "value").orderBy("day").collect()]
    for i in range(12):
        start = min(max(i - 2, 0), 7)
        x = np.arange(start, start + 5)
        assert out[i] == pytest.approx(np.polyval(np.polyfit(x, vals[start : start + 5], 2), i))


def test_cubic_resample_follows_a_cubic(spark):
    cubic = [0.01 * (i * 3 + i % 2) ** 3 - (i * 3 + i % 2) for i in range(8)]
    out = series.cubic_resample(frame(spark, cubic), "k", "day", "value").orderBy("t").collect()
    assert len(out) == 24
    t0 = out[0]["t"]
    for r in out:
        x = (r["t"] - t0) / 86400
        assert r["value"] == pytest.approx(0.01 * x**3 - x, abs=1e-6)
    short = series.cubic_resample(frame(spark, [1.0, 2.0, None, 3.0]), "k", "day", "value")
    assert sorted(r["value"] for r in short.collect()) == [1.0, 2.0, 3.0]


def test_user_function_sees_sorted_unique_times(spark):
    df = frame(spark, [3.0, 1.0, 2.0]).union(frame(spark, [5.0, 1.0, 2.0]))
    out = series.apply_along_time(df, "k", "day", "value", lambda t, v: np.cumsum(v)).orderBy("day").collect()
    assert [r["value"] for r in out] == [4.0, 5.0, 7.0]


def test_date_column_choice_is_global(spark):
    w = spark.createDataFrame([("20240105", "", "1"), ("20240106", "7/3/2024", "2")], "Date string, Date2 string, Rain string")
    assert [r["date"] for r in series.detect_date(w).collect()] == [date(2024, 3, 7)]
    assert [r["date"] for r in series.detect_date(w.drop("Date2")).orderBy("date").collect()] == [date(2024, 1, 5), date(2024, 1, 6)]
    first = spark.createDataFrame([("05-01-2024", "1"), ("bad", "2")], "when string, Rain string")
    assert [r["date"] for r in series.detect_date(first).collect()] == [date(2024, 1, 5)]


def test_weather_sums_and_means_of_present_columns(spark):
    w = spark.createDataFrame(
        [(date(2024, 1, 1), "1.5", "20"), (date(2024, 1, 20), "x", "30"), (date(2024, 2, 1), "x", "5")],
        ["date", "Rain", "T.Max"],
    )
    got = {str(r["month"]): (r["Rain"], r["T.Max"]) for r in series.weather_monthly(w).collect()}
    assert got == {"2024-01-31": (1.5, 25.0), "2024-02-29": (0.0, 5.0)}


def test_slots_match_the_plain_rule(spark):
    edges = series.slot_edges(datetime(2019, 1, 1), datetime(2019, 12, 31), 13)
    assert len(edges) == 13 and edges[0] == date(2019, 1, 1) and edges[1] == date(2019, 1, 29)
    df = spark.createDataFrame([(datetime(2019, 1, 28, 23),), (datetime(2019, 1, 29),), (datetime(2019, 12, 30),)], ["t"])
    out = series.time_slots(df, "t", datetime(2019, 1, 1), datetime(2019, 12, 31), 13).orderBy("t").collect()
    assert [r["slot"] for r in out] == [0, 1]


def test_truthiness_chain(spark):
    df = spark.createDataFrame([(0.0, 5.0), (None, 0.0), (3.0, 4.0), (0.0, None)], "a double, b double")
    assert [r[0] for r in df.select(V.first_truthy("a", "b")).collect()] == [5.0, 0.0, 3.0, None]


def test_nan_and_zero_division_become_null(spark):
    df = spark.createDataFrame([(1.0, -1.0), (float("nan"), 1.0)], "nir double, red double")
    assert df.select(I.ndvi("nir", "red")).first()[0] is None
    assert df.select(V.nan_to_null("nir").alias("v")).agg(F.avg("v")).first()[0] == 1.0
    assert df.select(I.to_db(F.lit(0.0))).first()[0] is None


def test_histogram_and_summary_edge_cases(spark, rows):
    same = spark.createDataFrame([(2.0,), (2.0,), (-1.0,)], "v double")
    assert rows(series.histogram(same, "v", 50)) == [(0, 2)]
    null = spark.createDataFrame([(None,), (2.0,)], "v double")
    assert rows(change.equal_interval(null, "v", 5), "v", "zone") == [(2.0, 0), (None, None)]
    assert rows(null.select(I.gain_clip("v", 9.0))) == [(1.0,), (None,)]
    z = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "zone string")
    res = spark.createDataFrame([("a", "t1", 1.0), ("a", "t2", None), ("b", "t1", None)], "zone string, time string, v double")
    s = series.run_summary(res, z, "zone", "v").first().asDict()
    assert s == dict(processed=1, empty=1, no_data=1, skipped=1, rows=3, unique_keys=2, first_time="t1", last_time="t2")


def test_stack_aligns_by_name(spark, rows):
    a = spark.createDataFrame([(1, 2.0)], "k int, red double")
    b = spark.createDataFrame([(3.0, 2)], "nir double, k int")
    assert rows(tables.stack([a, b]), "k", "red", "nir") == [(1, 2.0, None), (2, None, 3.0)]
