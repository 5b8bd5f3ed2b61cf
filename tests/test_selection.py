"""Rank selection and mergeable user aggregates against numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pixelfold.operators import selection
from pixelfold.operators.selection import select_mad, select_quantiles
from pixelfold.operators.user_aggregates import UserAggregate, aggregate_by

PROBS = {"p0": 0.0, "p1": 0.01, "p10": 0.1, "p50": 0.5, "near": 0.5005, "p90": 0.9, "p100": 1.0}


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(11)
    return {
        "hot": rng.normal(size=60_000),
        "ties": rng.integers(0, 4, 20_000).astype(float),
        "skewed": rng.pareto(0.7, 5_000) * rng.choice([-1, 1], 5_000),
        "few": rng.normal(size=7),
        "two": np.array([3.0, -1.0]),
        "one": np.array([1.5]),
        None: rng.normal(size=300),
    }


@pytest.fixture(scope="module")
def frame(spark, groups):
    rows = pd.concat([pd.DataFrame({"k": [k] * len(v), "v": v}) for k, v in groups.items()], ignore_index=True)
    rows = rows.sample(frac=1, random_state=1)
    df = spark.createDataFrame(list(zip(rows.k.where(rows.k.notna(), None), rows.v.astype(float))), "k string, v double")
    gone = spark.createDataFrame([("hot", None), ("few", float("nan")), ("empty", None)], "k string, v double")
    return df.unionByName(gone).repartition(6)


@pytest.mark.parametrize("accuracy", [40, 10_000])
def test_ranks_are_exact_whatever_the_sketch(spark, groups, frame, accuracy):
    got = {r["k"]: r for r in select_quantiles(frame, ["k"], F.col("v"), PROBS, accuracy).collect()}
    assert set(got) == set(groups)
    for k, vals in groups.items():
        for n, p in PROBS.items():
            assert got[k][n] == pytest.approx(np.quantile(vals, p), rel=1e-12, abs=1e-12), (k, n)


def test_median_absolute_deviation(spark, groups, frame):
    got = {r["k"]: r["mad"] for r in select_mad(frame, ["k"], F.col("v"), accuracy=40).collect()}
    for k, vals in groups.items():
        assert got[k] == pytest.approx(np.median(np.abs(vals - np.median(vals))), abs=1e-12), k


def test_the_shuffled_path_gives_the_same(spark, frame, rows, monkeypatch):
    want = rows(select_quantiles(frame, ["k"], F.col("v"), PROBS))
    monkeypatch.setattr(selection, "small_side", lambda df: df.hint("merge"))
    spread = select_quantiles(frame, ["k"], F.col("v"), PROBS)
    assert "SortMergeJoin" in spread._jdf.queryExecution().executedPlan().toString()
    assert rows(spread) == want


def test_only_values_near_a_wanted_rank_travel(spark, frame):
    """Rows behind the last exchange: a share of the hot group set by the accuracy, not the group."""
    values = frame.where("k = 'hot' AND v IS NOT NULL").select("k", F.col("v").alias("_v"))
    b = selection._brackets(values, ["k"], {"p50": 0.5}, 1000).first()
    assert b["_total"] == 60_000
    assert 0 < values.where(F.col("_v").between(b["_lo0"], b["_hi0"])).count() <= 60_000 * 8 / 1000


def test_an_empty_frame_has_no_group(spark, frame):
    assert select_quantiles(frame.limit(0), ["k"], F.col("v"), PROBS).count() == 0
    assert select_mad(frame.limit(0), ["k"], F.col("v")).count() == 0


LOG_MEAN = UserAggregate(
    init=lambda: np.zeros(2),
    update=lambda s, v: s + [np.log(np.abs(v) + 1).sum(), len(v)],
    merge=lambda a, b: a + b,
    finish=lambda s: float(s[0] / s[1]),
)


def test_states_of_a_hot_group_are_merged(spark, groups, frame):
    spread = frame.repartition(150)
    got = {r["k"]: r["g"] for r in aggregate_by(spread.where("NOT isnan(v)"), ["k"], "v", LOG_MEAN, "g").collect()}
    assert set(got) == set(groups)
    for k, vals in groups.items():
        assert got[k] == pytest.approx(np.log(np.abs(vals) + 1).mean()), k


def test_states_may_grow_and_keys_may_be_many(spark):
    """A set as state: distinct values; two keys, one of them a date, more groups than a task keeps open."""
    distinct = UserAggregate(
        init=lambda: np.array([]), update=np.union1d, merge=np.union1d, finish=lambda s: float(len(s)) if len(s) > 1 else float("nan")
    )
    df = spark.range(120_000).select(
        (F.col("id") % 30_000).alias("a"), F.expr("date'2024-01-01' + cast(id % 2 as int)").alias("day"), (F.col("id") % 7).alias("v")
    )
    got = aggregate_by(df, ["a", "day"], "v", distinct, "n")
    want = df.groupBy("a", "day").agg(F.countDistinct("v").alias("n")).withColumn("n", F.when(F.col("n") > 1, F.col("n").cast("double")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert aggregate_by(df.limit(0), ["a", "day"], "v", distinct, "n").count() == 0
