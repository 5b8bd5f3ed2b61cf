"""Exact order statistics of groups of any size.

``percentile`` keeps a group's distinct values in one task's memory, which is
fine for a cell's samples in a month and wrong for a zone that holds a third of
all pixels. Here a group is first folded to a histogram (value, count) keyed by
group *and* value, then cut into buckets of similar numbers of distinct values,
so that no task ever sorts more than one bucket. The histogram is a small fraction of
the rows and is read by several steps, so it is written once: the pixels behind
it are scanned a single time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..plans.sizing import materialize

# Buckets of a large group; a task sorts about 1/CUTS of its distinct values.
CUTS = 256
# Groups with at most this many distinct values are one bucket.
ONE_BUCKET = 50_000


def histogram_of(df: DataFrame, keys: Sequence[str], value: Column, freq: Column | None = None) -> DataFrame:
    """keys, _v, _n: distinct non-null values with their counts (partial aggregation applies)."""
    n = F.lit(1) if freq is None else freq
    return (
        df.select(*keys, value.cast("double").alias("_v"), n.cast("long").alias("_n"))
        .where(F.col("_v").isNotNull())
        .groupBy(*keys, "_v")
        .agg(F.sum("_n").alias("_n"))
    )


def _ranked(hist: DataFrame, keys: Sequence[str], cuts: int, one_bucket: int) -> DataFrame:
    """Adds _hi (rank of the last copy of the value), _lo (rank before the first) and _total."""
    keys = list(keys)
    probs = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    approx = F.percentile_approx("_v", probs, 10000)
    groups = hist.groupBy(*keys).agg(
        F.sum("_n").alias("_total"),
        F.when(F.count("*") > one_bucket, approx).otherwise(F.array().cast("array<double>")).alias("_cuts"),
    )
    bucketed = hist.join(groups, keys).select(
        *keys, "_v", "_n", "_total", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_b")
    )
    before = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*keys, "_b")
        .agg(F.sum("_n").alias("_s"))
        .select(*keys, "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    )
    run = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = bucketed.join(offsets, [*keys, "_b"])
    return ranked.withColumn("_hi", F.col("_off") + F.sum("_n").over(run)).withColumn(
        "_lo", F.col("_hi") - F.col("_n")
    )


def quantiles_of_histogram(
    hist: DataFrame, keys: Sequence[str], probs: dict[str, float], cuts: int = CUTS, one_bucket: int = ONE_BUCKET
) -> DataFrame:
    """keys + one column per named probability, linear interpolation between ranks."""
    keys = list(keys)
    ranked = _ranked(hist, keys, cuts, one_bucket)
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    aggs: list[Column] = [F.max("_total").alias("_total")]
    for name, p in probs.items():
        h = (F.col("_total") - 1) * F.lit(float(p))
        k1, k2 = F.floor(h) + 1, F.ceil(h) + 1
        aggs.append(F.max(F.when((lo < k1) & (k1 <= hi), v)).alias(f"_a_{name}"))
        aggs.append(F.max(F.when((lo < k2) & (k2 <= hi), v)).alias(f"_b_{name}"))
    g = ranked.groupBy(*keys).agg(*aggs)
    out = []
    for name, p in probs.items():
        h = (F.col("_total") - 1) * F.lit(float(p))
        a, b = F.col(f"_a_{name}"), F.col(f"_b_{name}")
        out.append((a + (b - a) * (h - F.floor(h))).alias(name))
    return g.select(*keys, *out)


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: dict[str, float],
    cuts: int = CUTS,
    one_bucket: int = ONE_BUCKET,
) -> DataFrame:
    hist = materialize(histogram_of(df, keys, value), "value-histogram")
    return quantiles_of_histogram(hist, keys, probs, cuts, one_bucket)


def group_mad(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    name: str = "mad",
    cuts: int = CUTS,
    one_bucket: int = ONE_BUCKET,
) -> DataFrame:
    """Median absolute deviation per group, exact at any group size."""
    keys = list(keys)
    hist = materialize(histogram_of(df, keys, value), "value-histogram")
    med = quantiles_of_histogram(hist, keys, {"_med": 0.5}, cuts, one_bucket)
    dev = histogram_of(hist.join(med, keys), keys, F.abs(F.col("_v") - F.col("_med")), F.col("_n"))
    dev = materialize(dev, "deviation-histogram")
    return quantiles_of_histogram(dev, keys, {name: 0.5}, cuts, one_bucket)
