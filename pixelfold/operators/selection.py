"""Exact order statistics by selection: two passes, and few values travel.

A value histogram (``quantiles``) is small where a band has few distinct values and as long as the data where
it holds floats. Here the first pass sketches each group's quantiles, which brackets every wanted rank between
two values, and counts the group. The second pass keeps only values inside a bracket; all values of the gap
between two brackets fold, map-side, to one row with their count, smallest and largest value. Running counts
over these rows give exact ranks. About ``4 / accuracy`` of a group's values cross the network for each asked
probability, whatever the band, and no pass writes or sorts the rows themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..plans.sizing import materialize, small_side

#: The sketch's rank error is one part in this many; a bracket spans twice that on either side.
ACCURACY = 10_000


def _beside(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with the numbers of its group; a NULL key is a group like any other."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    right = small_side(groups.withColumnsRenamed(names))
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return df.join(right, on).drop(*names.values())


def _brackets(values: DataFrame, keys: Sequence[str], probs: Mapping[str, float], accuracy: int) -> DataFrame:
    """keys, _total, _lo0, _hi0, ...: one row a group, written once, so that its size is known."""
    points, ends = [], []
    for p in probs.values():
        for q in (p - 2 / accuracy, p + 2 / accuracy):
            inside = 0 < q < 1
            ends.append(len(points) if inside else None)
            points += [q] if inside else []
    sketch = F.percentile_approx("_v", points, accuracy).alias("_q") if points else F.lit(None).cast("array<double>").alias("_q")
    groups = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"), sketch)
    at = lambda i, outside: F.lit(outside) if i is None else F.col("_q")[i]
    cols = []
    for i in range(len(probs)):
        cols += [at(ends[2 * i], float("-inf")).alias(f"_lo{i}"), at(ends[2 * i + 1], float("inf")).alias(f"_hi{i}")]
    return materialize(groups.select(*keys, "_total", *cols), "value-brackets")


def select_quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, probs: Mapping[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """keys + one column per named probability, linear interpolation between ranks.

    NULL and NaN values are left out; a group without others has no row. ``df`` is read twice, so it must give
    the same rows again. A sketch that broke its error bound would be noticed and raise, not answer wrongly.
    """
    keys = list(keys)
    values = df.select(*keys, value.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    seen = _beside(values, _brackets(values, keys, probs, accuracy), keys)
    v, inside, gap = F.col("_v"), F.lit(False), F.lit(0)
    for i in range(len(probs)):
        inside = inside | v.between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
        gap = gap + (v > F.col(f"_hi{i}")).cast("int")
    # Between two brackets `gap` is constant, so the rows of one gap lie together in the order of values.
    folded = seen.groupBy(*keys, gap.alias("_gap"), F.when(inside, v).alias("_own")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"), F.max("_v").alias("_top"), F.max("_total").alias("_total")
    )
    run = W.partitionBy(*keys).orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = folded.withColumn("_hi", F.sum("_n").over(run)).withColumn("_lo", F.col("_hi") - F.col("_n"))
    lo, hi, top = F.col("_lo"), F.col("_hi"), F.col("_top")

    def holder(rank: Column) -> Column:
        known = F.when((v == top) | (rank == lo + 1), v).when(rank == hi, top)
        return F.max(F.when((lo < rank) & (rank <= hi), known))

    aggs, out = [F.max("_total").alias("_total")], []
    for i, (name, p) in enumerate(probs.items()):
        h = (F.col("_total") - 1) * F.lit(float(p))
        aggs += [holder(F.floor(h) + 1).alias(f"_a{i}"), holder(F.ceil(h) + 1).alias(f"_b{i}")]
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        exact = F.when(a == b, a).otherwise(a + (b - a) * (h - F.floor(h)))
        missed = F.raise_error(F.lit(f"rank of {name} lies outside its bracket")).cast("double")
        out.append(F.when(a.isNull() | b.isNull(), missed).otherwise(exact).alias(name))
    return ranked.groupBy(*keys).agg(*aggs).select(*keys, *out)


def select_mad(df: DataFrame, keys: Sequence[str], value: Column, name: str = "mad", accuracy: int = ACCURACY) -> DataFrame:
    """Median absolute deviation per group: the same selection on the distances from the medians."""
    keys = list(keys)
    values = df.select(*keys, value.cast("double").alias("_x"))
    medians = materialize(select_quantiles(values, keys, F.col("_x"), {"_median": 0.5}, accuracy), "medians")
    away = _beside(values, medians, keys)
    return select_quantiles(away, keys, F.abs(F.col("_x") - F.col("_median")), {name: 0.5}, accuracy)
