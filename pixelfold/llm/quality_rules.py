"""Quality rules whose cutoffs are chosen with a guaranteed limit on false rejections.

Each rule rejects a document whose statistic exceeds a cutoff of the rule's grid. On a labelled
holdout, grouped by stratum (the language), a cutoff is certified if
the exact binomial test rejects "more than ``risk`` of the good documents are lost":
P(Bin(n, risk) <= losses) <= level. The cutoffs of one rule are tested from the most lenient
down and testing stops at the first failure, which needs no correction along the grid;
the level is divided by the number of (stratum, rule) pairs that have good documents enough to pass without
any loss. That number follows from how many labels there are, not from what they lose, so the test stays exact,
and strata that cannot pass cost the others nothing. Among the certified cutoffs, the one
with the largest difference between the shares of bad and good documents it rejects is used,
the more lenient one at ties. A rule without a certified cutoff in a stratum rejects nothing there.
The risk holds rule by rule: a stratum may lose up to ``risk`` times the number of its certified rules
to all of them together.

All of it is DataFrame functions; the driver sees only the table of cutoffs.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.sizing import BROADCAST_ROWS
from .common import SPACES, fold

# The base rule and the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3

POSITION_BITS = 21
GRID = [round(0.02 * 1.25**i, 4) for i in range(28)]
LENGTH_GRID = [6.0 + 0.5 * i for i in range(29)]


@dataclass(frozen=True)
class Risk:
    """At most ``risk`` of a stratum's good documents lost to each rule, with probability 1 - ``level`` for all pairs of stratum and rule at once."""

    risk: float = 0.01
    level: float = 0.05


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACES}]+"))


def _kept_length(text: Column, dropped: str) -> Column:
    return F.length(F.regexp_replace(text, dropped, "")).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column, packed: bool) -> Column:
    """Number of words in windows that occur twice or more in ``words`` (at least one window long).

    Windows are sorted by a hash with their position; neighbours of equal hash are compared word by word.
    ``packed`` keeps hash and position in one long, for up to 2**21 words.
    """
    low = (1 << POSITION_BITS) - 1
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def hashed(i: Column) -> Column:
        return F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))

    def code(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS) if packed else x["h"]

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(low)).cast("int") if packed else x["i"]

    def same(x: Column, y: Column) -> Column:
        equal = code(x) == code(y)
        for k in range(WINDOW):
            equal = equal & (F.get(words, place(x) + k) == F.get(words, place(y) + k))
        return F.coalesce(equal, F.lit(False))

    keys = F.transform(starts, lambda i: hashed(i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")) if packed else F.struct(hashed(i).alias("h"), i.alias("i")))

    def covered(order: Column) -> Column:
        twice = F.filter(order, lambda x, i: same(x, F.get(order, i - 1)) | same(x, F.get(order, i + 1)))
        return _let(F.sort_array(F.transform(twice, place)), spans)

    def spans(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b).cast("long")

    return _let(F.sort_array(keys), covered)


def _repeat_words(words: Column) -> Column:
    n = F.size(words)
    return (
        F.when(n < WINDOW + 1, F.lit(0).cast("long"))
        .when(n < 1 << POSITION_BITS, _repeated(words, True))
        .otherwise(_repeated(words, False))
    )


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the other counts of the rules.

    NULL texts count as empty: all counts are zero. Columns of ``docs`` with these names are replaced.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    of_words = _let(_words(body), lambda w: F.named_struct(F.lit("n_words"), F.size(w).cast("long"), F.lit("word_chars"), F.length(F.array_join(w, "")).cast("long"), F.lit("n_repeat_words"), _repeat_words(w)))
    of_lines = _let(lines, lambda x: F.named_struct(F.lit("n_lines"), F.size(x).cast("long"), F.lit("n_dup_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long")))
    counts = {
        "n_symbols": _kept_length(body, f"[^{SYMBOLS}]+"),
        "n_upper": _kept_length(body, r"[^\p{Lu}]+"),
        "n_marks": _kept_length(body, "[^!?]+"),
    }
    whole = F.named_struct(F.lit("w"), of_words, F.lit("l"), of_lines, *(x for n, c in counts.items() for x in (F.lit(n), c)))
    at = "_counts"
    while at.lower() in map(str.lower, docs.columns):
        at += "_"
    # A generator of one row: predicates on the counts are not pushed below it, where they would be computed again for each use.
    found = docs.select("*", F.explode(F.array(whole)).alias(at))
    names = {n: f"{at}.w.{n}" for n in ("n_words", "word_chars", "n_repeat_words")} | {n: f"{at}.l.{n}" for n in ("n_lines", "n_dup_lines")} | {n: f"{at}.{n}" for n in counts}
    return found.withColumns({n: F.col(path) for n, path in names.items()}).drop(at)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def rules() -> dict[str, tuple[Column, list[float]]]:
    """Statistic and grid of each rule, from the columns of ``statistics``."""

    def rate(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbols": (rate("n_symbols", "n_words"), GRID),
        "capitals": (rate("n_upper", "word_chars"), GRID),
        "marks": (rate("n_marks", "n_words"), GRID),
        "repeated_lines": (rate("n_dup_lines", "n_lines"), GRID),
        "repeated_words": (rate("n_repeat_words", "n_words"), GRID),
        "long_words": (rate("word_chars", "n_words"), LENGTH_GRID),
    }


def _exceeded(value: Column, grid: list[float]) -> Column:
    """How many cutoffs of the ascending grid ``value`` exceeds."""
    return F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: value > c))


def _log_chance(n: Column, k: Column, p: float) -> Column:
    """Logarithm of P(Bin(n, p) = k): the divergence from the mean, with Stirling's remainders, so large counts do not cancel."""
    small = F.array(*(F.lit(0.0 if not x else math.lgamma(x + 1) - (x + 0.5) * math.log(x) + x - 0.5 * math.log(2 * math.pi)) for x in range(16)))

    def rest(x: Column) -> Column:
        y = x.cast("double")
        return F.when(x < 16, F.get(small, x.cast("int"))).otherwise(1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7))

    lost = n - k
    apart = k * F.log(k / (n * F.lit(p))) + lost * F.log(lost / (n * F.lit(1 - p)))
    inside = rest(n) - rest(k) - rest(lost) - apart + 0.5 * F.log(n / (F.lit(2 * math.pi) * k * lost))
    return F.when(k == 0, n * F.lit(math.log1p(-p))).when(lost == 0, n * F.lit(math.log(p))).otherwise(inside)


def _binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed on the side of ``k`` away from the mean.

    Terms shrink from there on like a normal curve, so those beyond twelve deviations (below e**-70 of the
    first) are left out: 10**9 labels at a risk of 0.01 take some 38,000 terms.
    """
    most = (F.ceil(12 * F.sqrt(n * F.lit(p * (1 - p)))) + 64).cast("long")
    below = k < n * F.lit(p)
    start = F.when(below, k).otherwise(k + 1)
    steps = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.least(most, F.when(below, k).otherwise(n - k - 1)) - 1))
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def add(a: Column, j: Column) -> Column:
        i = F.when(below, start - j).otherwise(start + j)
        ratio = F.when(below, i * F.lit((1 - p) / p) / (n - i + 1)).otherwise((n - i) * F.lit(p / (1 - p)) / (i + 1))
        return F.struct((a["t"] * ratio).alias("t"), (a["s"] + a["t"] * ratio).alias("s"))

    side = F.exp(_log_chance(n, start, p)) * F.aggregate(steps, zero, add, lambda a: a["s"])
    return F.when(k >= n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.when(below, side).otherwise(1 - side)))


def cutoffs(labelled: DataFrame, limits: Risk = Risk(), stratum: str = "lang") -> DataFrame:
    """stratum, rule, cut (index into the rule's grid) of every certified choice.

    ``labelled``: rows of ``statistics`` with ``quality`` (1 good, 0 bad; others, and what fails the base rule, are left out).
    """
    own = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    found = rules()
    levels = F.array(*(F.named_struct(F.lit("rule"), F.lit(name), F.lit("bucket"), _exceeded(value, grid), F.lit("n_cuts"), F.lit(len(grid))) for name, (value, grid) in found.items()))
    quality = F.when(~base_failed() & F.col("quality").isin(0, 1), F.col("quality"))
    votes = labelled.select(quality.alias("quality"), own.alias("stratum"), levels.alias("levels")).select("quality", "stratum", F.explode("levels").alias("v")).select("quality", "stratum", "v.*")
    # At most strata x rules x (cutoffs + 1) rows from here on.
    histogram = votes.groupBy("stratum", "rule", "n_cuts", "bucket").agg(F.coalesce(F.sum("quality"), F.lit(0)).cast("long").alias("good"), F.coalesce(F.sum(1 - F.col("quality")), F.lit(0)).cast("long").alias("bad"))
    per_rule = histogram.groupBy("stratum", "rule", "n_cuts").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"), F.collect_list(F.struct("bucket", "good", "bad")).alias("cells")
    )
    # Without a loss the tail is (1 - risk) ** n_good; a stratum that misses even its own rules' share of the level cannot pass.
    enough = F.col("n_good") * F.lit(math.log1p(-limits.risk)) <= F.lit(math.log(limits.level / len(found)))
    per_rule = per_rule.where(enough).withColumn("n_pairs", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))

    def above(field: str) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(c["bucket"] > F.col("cut"), c[field]).otherwise(0))

    tried = per_rule.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("n_cuts") - 1)))
    tried = tried.select("stratum", "rule", "cut", "n_good", "n_bad", "n_pairs", above("good").alias("lost"), above("bad").alias("caught"))
    tail = F.when(F.col("n_good") > 0, _binomial_tail(F.col("n_good"), F.col("lost"), limits.risk)).otherwise(F.lit(1.0))
    order = Window.partitionBy("stratum", "rule").orderBy(F.desc("cut"))
    tested = tried.withColumn("fails", (tail > F.lit(limits.level) / F.col("n_pairs")).cast("int")).withColumn("failed", F.sum("fails").over(order))
    gain = F.coalesce(F.col("caught") / F.nullif("n_bad", F.lit(0)), F.lit(0.0)) - F.col("lost") / F.col("n_good")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), F.desc("cut"))
    return tested.where("failed = 0").withColumn("gain", gain).where("gain > 0").withColumn("_r", F.row_number().over(best)).where("_r = 1").select("stratum", "rule", "cut")


def calibrate(docs: DataFrame, labels: DataFrame, limits: Risk = Risk(), key: str = "doc_id", text: str = "text", stratum: str = "lang") -> dict[str, dict[str, float]]:
    """Cutoff by rule and stratum, from all labelled documents whose fold of five is not 0.

    The table that comes to the driver has at most one row per rule and certified stratum.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isin(0, 1)).groupBy(key).agg(F.min("quality").alias("quality"))
    known = known.where(fold(F.col(key), 5) != 0)
    narrow = docs.select(key, text, stratum)
    if known.count() <= BROADCAST_ROWS:
        labelled = statistics(narrow.join(F.broadcast(known), key), text)
    else:
        # The counts are shuffled, not the texts.
        labelled = statistics(narrow, text).drop(text).join(known.hint("merge"), key)
    chosen = cutoffs(labelled, limits, stratum)
    found = rules()
    out: dict[str, dict[str, float]] = {}
    for r in chosen.collect():
        out.setdefault(r["rule"], {})[r["stratum"]] = found[r["rule"]][1][r["cut"]]
    return out


def verdict(chosen: dict[str, dict[str, float]], stratum: str = "lang") -> Column:
    """True for rows of ``statistics`` that exceed no cutoff certified in their own stratum; others reject nothing."""
    passed = F.lit(True)
    own = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    for name, (value, _) in rules().items():
        cuts = chosen.get(name)
        if not cuts:
            continue
        table = F.create_map(*(F.lit(x) for pair in sorted(cuts.items()) for x in pair))
        passed = passed & F.coalesce(value <= F.try_element_at(table, own), F.lit(True))
    return passed


def judge(docs: DataFrame, labels: DataFrame, limits: Risk = Risk(), key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept`` of every row.

    NULL and empty texts fail the base rule. Without labels no cutoff is certified and the base rule decides alone.
    Repeated rows get equal results, other columns are untouched, an empty table stays empty.
    """
    chosen = calibrate(docs, labels, limits, key, text, stratum)
    return statistics(docs, text).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(chosen, stratum))
