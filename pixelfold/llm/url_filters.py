"""URL filters: explicit rules first, then segmented host words scored by naive Bayes.

Concatenated names are split by a unigram Viterbi search; a multinomial naive Bayes model over the words of
host and path gives the verdict where no rule fits. The word counts behind both come from the pages
themselves: parts of hyphenated host labels extend the vocabulary, and hosts that hold a seed word of unwanted
topics are the examples from which the other words learn their weight. Counts and weights are whole tables, met by
joins: no word is too rare and no count too large for them, and the driver sees totals only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.sizing import materialize, small_side
from .common import batch_of

# Seed words: topics to block, and ordinary words of hosts and paths.
BLOCKED = "adult ads adserver bet bets betting bingo bonus casino cheap clickbait dating escort farm free gambling jackpot loan loans lottery malware nude phishing pills poker porn pharmacy replica roulette sex slots spam track tracker tracking viagra warez win winner xxx".split()
#: Of these, the words that mark an example by themselves.
STRONG = "adult ads adserver betting bets casino escort gambling malware nude phishing pills poker porn roulette slots spam viagra warez xxx".split()
ORDINARY = "about academy and api app archive art article articles bank blog book books care center city cloud club code community company data day de design dev doc docs edu en es food for forum fr garden gov green group guide health help history home house html http index info journal lab library life local mail map market media mobile museum music my net network new news of office online open page pages paper park photo portal post press project public read research review school science search service shop site social sport start store story student support team tech the time top tour town travel university video view water weather web wiki work world www".split()
#: Count of a seed word; in the vocabulary the seeds together weigh at least as much as all counted words.
SEED_COUNT = 200
#: Letters of the longest word; a longer piece is cut.
LONGEST = 24
#: Weights are summed as whole numbers of this fraction, so that their order does not matter.
UNIT = 2.0**32
#: Candidate words of a batch.
ROWS = 50_000


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``."""

    host: str
    path: str
    block: bool

    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL and without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), upper, lower), F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text of the longest rule that fits, and its verdict; NULL without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text()), r.text())):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.text())).otherwise(name)
        verdict = F.when(fits, F.lit("block" if r.block else "allow")).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Unigram Viterbi segmentation; an unknown word costs a factor of ten for each letter."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = math.log10(total or sum(counts.values()) or 1)
        self.score = {w: math.log10(n) - self.total for w, n in counts.items()}

    def split(self, name: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            choices = [(best[s][0] + self.score.get(name[s:end], 1.0 - self.total - (end - s)), s) for s in range(max(0, end - LONGEST), end)]
            best.append(max(choices, key=lambda x: (x[0], -x[1])))
        words, end = [], len(name)
        while end:
            start = best[end][1]
            words.append(name[start:end])
            end = start
        return words[::-1]


def letter_runs(host: Column) -> Column:
    return F.regexp_extract_all(host, F.lit(r"(\p{L}+)"), F.lit(1))


def path_words(path: Column) -> Column:
    """Runs of letters and digits after a mark that keeps them apart from words of hosts; numbers count as one word."""
    found = F.regexp_extract_all(F.lower(path), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return F.transform(found, lambda w: F.concat(F.lit("/"), F.when(w.rlike(r"^\p{Nd}+$"), F.lit("0")).otherwise(w)))


def vocabulary(hosts: DataFrame) -> DataFrame:
    """word, n: parts of hyphenated labels over all rows of ``hosts``, and the seeds; written once."""
    labels = hosts.select(F.explode(F.split("host", r"\.")).alias("label")).where(F.col("label").contains("-"))
    words = labels.select(F.explode(F.split("label", "-")).alias("word")).where(F.col("word").rlike("^[a-z]{3,24}$"))
    counted = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "url-parts")
    seeds = sorted({*ORDINARY, *BLOCKED})
    each = max(SEED_COUNT, (counted.agg(F.sum("n")).first()[0] or 0) // len(seeds))
    given = hosts.sparkSession.createDataFrame([(w, each) for w in seeds], "word string, n long")
    return materialize(counted.unionByName(given).groupBy("word").agg(F.sum("n").alias("n")), "url-vocabulary")


def segment(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """run, words: the cut of each different run of letters of ``hosts``; written once.

    Substrings of a run meet the vocabulary by a join, and its search sees the words that stand in it.
    """
    total = words.agg(F.sum("n")).first()[0]
    runs = hosts.select(F.explode(letter_runs(F.col("host"))).alias("run")).distinct().withColumn("id", F.sha2("run", 256))
    candidate = pa.schema([("id", pa.string()), ("run", pa.string()), ("word", pa.string())])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, str | None, str]] = []
        for b in batches:
            for i, run in zip(b.column("id").to_pylist(), b.column("run").to_pylist()):
                # One row carries the run; its id is no word.
                rows.append((i, run, i))
                for start in range(len(run)):
                    rows += [(i, None, run[start:end]) for end in range(start + 2, min(start + LONGEST, len(run)) + 1)]
                    if len(rows) >= ROWS:
                        yield batch_of(candidate, id=[r[0] for r in rows], run=[r[1] for r in rows], word=[r[2] for r in rows])
                        rows = []
        if rows:
            yield batch_of(candidate, id=[r[0] for r in rows], run=[r[1] for r in rows], word=[r[2] for r in rows])

    asked = runs.mapInArrow(candidates, "id string, run string, word string")
    met = asked.join(small_side(words), "word", "left").where(F.col("run").isNotNull() | F.col("n").isNotNull())
    known = F.collect_set(F.when(F.col("n").isNotNull(), F.struct("word", "n")))
    cut_schema = pa.schema([("run", pa.string()), ("words", pa.list_(pa.string()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, found = b.column("run").to_pylist(), b.column("known").to_pylist()
            yield batch_of(cut_schema, run=names, words=[Segmenter({k["word"]: k["n"] for k in f}, total).split(r) for r, f in zip(names, found)])

    gathered = met.groupBy("id").agg(F.max("run").alias("run"), known.alias("known")).select("run", "known")
    return materialize(gathered.mapInArrow(cut, "run string, words array<string>"), "url-segments")


def words_of(parts: DataFrame) -> DataFrame:
    """host, path, n (rows), words, blocked (whether the host is an example of unwanted topics); written once."""
    hosts = parts.select("host")
    cuts = segment(hosts, vocabulary(hosts)).withColumnRenamed("words", "_words")
    own = hosts.distinct().select("host", F.explode_outer(letter_runs(F.col("host"))).alias("run"))
    named = own.join(small_side(cuts), "run", "left").groupBy("host").agg(F.flatten(F.collect_list("_words")).alias("words"))
    named = materialize(named.withColumn("blocked", F.arrays_overlap("words", F.array(*map(F.lit, STRONG)))), "url-hosts")
    pairs = parts.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).join(small_side(named), "host")
    return materialize(pairs.withColumn("words", F.concat("words", path_words(F.col("path")))), "url-words")


def learn(pairs: DataFrame) -> tuple[DataFrame, float]:
    """word, weight (in units of ``UNIT``) of every word that occurs, and the prior log odds of "block"."""
    n = F.col("n")
    bad, good = F.when(F.col("blocked"), n).otherwise(0), F.when(F.col("blocked"), 0).otherwise(n)
    seeds = [(w, SEED_COUNT, 0) for w in BLOCKED] + [(w, 0, SEED_COUNT) for w in ORDINARY]
    given = pairs.sparkSession.createDataFrame(seeds, "word string, bad long, good long")
    met = pairs.select(F.explode("words").alias("word"), bad.alias("bad"), good.alias("good"))
    counts = materialize(met.unionByName(given).groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "url-word-counts")
    total = counts.agg((F.sum("bad") + F.count(F.lit(1))).alias("bad"), (F.sum("good") + F.count(F.lit(1))).alias("good")).first()
    weight = F.log((F.col("bad") + 1) / F.lit(total["bad"])) - F.log((F.col("good") + 1) / F.lit(total["good"]))
    rows = pairs.agg(F.sum(bad).alias("bad"), F.sum("n").alias("n")).first()
    share = min(0.5, max(0.05, (rows["bad"] or 0) / max(1, rows["n"] or 0)))
    return counts.select("word", F.round(weight * UNIT).cast("long").alias("weight")), math.log(share / (1 - share))


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, score (probability of "block" by the model) of every row.

    NULL urls and urls without ``://`` have an empty host and path, no rule and no words: the prior decides, which
    allows. Repeated rows get equal results; other columns are not read; an empty table stays empty. A very long url
    is cut whole: its candidate words are streamed.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key).cast("long").alias("key"), host.alias("host"), path.alias("path"))
    pairs = words_of(parts.select("host", "path"))
    weights, prior = learn(pairs)
    # The outer explode keeps pairs without words.
    spread = pairs.select("host", "path", F.explode_outer("words").alias("word")).join(small_side(weights), "word", "left")
    odds = spread.groupBy("host", "path").agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("odds"))
    x = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("odds") / F.lit(UNIT) + F.lit(prior)))
    scored = parts.join(odds, ["host", "path"]).withColumn("score", 1 / (1 + F.exp(-x)))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score")
