"""Language identification by rank-order profiles.

A profile is the list of a text's most frequent letter n-grams (one to three letters, words
closed by a boundary on both sides), most frequent first. A text belongs to the language
whose profile has the least out-of-place distance: the sum of the differences in rank, a
missing n-gram counting as many ranks as a profile has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import batch_of, fold, slices, texts_of

UNKNOWN = "und"
PROFILE = 400
#: Documents read for each language's profile; a hash of the key picks them where there are more.
MOST_PER_LANGUAGE = 3000


@dataclass(frozen=True)
class Profiles:
    """Languages, and per language the n-gram codes in ascending order with the rank of each."""

    languages: list[str]
    codes: list[np.ndarray]
    ranks: list[np.ndarray]


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all n-grams of the lower-cased text, with repeats; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    seq = np.ones(len(points) + 2, np.int64)
    seq[1:-1] = np.where(_is_letter()[points], points.astype(np.int64) + 2, 1)
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] > 1) | (seq[:-1] > 1)
    seq = seq[keep]
    if len(seq) < 3:
        return np.zeros(0, np.int64)
    pairs = seq[:-1] << 21 | seq[1:]
    triples = (pairs[:-1] << 21 | seq[2:])[seq[1:-1] > 1]
    return np.concatenate((seq[seq > 1], pairs, triples))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order and how often each occurs."""
    codes = np.sort(codes)
    head = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[head], np.diff(np.append(head, len(codes)))


def ranked(codes: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The ``most`` most frequent codes, most frequent first, the smaller code first at ties."""
    code, n = counted(codes)
    return code[np.lexsort((code, -n))[:most]] if len(code) else code


def learn_profiles(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MOST_PER_LANGUAGE) -> Profiles:
    """Profiles of all languages in ``docs`` from at most about ``most`` documents of each.

    The driver receives one count and ``PROFILE`` n-grams per language.
    """
    known = docs.where(F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    shares = {r["lang"]: min(1.0, most / r["count"]) for r in known.groupBy("lang").count().collect()}
    if not shares:
        return Profiles([], [], [])
    share = F.element_at(F.create_map(*(F.lit(x) for p in sorted(shares.items()) for x in p)), F.col("lang"))
    sample = known.where(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1 << 30)) <= share * (1 << 30))
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            grams: dict[str, list[np.ndarray]] = {}
            for language, t in zip(b.column("lang").to_pylist(), texts_of(b.column("text"))):
                grams.setdefault(language, []).append(ngram_codes(t))
            for language, parts in grams.items():
                code, n = counted(np.concatenate(parts))
                yield batch_of(schema, lang=[language] * len(code), code=code, n=n)

    sums = sample.select("text", "lang").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = sums.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= PROFILE).select("lang", "code", "rank").collect()
    languages = sorted({r["lang"] for r in top})
    codes, ranks = [], []
    for language in languages:
        own = sorted((r["code"], r["rank"] - 1) for r in top if r["lang"] == language)
        codes.append(np.array([c for c, _ in own], np.int64))
        ranks.append(np.array([r for _, r in own], np.int64))
    return Profiles(languages, codes, ranks)


def distances(texts: list[str], profiles: Profiles) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance to each language, as a share of the largest possible one, and whether a text has letters."""
    lists = [ranked(ngram_codes(t)) for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    own = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    out = np.ones((len(texts), len(profiles.languages)))
    for j, (codes, ranks) in enumerate(zip(profiles.codes, profiles.ranks)):
        at = np.minimum(np.searchsorted(codes, flat), len(codes) - 1)
        step = np.where(codes[at] == flat, np.abs(ranks[at] - own), PROFILE)
        total = np.bincount(text_of, weights=step, minlength=len(texts))
        out[:, j] = np.where(sizes > 0, total / (PROFILE * np.maximum(sizes, 1)), 1.0)
    return out, sizes > 0


def identify(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score of every row.

    ``und`` with score 0 for NULL texts, texts without a letter, and when no profile was learned; at equal
    distances the language that sorts first. The score is the closeness to the chosen language
    over the sum of all languages' closeness. Repeated rows get equal results.
    """
    schema = pa.schema([("key", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    names = np.array([*profiles.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            d, lettered = distances(texts_of(b.column("text")), profiles)
            if not profiles.languages:
                choice, score = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            else:
                best = d.argmin(1)
                close = 1.0 - d
                total = close.sum(1)
                score = np.where(total > 0, close[np.arange(len(d)), best] / np.where(total > 0, total, 1.0), 1.0 / len(profiles.languages))
                choice, score = np.where(lettered, best, len(profiles.languages)), np.where(lettered, score, 0.0)
            yield batch_of(schema, key=b.column("key"), lang_pred=names[choice], score=score)

    narrow = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    return narrow.mapInArrow(run, "key long, lang_pred string, score double").withColumnRenamed("key", key)


def identify_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the documents whose fold of four is not 2, predict all, and mark the held-out ones."""
    profiles = learn_profiles(docs.where(fold(F.col(key), 4) != 2), key, text, lang)
    return identify(docs, profiles, key, text).withColumn("held_out", fold(F.col(key), 4) == 2)
