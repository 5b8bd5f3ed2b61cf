"""The training-data operators against brute force, round trips and edge cases."""

from __future__ import annotations

import collections
import fractions
import functools
import hashlib
import html
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pixelfold.llm import (
    bpe,
    chat_formatting,
    html_extraction,
    language_id,
    nearest_neighbours,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    simhash,
    url_filters,
)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor " * 20_000
#: Nulls in every column, empty and blank texts, a very long one, repeated rows, and columns that clash with the operators' own.
ROWS = [
    (1, "The quick brown fox jumps.\nThe quick brown fox jumps.", "en", 7),
    (1, "The quick brown fox jumps.\nThe quick brown fox jumps.", "en", 7),
    (2, None, "en", None),
    (3, "", None, 0),
    (None, " \t\n ", "de", 1),
    (None, "Hello", None, 1),
    (4, LONG, "xx", 2),
    (5, "Ünïcödé 日本語 😀 ΣΑΣ \x1c <|endoftext|>", "de", 3),
    (6, "*** $$$ !!! ###", "", 4),
]
SCHEMA = "doc_id long, text string, lang string, score int"
EXTRA = ["key", "fp", "row", "n_words", "kept", "length", "template", "predicted"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *(F.lit(1).alias(c) for c in EXTRA)).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (6, 0, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")


def texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


# --- byte pairs ---------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, sf):
    t = Tokenizer.from_file(WORD_BPE)
    odd = [r[1] or "" for r in ROWS] + ["don't y'all''s !!'s", "aaaa aaaaa zzzz", "<|startoftext|><|endoftext|>x", "ﬁ ǅ ſ İ ½ ²", "\x85q\x00"]
    every = odd + list(texts(spark, sf).values())
    got = bpe.encoder(WORD_BPE).encode(every)
    want = t.encode_batch(every, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]
    for w in want[: len(odd)]:
        assert bpe.encoder(WORD_BPE).decode(np.array(w.ids, np.int64)) == t.decode(w.ids, skip_special_tokens=False)


def test_forced_boundaries_lie_in_no_token():
    e = bpe.encoder(WORD_BPE)
    assert (~e.joinable).sum() > 1000
    names = {s: b for b, s in enumerate(bpe.byte_symbols())}
    for token in list(e.token_of.values())[:5000]:
        if token in e.special:
            continue
        b = [names[c] for c in token.removesuffix("</w>")]
        assert e.joinable[b[:-1], b[1:]].all()


def test_bpe_query(spark, docs, none, sf):
    t = Tokenizer.from_file(WORD_BPE)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digest_documents(bpe.encode_documents(docs, WORD_BPE), WORD_BPE).collect())
    want = []
    for k, text, _, _ in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((k is None, k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    key = lambda r: (r[0], r[1] or 0, r[3])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert bpe.digest_documents(bpe.encode_documents(none, WORD_BPE), WORD_BPE).count() == 0


# --- packing ------------------------------------------------------------------------------


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [packing.Limits(50, 4, 1200), packing.Limits(64, 64, 64 * 64)])
def test_bins_keep_every_capacity(rule, limits):
    rng = random.Random(3)
    counts = collections.Counter(rng.randint(1, 34) for _ in range(3000))
    bins = collections.defaultdict(list)
    seen = collections.Counter()
    for length, rank, n, first, offset in packing.plan_bins(dict(counts), limits, rule).tolist():
        assert rank == seen[length]
        seen[length] += n
        for b in range(first, first + n):
            bins[b].append((offset, length))
    assert seen == counts
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= limits.tokens and len(own) <= limits.documents and sum(n * n for _, n in own) <= limits.cost
    if limits.documents == 64:
        assert len(bins) <= math.ceil(sum(k * v for k, v in counts.items()) / limits.tokens) * 1.02 + 1


def test_a_piece_beyond_a_capacity_is_an_error():
    with pytest.raises(ValueError):
        packing.plan_bins({10: 1}, packing.Limits(20, 5, 50))


def test_packed_documents(spark, docs, none, sf):
    t = Tokenizer.from_file(WORD_BPE)
    got = packing.pack_documents(docs, WORD_BPE).toPandas()
    want = collections.Counter()
    for k, text, _, _ in ROWS:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for i, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s : s + 4096], "<u4")
            want[(k, i, s, len(part), zlib.crc32(part.tobytes()))] += 1
    have = collections.Counter((None if math.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples())
    assert have == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 4096
    assert packing.pack_documents(none, WORD_BPE).count() == 0


# --- SimHash ------------------------------------------------------------------------------


def naive_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def naive_components(fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 2):
            parent[find(i)] = find(int(j))
    groups = collections.defaultdict(set)
    for i in range(len(fps)):
        groups[find(i)].add(int(fps[i]))
    return {frozenset(g) for g in groups.values()}


def test_golay_keys_meet_at_two_flips():
    rng = random.Random(1)
    for _ in range(300):
        w = rng.getrandbits(23)
        v = w ^ 1 << rng.randrange(23) ^ 1 << rng.randrange(23) if rng.random() < 0.5 else w
        for a, b in ((0, 5), (3, 3), (2, 22)):
            v = w ^ (1 << a) ^ (1 << b)
            x, y = simhash.golay_keys(np.array([w, v]))
            assert set(x) & set(y)
            assert len(set(x)) <= 6


@pytest.mark.parametrize("bucket", [2, 32, 1000])
def test_components_equal_brute_force(spark, bucket):
    rng = np.random.default_rng(4)
    center = rng.integers(0, 1 << 63, 1, np.int64).astype(np.uint64)[0]
    fps = [center]
    for _ in range(300):
        x = fps[rng.integers(len(fps))]
        for _ in range(rng.integers(1, 4)):
            x ^= np.uint64(1) << np.uint64(rng.integers(64))
        fps.append(x)
    fps = np.unique(np.array([*fps, *rng.integers(0, 1 << 63, 100, np.int64).astype(np.uint64)], np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got: dict = collections.defaultdict(set)
    for r in simhash.components(simhash.links(df, bucket)).collect():
        got[r["root"]] |= {r["node"] & (1 << 64) - 1, r["root"] & (1 << 64) - 1}
    want = {g for g in naive_components(fps) if len(g) > 1}
    assert {frozenset(g) for g in got.values()} == want


def test_simhash_query(spark, sf):
    own = texts(spark, sf)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op8_simhash_golay"](spark, sf).collect()}
    fps = {k: naive_fingerprint(t) for k, t in own.items()}
    assert {k: f"{f:016x}" for k, f in fps.items()} == {k: f for k, (f, _) in got.items()}
    for group in naive_components(np.array(sorted(set(fps.values())), np.uint64)):
        members = [k for k, f in fps.items() if f in group]
        assert {got[k][1] for k in members} == {min(members)}


def test_simhash_edges(docs, none):
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    blank = {(r["doc_id"], r["component_id"]) for r in found if r["fp"] == 0}
    assert blank == {(2, 2), (3, 2), (None, 2)}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.select("doc_id", "text").collect()) == sorted((k or 0, t or "") for k, t, _, _ in [ROWS[0], ROWS[2], *ROWS[5:]])
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("part_rows", [7, 20_000])
def test_hot_lengths_are_ranked_in_parts(spark, monkeypatch, part_rows):
    monkeypatch.setattr(packing, "PART_ROWS", part_rows)
    # Two thirds of the pieces have one length, and the same row comes ten times.
    rows = [(i // 10, 0, 0, 30 if i % 3 else 1 + i % 64, i // 10) for i in range(900)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(5)
    got = packing.pack(pieces, packing.Limits(64, 64, 64 * 64)).toPandas()
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(rows)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 64
    plan = packing.plan_bins(dict(collections.Counter(r[3] for r in rows)), packing.Limits(64, 64, 64 * 64))
    assert got.sequence_id.nunique() == (plan[:, 3] + plan[:, 2]).max()


# --- rules --------------------------------------------------------------------------------


def naive_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_equal_brute_force(spark, docs, none, labels, sf):
    own = texts(spark, sf)
    for r in queries.QUERIES["op9_risk_controlled_rules"](spark, sf).collect():
        assert tuple(r[c] for c in COUNTS) == naive_counts(own[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
    judged = quality_rules.judge(docs, labels)
    assert sorted((r["text"] or "", *(r[c] for c in COUNTS)) for r in judged.collect()) == sorted((t or "", *naive_counts(t or "")) for _, t, _, _ in ROWS)
    assert quality_rules.judge(none, labels).count() == 0
    assert quality_rules.judge(docs, labels.where("false")).where("kept AND base_failed").count() == 0


def test_unpacked_windows_count_alike(spark):
    rng = random.Random(5)
    rows = [(" ".join(rng.choice("abc") for _ in range(n)),) for n in (4, 5, 9, 40, 200)]
    df = spark.createDataFrame(rows, "t string").select("t", F.split("t", " ").alias("w"))
    for packed in (True, False):
        got = df.select("t", quality_rules._let(F.col("w"), lambda w: quality_rules._repeated(w, packed)).alias("n"))
        assert all(r["n"] == naive_counts(r["t"])[4] for r in got.collect())


def test_binomial_tail_is_exact(spark):
    for n, k, p in ((10, 0, 0.1), (200, 3, 0.02), (5, 5, 0.5), (1000, 20, 0.01)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality_rules._binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
        assert got == pytest.approx(min(1.0, want), rel=1e-9)


def test_binomial_tail_of_many_labels_is_bounded_work(spark):
    n, p = 10**9, 0.01
    sd = math.sqrt(n * p * (1 - p))
    ks = [int(n * p - 5 * sd), int(n * p - 2 * sd), int(n * p), int(n * p + 3 * sd), 10, n - 1, n]
    df = spark.createDataFrame([(n, k) for k in ks], "n long, k long").coalesce(1)
    start = time.monotonic()
    got = [r[0] for r in df.select(quality_rules._binomial_tail(F.col("n"), F.col("k"), p)).collect()]
    assert time.monotonic() - start < 1 * len(ks)
    for k, g in zip(ks[:4], got):  # the normal curve with its skew term
        z = (k + 0.5 - n * p) / sd
        want = 0.5 * math.erfc(-z / math.sqrt(2)) - (1 - 2 * p) / (6 * sd) * (z * z - 1) * math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        assert g == pytest.approx(want, rel=1e-3)
    assert got[4] == 0.0 and got[5] == got[6] == 1.0


@pytest.mark.parametrize("n, p", [(17, 0.3), (40, 0.01), (637, 0.01), (3000, 0.02)])
def test_binomial_tail_equals_the_sum_of_fractions(spark, n, p):
    f = fractions.Fraction(p)
    chances = [math.comb(n, i) * f**i * (1 - f) ** (n - i) for i in range(min(n, 120) + 1)]
    got = spark.range(len(chances)).coalesce(1).select("id", quality_rules._binomial_tail(F.lit(n).cast("long"), F.col("id"), p).alias("v"))
    total = fractions.Fraction(0)
    for r, c in zip(sorted(got.collect()), chances):
        total += c
        assert r["v"] == pytest.approx(float(total), rel=1e-9)


def test_strata_without_labels_enough_cost_the_others_nothing(spark):
    good = "100 n_words, 500L word_chars, 0L n_upper, 0L n_marks, 5L n_lines, 0L n_dup_lines, 0L n_repeat_words"
    # 550 good rows pass at a sixth of the level (476 needed), not if 40 tiny strata took their share (826 needed).
    en = spark.range(800).selectExpr("'en' lang", "CAST(id >= 250 AS int) quality", "IF(id < 250, 60L, 0L) n_symbols", *good.replace("100 n", "100L n").split(", "))
    tiny = spark.range(400).selectExpr("concat('t', id % 40) lang", "1 quality", "0L n_symbols", *good.replace("100 n", "100L n").split(", "))
    assert [(r["stratum"], r["rule"]) for r in quality_rules.cutoffs(en.unionByName(tiny)).collect()] == [("en", "symbols")]


def test_columns_named_like_the_counts_are_kept(spark):
    df = spark.createDataFrame([(1, "a b c", "x", 7, "y")], "doc_id long, text string, _counts string, n_words int, _Counts_ string")
    got = quality_rules.statistics(df).first()
    assert (got["_counts"], got["_Counts_"], got["n_words"]) == ("x", "y", 3)


def test_cutoffs_bound_false_rejections(spark):
    rng = random.Random(2)
    rows = [("en" if i % 2 else "de", 1 if i % 5 else 0, 100, 500, int(100 * (rng.random() * 0.1 if i % 5 else 0.5 + rng.random())), 0, 0, 5, 0, 0) for i in range(8000)]
    df = spark.createDataFrame(rows, "lang string, quality int, n_words long, word_chars long, n_symbols long, n_upper long, n_marks long, n_lines long, n_dup_lines long, n_repeat_words long")
    cuts = {(r["stratum"], r["rule"]): quality_rules.GRID[r["cut"]] for r in quality_rules.cutoffs(df).collect()}
    assert set(cuts) == {("en", "symbols"), ("de", "symbols")}
    assert all(0.09 < c < 0.5 for c in cuts.values())
    assert quality_rules.cutoffs(df.limit(100)).count() == 0


def test_a_pooled_cutoff_does_not_judge_a_small_stratum(spark):
    rows = [(i, " ".join(f"{i}a{j}" for j in range(60)) + ("" if i % 5 else "".join(f" #{j}" for j in range(40))), "en", min(i % 5, 1)) for i in range(2000)]
    rows += [(5000 + i, " ".join(f"{i}b{j}" for j in range(60)) + "".join(f" #{j}" for j in range(40)), "xx", 1) for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    got = quality_rules.judge(df.drop("quality"), df.select("doc_id", F.col("quality").cast("int").alias("quality")))
    kept = {r["lang"]: r["n"] for r in got.where("kept").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kept["en"] == 1600 and kept["xx"] == 15


@pytest.mark.parametrize("bound", [200_000, 10])
def test_all_labels_count_towards_a_small_stratum(spark, monkeypatch, bound):
    monkeypatch.setattr(quality_rules, "BROADCAST_ROWS", bound)
    df = spark.range(0, 70_000, 1, 8).selectExpr(
        "id AS doc_id", "IF(id % 56 = 0, 'xx', 'en') AS lang", "CAST(IF(id % 5 = 1, 0, 1) AS int) AS quality",
        "concat(array_join(transform(sequence(1, 50), i -> concat(id, 'a', i)), ' '), IF(id % 5 = 1, ' # # # # # # #', '')) AS text",
    )
    chosen = quality_rules.calibrate(df.drop("quality"), df.select("doc_id", "quality"))
    assert set(chosen["symbols"]) == {"en", "xx"}


# --- classifier and language --------------------------------------------------------------


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(0)
    counts = np.array([1, 3, 2, 4] * 10)
    x = rng.normal(size=(counts.sum(), quality_classifier.FEATURES))
    y = np.array([0.0, 1.0] * 20)
    x[np.repeat(y, counts) == 1, 0] += 3
    model = quality_classifier.train(x, counts, y, rounds=200)
    out = model.forward(x, counts)
    assert ((out["score"] > 0.5) == y).mean() > 0.95
    assert np.allclose(np.add.reduceat(out["attention"], np.cumsum(counts) - counts), 1)


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op1_attention_quality"](spark, sf)
    known = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("quality", "predicted").collect()
    assert got.count() == 1000
    for q in (0, 1):
        own = [r["predicted"] == q for r in known if r["quality"] == q]
        assert sum(own) / len(own) > 0.9


def test_classifier_edges(docs, none, labels):
    got = quality_classifier.classify(docs, labels)
    rows = got.collect()
    assert len(rows) == len(ROWS) and set(EXTRA) - {"predicted"} <= set(got.columns)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert quality_classifier.classify(none, labels.where("false")).count() == 0
    x, n = quality_classifier.encode_passages(["", LONG, "a"])
    assert n.tolist() == [1, math.ceil(60_000 / 64), 1] and len(x) == n.sum()


def naive_distance(text, profile):
    grams = collections.Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        w = f" {word} "
        grams.update([c for c in word] + [w[i : i + 2] for i in range(len(w) - 1)] + [w[i : i + 3] for i in range(len(w) - 2)])

    def code(g):
        n = 0
        for c in g:
            n = n << 21 | (1 if c == " " else ord(c) + 2)
        return n

    top = sorted(grams, key=lambda g: (-grams[g], code(g)))[: language_id.PROFILE]
    return sum(abs(profile[code(g)] - i) if code(g) in profile else language_id.PROFILE for i, g in enumerate(top)) / (language_id.PROFILE * max(1, len(top)))


def test_language_distances_and_accuracy(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = language_id.learn_profiles(docs)
    sample = [t for t in list(texts(spark, sf).values())[:40]]
    d, lettered = language_id.distances(sample, profiles)
    for i, t in enumerate(sample):
        for j in range(len(profiles.languages)):
            assert d[i, j] == pytest.approx(naive_distance(t, dict(zip(profiles.codes[j].tolist(), profiles.ranks[j].tolist()))) if lettered[i] else 1.0)
    got = language_id.identify_documents(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97


def test_language_edges(docs, none):
    got = language_id.identify_documents(docs).collect()
    assert len(got) == len(ROWS)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 6)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language_id.identify_documents(none).count() == 0
    assert {r["lang_pred"] for r in language_id.identify_documents(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- pages and urls -----------------------------------------------------------------------


def article_of(page):
    body = page[page.index("<article>") + 9 : page.index("</article>")]
    body = re.sub(r"</?b>", "", body).replace("<br>", " ")
    blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(x for x in blocks if x)


def test_pages_of_the_tables(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.QUERIES["op2_template_extraction"](spark, sf).collect():
        assert r["text"] == article_of(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_template_text_without_any_role_is_dropped(spark):
    page = "<html><body><div><span>Welcome to our site</span></div><div><p>Story {0} begins&nbsp;here &amp; goes on.<p>Second {0} part</div><div>All rights reserved</div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(20)] + [(99, None, None), (100, "x", "<p>Only <b>this</b> < that</p><!-- no --><script>var a='</p>';</script>"), (101, "http://h.example/q", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("template", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_extraction.extract(df).collect()}
    assert got[3] == "Story 3 begins here & goes on.\n\nSecond 3 part"
    assert got[99] == "" and got[101] == "" and got[100] == "Only this < that"
    assert html_extraction.extract(df.where("page_id < 0")).count() == 0


def test_a_template_text_comes_with_the_element_that_holds_it(spark):
    # The notice and its <section> stand in 19 of 20 pages. So does the line, but the <div> around it stands in all: that is a slot.
    page = "<html><body><div>{line}</div>{notice}<ul><li><p>Story {0}</p><p>The same end</p></li></ul></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i, line="A line of many" if i else "Another", notice="<section>A notice</section>" if i else "")) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extraction.extract(df).collect()}
    assert got == {i: f"A line of many\n\nStory {i}" if i else "Another\n\nStory 0" for i in range(20)}
    hosts = html_extraction.templates(df.select(F.lit("h").alias("host"), F.col("page_id").alias("key"), "html")).collect()
    assert [len(r["template"]) for r in hosts] == [2]


def test_boilerplate_elements_are_left_out():
    page = """<body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><form><p>Search</p></form>
    <main><h2>Title</h2><p>One<br>two <i>three</i></p><aside>Side</aside><ul><li>a<li>b</ul><div id="comments"><p>Reader</p></div></main><footer>End</footer></body>"""
    assert html_extraction.main_text(page) == "Title\n\nOne two three\n\na\n\nb"


def test_urls(spark, sf):
    rules = queries.URL_RULES
    rows = [(1, "HTTP://Www.Example.NET/en/a?b#c"), (2, "http://a.net/x"), (3, "http://net?/"), (4, None), (5, "no scheme"), (6, "http://example.com/de/"), (7, "http://w.org/fr/1"), (8, "http://freecasinobets.example.org/en/1"), (9, "http://gardenbooks.example.org"), (9, "http://gardenbooks.example.org"), (10, "http://xnet/y"), (11, "a://b://c/d")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[1] == ("www.example.net", "/en/a", "example.net/en/", "allow")
    assert got[2] == ("a.net", "/x", "net/", "block") and got[3] == ("net", "", None, "allow")
    assert got[4] == got[5] == ("", "", None, "allow")
    assert got[6][2:] == ("example.com/de/", "block") and got[7][2:] == ("org/fr/", "allow")
    assert got[8][2:] == (None, "block") and got[9][2:] == (None, "allow") and got[10][2] is None and got[11][:2] == ("b:", "//c/d")
    assert url_filters.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    assert url_filters.Segmenter({"free": 9, "bets": 9, "be": 1}).split("freebets") == ["free", "bets"]
    assert queries.QUERIES["op10_segmented_url_filter"](spark, sf).where("verdict IS NULL").count() == 0


def brute_url_scores(urls):
    """Viterbi over all cuts and naive Bayes, in plain Python, from the words of ``url_filters``."""
    seeds = sorted({*url_filters.ORDINARY, *url_filters.BLOCKED})
    pairs = [(u.split("://")[1].split("/")[0], "/" + u.split("://")[1].split("/", 1)[1]) for u in urls]
    counts = collections.Counter(w for h, _ in pairs for label in h.split(".") if "-" in label for w in label.split("-") if re.fullmatch("[a-z]{3,24}", w))
    each = max(200, sum(counts.values()) // len(seeds))
    counts.update(dict.fromkeys(seeds, each))
    total = sum(counts.values())

    @functools.cache
    def best(run):
        if not run:
            return 0.0, ()
        found = []
        for i in range(max(0, len(run) - 24), len(run)):
            cost, words = best(run[:i])
            word = run[i:]
            found.append((cost + (math.log10(counts[word] / total) if word in counts else 1 - math.log10(total) - len(word)), words + (word,)))
        return max(found, key=lambda f: (round(f[0], 9), len(f[1][-1])))

    words = {}
    for h, p in pairs:
        host = [w for run in re.findall("[a-z]+", h) for w in best(run)[1]]
        words[h, p] = host, ["/" + ("0" if w.isdigit() else w) for w in re.findall("[a-z0-9]+", p)]
    bad, good = collections.Counter(dict.fromkeys(url_filters.BLOCKED, 200)), collections.Counter(dict.fromkeys(url_filters.ORDINARY, 200))
    blocked = 0
    for pair in pairs:
        strong = bool(set(words[pair][0]) & set(url_filters.STRONG))
        blocked += strong
        (bad if strong else good).update(words[pair][0] + words[pair][1])
    known = {*bad, *good}
    tb, tg = sum(bad.values()) + len(known), sum(good.values()) + len(known)
    share = min(0.5, max(0.05, blocked / len(pairs)))
    x = [math.log(share / (1 - share)) + sum(math.log((bad[w] + 1) / tb) - math.log((good[w] + 1) / tg) for w in sum(words[p], [])) for p in pairs]
    return [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in x]


def test_url_scores_equal_brute_force_with_counts_above_any_cap(spark, monkeypatch):
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefgh"))
    made = ["".join(rng.choice(letters, rng.integers(3, 7))) for _ in range(60)]
    urls = []
    for i in range(900):
        a, b, c = rng.choice(made, 3)
        top = rng.choice(["com", "org"])
        names = [f"{a}-{b}.{top}", f"{a}{b}.{c}.{top}", f"casino{a}.{top}", f"{made[0]}-{made[1]}.{top}"]
        urls.append(f"http://{names[i % 4]}/{c}/{i % 50}/{'bonus' if i % 4 == 2 else 'news'}")
    want = brute_url_scores(urls)
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"host": F.lit(1), "word": F.lit("x"), "n": F.lit(2)})
    got = {r["page_id"]: r["score"] for r in url_filters.judge(df, []).collect()}
    assert [got[i] for i in range(len(urls))] == pytest.approx(want, abs=1e-7)
    monkeypatch.setattr(url_filters, "small_side", lambda side: side.hint("merge"))
    again = {r["page_id"]: r["score"] for r in url_filters.judge(df, []).collect()}
    assert again == got


def test_rare_words_and_long_urls_count(spark):
    """More than 50,000 words, each seen once, and a host of 20,000 letters."""
    pairs = spark.range(60_000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/").alias("path"), F.lit(1).cast("long").alias("n"), F.array(F.concat(F.lit("w"), "id")).alias("words"), (F.col("id") % 2 == 0).alias("blocked"))
    weights, _ = url_filters.learn(pairs)
    assert weights.where("word RLIKE '^w[0-9]+$' AND weight != 0").count() == 60_000
    long = [(1, "http://" + "freebets" * 2500 + ".com/" + "a" * 100_000), (2, "http://" + "é" * 300 + ".com/x"), (3, "http://1.2.3.4")]
    got = {r["page_id"]: r for r in url_filters.judge(spark.createDataFrame(long, "page_id long, url string"), []).collect()}
    assert got[1]["verdict"] == "block" and got[3]["host"] == "1.2.3.4" and len(got) == 3


# --- chats --------------------------------------------------------------------------------


def test_chats_round_trip(spark):
    rng = random.Random(6)
    pieces = ["<s>", "</s>", "[INST]", "[/INST]", "<", "[", "\\", "/s>", "INST]", "é", "日", "\n", " ", "ok", "<\\/s>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "[/INST]"]), "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))) for c in range(60) for t in range(rng.randrange(1, 6))]
    rows += [(None, None, None, None), (None, 1, "assistant", "x"), (70, 1, "assistant", "a"), (70, 1, "assistant", "a"), (71, 0, "user", "w " * 700_000), (71, 1, "assistant", LONG), (71, 2, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit(0)).repartition(4)
    formatted = chat_formatting.format_conversations(df, public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["conv_id"]: r for r in chat_formatting.digest_conversations(formatted).collect()}
    groups = collections.defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(groups)
    for c, own in groups.items():
        own.sort()
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(own), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert formatted.where("segment > 0").count() > 0
    assert chat_formatting.digest_conversations(chat_formatting.format_conversations(df.where("turn > 9"), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


def test_a_long_conversation_is_encoded_as_one(spark):
    """Over 3 M characters in segments: ids, characters of the tokens and the mask are those of the whole."""
    rng = random.Random(8)
    words = ["alpha", " beta", "><", "</s>", "<s>", "'s", "\n\n", "  ", "é", "日本", "12", "[INST]", ".", "<"]
    rows = [(5, i, ["user", "assistant"][i % 2], "".join(rng.choices(words, k=2000))) for i in range(560)] + [(6, 0, "assistant", "short")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    parts = sorted((r for r in chat_formatting.format_conversations(df, path).collect() if r["conv_id"] == 5), key=lambda r: r["segment"])
    assert len(parts) > 2
    whole, spans = chat_formatting.render([(r, t) for k, _, r, t in rows if k == 5])
    assert "".join(p["text"] for p in parts) == whole and len(whole) > 3_000_000
    e = chat_formatting.tokenizer(path).encode(whole, add_special_tokens=False)
    assert [i for p in parts for i in p["ids"]] == e.ids
    base = np.cumsum([0] + [len(p["text"]) for p in parts])
    got = [(a + b, z + b) for p, b in zip(parts, base.tolist()) for a, z in zip(p["starts"], p["ends"])]
    assert got == [tuple(o) for o in e.offsets]
    ends = np.array(e.offsets)
    want, _ = chat_formatting.masked(ends[:, 0], ends[:, 1], spans)
    assert [m for p in parts for m in p["mask"]] == want.tolist()



# --- neighbours ---------------------------------------------------------------------------


def test_hilbert_steps_are_neighbours():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    high, low = nearest_neighbours.hilbert_keys(cells, 3)
    keys = high << 3 | low  # one level of three is in the low half
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 24)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9002, [0.0] * 24), (9003, [float("nan")] * 24), (None, x[0].tolist()), (9050, [None] * 24), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("uid", F.lit(1))
    got = collections.defaultdict(list)
    for r in nearest_neighbours.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 6000, 50))
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hit = 0
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        if 100 <= q < 400:
            assert [v for v, _ in found] == [i for i in range(100, 106) if i != q][:5]
        want = set(np.lexsort((np.arange(len(s)), -s.round(12)))[:5])
        hit += len(want & {v for v, _ in found})
        assert all(abs(s[v] - score) < 1e-9 for v, score in found) and len(found) == 5
    assert hit / (5 * len(got)) >= 0.9
    few = nearest_neighbours.search(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"]) for r in sorted(few, key=lambda r: r["rank"])] == [(0, 1), (0, 2)]
    assert nearest_neighbours.search(df.where("vec_id > 9000"), F.col("vec_id") > 0).count() == 0


@pytest.mark.parametrize("n, kind", [(3000, "one"), (9000, "one"), (6000, "twenty")])
def test_neighbours_recall_in_clusters(spark, n, kind):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, 64)) / 8
    if kind == "one":  # a third of the vectors are nearly equal
        x[: n // 3] = x[0] + rng.normal(size=(n // 3, 64)) * 0.0005
    else:
        x = x[:20][np.arange(n) % 20] + rng.normal(size=(n, 64)) * 0.002
    x = x.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(10**6 + i, [1.0, float(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in nearest_neighbours.search(df, F.col("vec_id") % 50 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = []
    for q in range(0, n, 50):
        s = unit @ unit[q]
        s[q] = -9
        hits.append(len(set(np.argsort(-s)[:5].tolist()) & got[q]) / 5)
    inside = hits[: len(hits) // 3] if kind == "one" else hits
    assert np.mean(hits) >= 0.9 and np.mean(inside) >= 0.9, (np.mean(hits), np.mean(inside))
    assert got[10**6] == {10**6 + i for i in range(1, 6)}  # another length is searched by itself


# --- pipeline -----------------------------------------------------------------------------


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    rows = docs.toPandas().sort_values("doc_id")
    rows = rows[model.score(rows.text.tolist()) >= 0.3]
    chosen = quality_rules.calibrate(spark.createDataFrame(rows), labels)
    kept = []
    for r in rows.itertuples():
        n_words, chars, symbols, dup, rep = naive_counts(r.text)
        lines = sum(bool(WORD.search(x)) for x in r.text.split("\n"))
        capitals = sum(c.isupper() and c.lower() != c for c in r.text)
        rates = {"symbols": symbols / max(1, n_words), "capitals": capitals / max(1, chars), "marks": len(re.findall("[!?]", r.text)) / max(1, n_words), "repeated_lines": dup / max(1, lines), "repeated_words": rep / max(1, n_words), "long_words": chars / max(1, n_words)}
        fails = n_words < 50 or 100 * rep > 50 * n_words
        if not fails and all(v <= chosen.get(k, {}).get(r.lang or "", 1e9) for k, v in rates.items()):
            kept.append((r.doc_id, r.text))
    fps = {k: naive_fingerprint(t) for k, t in kept}
    first = set()
    for group in naive_components(np.array(sorted(set(fps.values())), np.uint64)):
        first.add(min(k for k, f in fps.items() if f in group))
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert set(got.doc_id) == first
    assert all(g.length.sum() <= 4096 for _, g in got.groupby("sequence_id"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "best_fit_packing"]


def test_pipeline_stages_take_edge_rows(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, str(tmp_path)).columns == docs.columns
            stage(spark, frame, str(tmp_path)).count()
