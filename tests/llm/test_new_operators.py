"""Whitening, conversation repair and language-model scoring against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pixelfold.llm import conversation_repair, lm_scoring, queries, whitening
from pixelfold.llm.conversation_repair import Prefixes, Repair
from pixelfold.llm.lm_scoring import CONTEXTS, Level, Model, Sampler, Totals, Words
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# --- whitening ----------------------------------------------------------------------------


@pytest.mark.parametrize("width, n, kind", [(6, 40, "plain"), (6, 40, "twins"), (1, 9, "plain"), (24, 10, "plain"), (5, 30, "constant"), (8, 200, "far")])
def test_rank_one_updates_equal_the_whole_decomposition(width, n, kind):
    rng = np.random.default_rng(width * n)
    x = np.floor(rng.normal(size=(n, width)) * rng.uniform(1, 50, width)) + (1e6 if kind == "far" else 0)
    if kind == "twins":
        x[:, 3] = x[:, 2]
        x[20:] = x[:20]
    if kind == "constant":
        x[:] = x[0]
    a, b = whitening.Spectrum.empty(width), whitening.Spectrum.empty(width)
    for i, row in enumerate(x):
        (a if i % 3 else b).add_row(row)
    a.add(b)
    c = x - x.mean(0)
    m = c.T @ c
    scale = max(1.0, np.abs(m).max())
    assert a.n == n and np.allclose(a.mean, x.mean(0), rtol=1e-12)
    assert np.abs(a.lam - np.linalg.eigvalsh(m)).max() < 1e-9 * scale
    assert np.abs(a.u @ np.diag(a.lam) @ a.u.T - m).max() < 1e-9 * scale
    assert np.abs(a.u.T @ a.u - np.eye(width)).max() < 1e-9


def test_secular_roots_of_close_poles():
    lam = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-7, 50.0])
    z2 = np.array([1e-12, 0.3, 1e-6, 0.2, 2.0])
    diff = whitening.secular_roots(lam, z2)
    got = lam.argmin() + np.sort(np.array([lam[np.abs(d).argmin()] - d[np.abs(d).argmin()] for d in diff]))
    z = np.sqrt(z2)
    assert np.allclose(got, np.linalg.eigvalsh(np.diag(lam) + np.outer(z, z)), atol=1e-13 * 50)


def naive_whitening(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    value, vector = np.linalg.eigh(c.T @ c / n)
    keep = value[::-1] > 1e-9 * max(1e-300, value.sum())
    value, vector = value[::-1][keep][:16], vector[:, ::-1][:, keep][:, :16]
    far = n * x - s
    return n, (far * far).sum(1), far / n @ vector / np.sqrt(value), value / np.trace(c.T @ c / n)


@pytest.mark.parametrize("chain", [7, 4096])
def test_whitening_equals_brute_force(spark, monkeypatch, chain):
    monkeypatch.setattr(whitening, "CHAIN_ROWS", chain)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rng = np.random.default_rng(5)
    wide = (rng.normal(size=(300, 20)) * np.linspace(0.05, 1, 20)).astype(np.float32)
    wide[100:200] = wide[100]
    short = rng.normal(size=(12, 3)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(wide)] + [(1000 + i, v.tolist()) for i, v in enumerate(short)]
    bad = [(2000, None), (2001, [float("nan")] * 20), (2002, [None] * 20), (2003, [float("inf")] + [0.0] * 19), (2004, [])]
    df = spark.createDataFrame([*rows, *bad, (None, wide[0].tolist()), (5, wide[5].tolist())], "vec_id long, embedding array<float>")
    df = df.select("*", *(F.lit(1).alias(c) for c in ("x", "v", "n", "id", "group", "component"))).repartition(5)
    got = whitening.whiten(df).toPandas()
    assert set(got.vec_id.dropna().astype(int)) == {i for i, _ in rows}
    assert len(got) == 302 * 16 + 12 * 3
    for ids, vectors in ((range(300), wide), (range(1000, 1012), short)):
        n, deviation, white, explained = naive_whitening(vectors)
        own = got[got.vec_id.isin(ids)].drop_duplicates(["vec_id", "component"])
        assert set(own.n) == {n} and own.identity_error.max() < 1e-9
        table = own.pivot(index="vec_id", columns="component", values="whitened").loc[list(ids)].to_numpy()
        assert np.abs(table * np.sign((table * white).sum(0)) - white).max() < 1e-8
        assert (own.groupby("vec_id").deviation.first().loc[list(ids)].to_numpy() == deviation).all()
        assert np.allclose(own.groupby("component").explained.first(), explained, rtol=1e-10)


def test_whitening_edges(spark):
    def of(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))

    assert of([]).count() == 0
    assert of([(1, None)]).count() == 0
    assert of([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0  # one different vector: nothing varies
    two = of([(1, [0.0, 0.0]), (2, [1.0, 0.0])]).collect()
    assert [(abs(r["whitened"]), r["component"], r["explained"], r["deviation"]) for r in two] == [(pytest.approx(1.0), 1, pytest.approx(1.0), 64 * 64)] * 2
    huge = of([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])]).collect()
    assert {r["deviation"] for r in huge} == {None, (3 * 0 - 0) ** 2 + (3 * 320 - 384) ** 2} - ({None} if all(r["deviation"] is not None for r in huge) else set())
    assert all(math.isfinite(r["whitened"]) for r in huge)


# --- conversations ------------------------------------------------------------------------

LEGAL = re.compile(r"(s?(ua)+)?")


def naive_repair(rows, inserts=None):
    """Every choice of edits: (cost, audit, repaired) of the best. rows: (role, text, fault)."""
    best = (10**9, "", "")
    n = len(rows)

    def walk(i, cost, audit, out, run):
        nonlocal best
        if cost > best[0] or run > 2:
            return
        if i == n and LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in out)):
            best = min(best, (cost, audit, "\n".join(f"{r}:{t}" for r, t in out)))
        for role in ("user", "assistant"):
            walk(i, cost + 3, audit + "I", [*out, (role, "")], run + 1)
        if i < n:
            role, text, fault = rows[i]
            walk(i + 1, cost + 4, audit + "D", out, 0)
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                walk(i + 1, cost + extra, audit + "K", [*out, (role, text)], 0)
                for other in ("user", "assistant"):
                    walk(i + 1, cost + 3 + extra, audit + "R", [*out, (other, text)], 0)

    best = (4 * n + 1, "~", "")
    walk(0, 0, "", [], 0)
    return best


class Colliding(Prefixes):
    """Every prefix of one length parity has the same hash."""

    def __init__(self):
        super().__init__(base=0, prime=2)


@pytest.mark.parametrize("prefixes", [Prefixes, Colliding])
@pytest.mark.parametrize("waiting", [1, 3, 256])
def test_repair_equals_all_choices(prefixes, waiting):
    rng = random.Random(waiting)
    for _ in range(120):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), f"t{i}", rng.choice([None, None, None, "truncated", "blank", "duplicate"])) for i in range(rng.randrange(6))]
        own = Repair(prefixes, waiting)
        for r in rows:
            own.row(*r)
        cost, audit, digest = own.finish()
        want = naive_repair(rows)
        assert (cost, audit, digest) == (want[0], want[1], hashlib.sha256(want[2].encode()).hexdigest()), rows


@pytest.mark.parametrize("prefixes", [Prefixes, Colliding])
def test_prefixes_compare_like_strings(prefixes):
    rng = random.Random(4)
    p = prefixes()
    nodes = [0]
    for _ in range(300):
        nodes.append(p.extend(rng.choice(nodes[-40:]), rng.choice("DIK")))
    for a, b in itertools.product(rng.sample(nodes, 60), repeat=2):
        assert p.less(a, b) == (p.text(a) < p.text(b))
        depth = rng.randrange(p.depth[a] + 1)
        assert p.text(p.ancestor(a, depth)) == p.text(a)[:depth]


def test_long_conversations_settle_as_they_go():
    rng = random.Random(9)
    rows = [(rng.choice(["user", "assistant", "system"]), f"t{i}", rng.choice([None, None, "truncated", "blank"])) for i in range(6000)]
    few, all_ = Repair(most_waiting=64), Repair(most_waiting=10**9)
    for r in rows:
        few.row(*r)
        all_.row(*r)
        assert len(few.waiting) <= 200
    assert few.finish() == all_.finish()


def test_repair_edges(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (1, 5, "assistant", "no end"), (None, 3, "user", "Yes!"), (None, None, "assistant", "Sure."),
        (2, 1, "", ""), (3, 1, "user", "x. " * 100_000), (3, 2, "assistant", " \t\n."), (3, 3, "assistant", "ok?\x0b"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).select("*", *(F.lit(1).alias(c) for c in ("fault", "copy", "kind", "nth"))).repartition(4)
    got = {r["conv_id"]: r for r in conversation_repair.repair(df).collect()}
    assert set(got) == {1, 2, 3, None}
    one = got[1]
    assert (one["gaps"], one["blank"], one["duplicate"], one["truncated"], one["illegal"]) == (4, 1, 1, 1, 2)
    assert (one["cost"], one["audit"]) == (11, "DKDK")
    assert one["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:no end").hexdigest()
    assert (got[2]["cost"], got[2]["audit"], got[2]["repaired_sha256"]) == (4, "D", hashlib.sha256(b"").hexdigest())
    assert (got[None]["gaps"], got[None]["cost"], got[None]["audit"]) == (0, 6, "IKKI")
    assert (got[3]["truncated"], got[3]["cost"], got[3]["audit"]) == (0, 3, "KKIK")
    assert conversation_repair.repair(df.where("turn > 99")).count() == 0
    gone = conversation_repair.repair(df.select("conv_id", "turn", "role", "text", F.lit(True).alias("gone"))).collect()
    assert {(r["conv_id"], r["gaps"], r["cost"], r["audit"], r["repaired_sha256"]) for r in gone} == {(c, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in (1, 2, 3, None)}
    damaged = conversation_repair.damage(df).collect()
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        own = [r for r in damaged if (r["conv_id"], r["turn"]) == (conv_id, turn)]
        times = sum((c, t) == (conv_id, turn) for c, t, _, _ in rows)
        assert len(own) == times * (2 if kind == 3 else 1) and all(r["gone"] == (kind == 0) for r in own)
        text = {1: "", 2: re.sub("[.!?]", "", text or " ")}.get(kind, " " if text is None else text)
        assert all((r["role"], r["text"]) == ("user" if kind == 4 else " " if role is None else role, text) for r in own)


# --- language model -----------------------------------------------------------------------


def tokens_of(text):
    return WORD.findall((text or "").translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)}))) + [""]


def test_language_model_base_and_gain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.QUERIES["op13_pitman_yor_score"](spark, sf).toPandas().set_index("doc_id")
    rows = {r["doc_id"]: tokens_of(r["text"]) for r in docs.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in rows}
    c = Counter(w for k, t in rows.items() if not held[k] for w in t)
    n, v = sum(c.values()), len(c)
    for k, t in rows.items():
        r = got.loc[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
    out = got[got.held_out]
    assert out.score.sum() / out.n_tokens.sum() > out.base_score.sum() / out.n_tokens.sum() + 0.1


def words_of(customers):
    """A batch of words and its model from {(word number, context): customers}."""
    keys = sorted(customers)
    word, context = (np.array([k[i] for k in keys]) for i in (0, 1))
    c = np.array([customers[k] for k in keys], np.int64)
    by_context, tables = np.bincount(context, c, CONTEXTS).astype(np.int64), np.zeros(CONTEXTS + 257, np.int64)
    tables[:CONTEXTS] = np.bincount(context[c > 0], minlength=CONTEXTS)
    tables[CONTEXTS : CONTEXTS + 256] = tables[:CONTEXTS].reshape(256, 256).max(0)
    tables[-1] = len({k[0] for k in keys if customers[k]})
    model = Model(Sampler(sweeps=6), 0.6, int(tables[-1]), int(c.sum()), [Totals(by_context, tables)])
    return model, Words(model, mixed_seeds(word.max() + 1), word, context, c)


def mixed_seeds(n):
    return lm_scoring.mixed(np.arange(n, dtype=np.uint64))


def test_probabilities_of_a_restaurant_sum_to_one():
    rng = random.Random(3)
    contexts = [0, 97, 98, 97 * 256 + 98, 99 * 256 + 98, 5]
    customers = {(w, u): rng.choice([0, 0, 1, 1, 2, 5, 40, 3000]) for w in range(30) for u in contexts}
    customers |= {(w, 98): 7 for w in range(30)}  # every word occurs
    model, own = words_of(customers)
    own.start(model.history[0])
    for _ in range(6):
        own.sweep(model.history[-1])
        model.history.append(Totals(model.history[0].customers, own.table_counts()))
        for level, customers_below in ((own.low, own.customers), (own.mid, own._to_endings(own.low.tables)), (own.top, own._to_root(own.mid.tables))):
            assert (level.customers == customers_below).all() and (level.tables <= level.customers).all() and ((level.tables > 0) == (level.customers > 0)).all()
            room = level.room[level.live]
            owner = np.repeat(level.live, room)
            assert (np.bincount(owner, level.sizes, len(level.room))[level.live] == level.customers[level.live]).all()
            assert (np.bincount(owner, level.sizes > 0, len(level.room))[level.live] == level.tables[level.live]).all()
        p = own.predictive(model.history[-1])[2]
        d = model.discount
        for u in contexts:
            ending = u & 255
            t = model.history[-1].tables
            root = (1 + d * t[-1]) / (1 + t[CONTEXTS : CONTEXTS + 256].sum()) / (model.vocabulary + 1)
            mid = (1 + d * t[CONTEXTS + ending]) / (1 + t[:CONTEXTS].reshape(256, 256).sum(0)[ending]) * root
            unseen = (1 + d * t[u]) / (1 + model.history[0].customers[u]) * mid
            assert p[own.context == u].sum() + unseen == pytest.approx(1.0)


def test_seating_follows_the_process():
    """Many equal dishes: the mean number of tables after many moves is that of the exact distribution."""
    c, d, new, n = 6, 0.5, 0.8, 4000
    # Exact by enumeration of table counts: weight of a partition is the product of rising factorials and new ** tables.
    weight = {(): 1.0}
    for _ in range(c):
        grown = Counter()
        for sizes, w in weight.items():
            grown[tuple(sorted((*sizes, 1)))] += w * new
            for i, s in enumerate(sizes):
                grown[tuple(sorted((*sizes[:i], s + 1, *sizes[i + 1 :])))] += w * (s - d)
        weight = grown
    exact = sum(len(s) * w for s, w in weight.items()) / sum(weight.values())
    many = np.full(n, c)
    level = Level(mixed_seeds(n), many, many, np.full(n, new), 200)
    level.move(np.full(n, new), d, 200)
    assert level.tables.mean() == pytest.approx(exact, abs=0.06)


@pytest.mark.parametrize(("c", "d", "new"), [(6, 0.5, 0.8), (60, 0.7, 3.0), (60, 0.7, 1e-4), (3000, 0.7, 1.5), (3000, 0.6, 400.0), (3000, 0.3, 30_000.0)])
def test_one_move_seats_every_customer(c, d, new):
    """One move is enough for the numbers of tables to follow their law, however many customers sat as at first."""
    log_p = np.zeros(1)  # of 1, 2, ... tables: a customer joins one of t tables by n - d * t in all, or opens one by ``new``
    for n in range(1, c):
        t = np.arange(1, n + 1)
        log_p = np.logaddexp(np.append(np.log(n - d * t) + log_p, -np.inf), np.append(-np.inf, log_p + math.log(new)))
    law = np.cumsum(np.exp(log_p - np.logaddexp.reduce(log_p)))
    many = np.full(3000, c)
    level = Level(mixed_seeds(len(many)), many, many, np.full(len(many), new), 1)
    level.move(np.full(len(many), new), d, 1)
    found = np.cumsum(np.bincount(level.tables, minlength=c + 1)[1 : c + 1]) / len(many)
    assert np.abs(found - law).max() < 0.04


def test_words_of_texts_and_slices():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aB \t\n\x0b\x0c\r\x1c\x85 \u00e9\u65e5\u03a3\u2003.x") for _ in range(rng.randrange(30))) for _ in range(300)] + [None, "", " ", "  a", "a  ", "\u0130 K \u1e9e"]
    whole = pa.array(texts, pa.string())
    for at, n in [(0, len(texts)), (0, 0), (7, 50), *((i, 1) for i in range(len(texts)))]:
        words, tokens, sizes = lm_scoring.split_words(whole.slice(at, n))
        spelled = words.to_pylist()
        assert [spelled[i] for i in tokens] == [w for x in texts[at : at + n] for w in tokens_of(x)]
        assert sizes.tolist() == [len(tokens_of(x)) for x in texts[at : at + n]]
        assert lm_scoring.last_bytes(words).tolist() == [int.from_bytes(w.encode()[-2:], "big") for w in spelled]


def test_pairs_are_numbered_alike_by_both_sorts():
    code = np.array([5, 3, 5, 0, 1 << 40, 3])
    for limit in (1 << 41, 1 << 62):  # the higher limit leaves no room for the place
        values, at = lm_scoring.numbered(code.copy(), limit)
        assert values.tolist() == [0, 3, 5, 1 << 40] and at.tolist() == [2, 1, 2, 0, 3, 1]


def test_language_model_edges(spark):
    rows = [(1, "A b a", 1), (1, "A b a", 1), (2, None, 1), (3, "", 1), (None, "x \x1c y", 1), (4, "long " * 60_000, 1), (5, "unseen words only", 0), (6, "É é Σ 日本", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn int").select("*", *(F.lit(1).alias(c) for c in ("key", "first", "n", "word", "block", "training"))).repartition(3)
    for block in (1, 1 << 20):
        got = lm_scoring.score_documents(df, F.col("learn") == 1, block_bytes=block).collect()
        assert len(got) == len(rows) and all(r["train_tokens"] == 4 + 4 + 1 + 1 + 4 + 60_001 + 5 for r in got)
        assert all(math.isfinite(r["score"]) and r["score"] < 0 and r["perplexity"] >= 1 for r in got)
        by = {r["doc_id"]: r for r in got}
        assert by[2]["n_tokens"] == 1 and by[2]["score"] == by[3]["score"] and by[5]["n_known"] == 1 and by[None]["n_tokens"] == 4
        assert by[6]["n_tokens"] == 5
    once = {r["doc_id"]: r["score"] for r in got}
    again = lm_scoring.score_documents(df.repartition(1), F.col("learn") == 1).collect()
    assert all(once[r["doc_id"]] == pytest.approx(r["score"], rel=1e-12) for r in again)
    assert lm_scoring.score_documents(df.where("false"), F.col("learn") == 1).count() == 0
    alone = lm_scoring.score_documents(df, F.lit(False)).collect()
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in alone)


def test_numbers_are_packed_and_read():
    for x in ([], [0], [5, 300, 70_000], [1 << 40, 3]):
        assert lm_scoring.unpacked(lm_scoring.packed(np.array(x, np.int64))).tolist() == x
    lists = lm_scoring.unbundled(lm_scoring.bundle(np.array([True, False]), np.array([], np.int64), np.array([-7]).view(np.uint64)))
    assert [x.tolist() for x in lists] == [[1, 0], [], [-7]]


def test_contexts_are_whole_words(spark):
    """Words before that share their last bytes still tell apart what follows."""
    learned = [(i, ("cath crimson", "moth maroon")[i % 2]) for i in range(200)]
    asked = [(1000, "cath crimson"), (1001, "cath maroon"), (1002, "moth maroon"), (1003, "moth crimson")]
    docs = spark.createDataFrame(learned + asked, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(docs, F.col("doc_id") < 1000).collect()}
    assert got[1000] > got[1001] + 1 and got[1002] > got[1003] + 1


def test_scores_do_not_depend_on_blocks(spark):
    rng = random.Random(8)
    words = ["the", "he", "she", "a", "日", "x", "|", *(f"w{i}" for i in range(40))]
    rows = [(k if rng.random() < 0.9 else None, " ".join(rng.choice(words[: rng.choice([4, 47])]) for _ in range(rng.randrange(40)))) for k in range(-20, 180)] + [(500, None), (501, ""), (3, "the he"), (3, "the he")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, i int")
    n = Counter(w for _, t in rows[::2] for w in tokens_of(t))
    found = []
    for parts, size in ((1, 1 << 20), (5, 300)):
        got = lm_scoring.score_documents(docs.repartition(parts), F.col("i") % 2 == 0, block_bytes=size).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == Counter((k, len(tokens_of(t)), sum(n[w] > 0 for w in tokens_of(t)), n.total()) for k, t in rows)
        found.append(sorted((r["doc_id"] or 0, r["training"], r["n_tokens"], r["base_score"], r["score"]) for r in got))
    assert all(a == pytest.approx(b, rel=1e-9) for a, b in zip(*found, strict=True))
    none = lm_scoring.score_documents(docs, F.lit(False)).collect()
    assert {(r["base_score"], r["score"], r["train_tokens"]) for r in none} == {(0.0, 0.0, 0)}
    assert lm_scoring.score_documents(docs.where("i < 0"), F.lit(True)).count() == 0


@pytest.mark.parametrize("merged", [50, 1 << 21])
def test_probabilities_after_whole_words_sum_to_one(monkeypatch, merged):
    """Letters between three buckets, carried by hand: tables of each word's restaurant add up over the buckets, and so do probabilities."""
    monkeypatch.setattr(lm_scoring, "MERGED_TOGETHER", merged)
    rng = random.Random(6)
    n, buckets, sweeps = 30, 3, 4
    ending = [[0, 97, 98, 97 * 256 + 98, 99 * 256 + 98, 5][u % 6] for u in range(n)]
    customers = {(w, u): rng.choice([0, 0, 1, 1, 2, 5, 40]) for w in range(n) for u in range(n)} | {(w, 3): 7 for w in range(n)}
    shares = {8: {p: c // 2 for p, c in customers.items() if rng.random() < 0.5}}
    shares[7] = {p: c - shares[8].get(p, 0) for p, c in customers.items()}

    def of(mail, *kinds):
        return [r for r in mail if r[1] in kinds]

    def handled(mail, answer):
        out = []
        for receiver in {r[0] for r in mail}:
            own = [r for r in mail if r[0] == receiver]
            rng.shuffle(own)
            out += answer(receiver, pa.Table.from_batches([lm_scoring.letters(own)]))
        return out

    def numbers(mail, kind):
        return {(r[0], r[2]): lm_scoring.unbundled(r[3]) for r in of(mail, kind)}

    asks, order = [], {}
    for block, share in shares.items():
        for b in range(buckets):
            pairs = order[block, b] = sorted((p for p in share if p[0] % buckets == b), key=lambda p: (p[0] // buckets, ending[p[1]], p[1]))
            words = sorted({p[0] // buckets for p in pairs})
            dishes = sorted({(p[0] // buckets, ending[p[1]]) for p in pairs})
            per_dish = Counter((p[0] // buckets, ending[p[1]]) for p in pairs)
            body = (np.array([max(p[1] for p in pairs)]), lm_scoring.steps(np.array(words)), np.array([sum(d[0] == w for d in dishes) for w in words]), np.array([d[1] for d in dishes]), np.array([per_dish[d] for d in dishes]), np.array([p[1] for p in pairs]), np.array([share[p] for p in pairs]))
            asks.append((b, lm_scoring.ASK, block, lm_scoring.bundle(*body)))
    started = handled(asks, lm_scoring.begun(buckets))
    size = 2 * CONTEXTS + 257
    total = sum(x[0] for x in numbers(started, lm_scoring.TOTAL).values())
    assert total[:CONTEXTS].sum() == sum(c > 0 for c in customers.values())
    counts = list(customers.values())
    assert total[size : size + 2].tolist() == [counts.count(1), counts.count(2)]
    model = Model(Sampler(sweeps=sweeps), 0.6, n, sum(counts), [Totals(total[:CONTEXTS], total[CONTEXTS:size])], 0.7)
    first = tables = handled(of(started, lm_scoring.FIRST), lm_scoring.tabled)
    seats = []
    for k in range(sweeps):
        seats = handled(of(started, lm_scoring.LIVE) + of(tables, lm_scoring.REPLY) + of(seats, lm_scoring.STATE), lm_scoring.swept(model, buckets))
        total = sum(x[0] for x in numbers(seats, lm_scoring.TOTAL).values())
        model.history.append(Totals(total[:CONTEXTS], total[CONTEXTS:]))
        tables = handled(of(seats, lm_scoring.EXTRA) + of(first, lm_scoring.SEATED), lm_scoring.tabled)
        seated = numbers(tables, lm_scoring.SEATED)
        own = {}
        answers = numbers(handled(asks + of(started, lm_scoring.LIVE) + of(seats, lm_scoring.STATE), lm_scoring.answered(model, buckets)), lm_scoring.ANSWER)
        for (block, b), (c, t, p) in answers.items():
            dishes = np.unique([(w // buckets) * CONTEXTS + ending[u] for w, u in order[block, b]], return_inverse=True)[1]
            for i, pair in enumerate(order[block, b]):
                own.setdefault(pair, (c[i], t[i], float(p.astype("<u4").view("<f4")[dishes[i]])))
                assert own[pair][:2] == (c[i], t[i])
        assert {p: x[0] for p, x in own.items()} == customers
        d, d2, after = model.word_discount, model.discount, model.history[-1]
        for u in range(n):
            ours = [own[w, u] for w in range(n)]
            t_u, c_u = sum(x[1] for x in ours), sum(x[0] for x in ours)
            assert all((x[1] > 0) == (x[0] > 0) and x[1] <= x[0] for x in ours)
            assert seated[u % buckets, u % buckets][0][u // buckets] == t_u
            t, e = after.tables, ending[u] & 255
            low = (1 + d2 * t[-1]) / (1 + t[CONTEXTS : CONTEXTS + 256].sum()) / (n + 1)
            low *= (1 + d2 * t[CONTEXTS + e]) / (1 + t[:CONTEXTS].reshape(256, 256).sum(0)[e])
            low *= (1 + d2 * t[ending[u]]) / (1 + after.customers[ending[u]])
            p = [(c - d * t + (1 + d * t_u) * p_low) / (1 + c_u) for c, t, p_low in ours]
            assert sum(p) + (1 + d * t_u) / (1 + c_u) * low == pytest.approx(1.0, rel=1e-6)
    assert any(x[1] > 1 for x in own.values())
