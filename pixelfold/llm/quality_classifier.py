"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded as a vector of
character and word statistics and a hidden layer; gated attention weights, learned from document
labels alone, say how much each passage counts; the weighted passage representation gives
the score. Passages of a whole Arrow slice are encoded at once over the flat bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_of, bounded_sample, fold, slices, texts_of

PASSAGE_WORDS = 64
HIDDEN, GATE = 16, 8
#: Labelled documents that training reads at most, each of them whole.
MOST_DOCUMENTS = 8000
THRESHOLD = 0.3
#: Text scored at once; the flat arrays of a slice take about a hundred times its size.
SCORE_BYTES = 1 << 20

# Classes of bytes: 0 white space, then lower case, capitals, digits, symbols, marks, stops, other ASCII, beyond ASCII.
CLASSES = 10
_CLASS = np.full(256, 8, np.uint8)
for _members, _kind in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3), ("#*$%&|<>~^_=+@\\{}[]", 4), ("!?", 5), (".,;:", 6), ("\"'()-/`", 7)):
    _CLASS[[ord(c) for c in _members]] = _kind
_CLASS[128:] = 9
_CLASS[[9, 11, 12, 13, 32, 10]] = 0
_MIX = np.random.default_rng(11).integers(1, 1 << 62, 256, np.int64).astype(np.uint64) | np.uint64(1)
_STEP = np.random.default_rng(12).integers(1, 1 << 62, 256, np.int64).astype(np.uint64) | np.uint64(1)
FEATURES = 17


def encode_passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Statistics of every passage (rows) and the number of passages of each text, one at least."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    kind = _CLASS[data]
    inside = kind > 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    starts = np.flatnonzero(opens)
    ends = np.cumsum(sizes)
    word_text = np.searchsorted(ends, starts, side="right")
    words = np.bincount(word_text, minlength=len(texts))
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    base = np.cumsum(passages) - passages
    total = int(passages.sum())
    first_word = np.cumsum(words) - words
    passage = base[word_text] + (np.arange(len(starts)) - first_word[word_text]) // PASSAGE_WORDS
    out = np.zeros((total, FEATURES), np.float32)
    if not len(starts):
        return out, passages
    spans = np.diff(np.append(starts, len(data)))
    lead = int(starts[0])
    byte_word = np.repeat(np.arange(len(starts)), spans)
    body, cls = data[lead:], kind[lead:]
    counts = np.bincount(passage[byte_word] * CLASSES + cls, minlength=total * CLASSES).reshape(total, CLASSES).astype(np.float64)
    chars = np.maximum(counts[:, 1:].sum(1), 1)
    n = np.maximum(np.bincount(passage, minlength=total), 1)
    place = (np.arange(len(body)) - np.repeat(starts - lead, spans)) & 255
    codes = np.add.reduceat(np.where(cls > 0, _MIX[body] * _STEP[place], np.uint64(0)), starts - lead)
    again = np.zeros(len(starts), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((codes, passage))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (codes[order][1:] != codes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    symbol_word = np.add.reduceat((cls == 4).astype(np.int32), starts - lead) > 0
    mark_word = np.add.reduceat((cls == 5).astype(np.int32), starts - lead) > 0
    capital = np.add.reduceat((cls == 2).astype(np.int32), starts - lead) > 1
    out[:, :9] = counts[:, 1:] / chars[:, None]
    for j, flags in enumerate((again, symbol_word, mark_word, capital)):
        out[:, 9 + j] = np.bincount(passage, weights=flags, minlength=total) / n
    out[:, 13] = np.bincount(passage[order], weights=fresh, minlength=total) / n
    out[:, 14] = chars / n / 10
    out[:, 15] = n / PASSAGE_WORDS
    out[:, 16] = np.log1p(np.repeat(words, passages)) / 8
    return out, passages


@dataclass(frozen=True)
class Model:
    """Weights by name; ``mean`` and ``scale`` standardise the statistics."""

    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        heads = np.cumsum(counts) - counts
        z = np.clip((x - w["mean"]) / w["scale"], -8, 8)
        h = np.tanh(z @ w["W"] + w["b"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * s) @ w["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, heads), counts))
        attention = e / np.repeat(np.add.reduceat(e, heads), counts)
        bag = np.add.reduceat(attention[:, None] * h, heads)
        score = 1 / (1 + np.exp(-np.clip(bag @ w["c"] + w["d"][0], -30, 30)))
        return {"z": z, "h": h, "t": t, "s": s, "attention": attention, "bag": bag, "score": score}

    def score(self, texts: list[str]) -> np.ndarray:
        x, counts = encode_passages(texts)
        return self.forward(x.astype(np.float64), counts)["score"]


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.02, decay: float = 1e-4) -> Model:
    """Gated attention weights from bag labels by Adam on the log loss; without both labels the score is constant."""
    rng = np.random.default_rng(7)
    f = x.shape[1]
    w = {"W": rng.normal(0, f**-0.5, (f, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": rng.normal(0, 0.3, GATE), "c": np.zeros(HIDDEN), "d": np.zeros(1)}
    fixed = {"mean": x.mean(0) if len(x) else np.zeros(f), "scale": np.maximum(x.std(0), 1e-3) if len(x) else np.ones(f)}
    share = float(y.mean()) if len(y) else 0.5
    w["d"][0] = np.log((share + 1e-3) / (1 - share + 1e-3))
    if len(np.unique(y)) < 2:
        return Model({**fixed, **w})
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, rounds + 1):
        o = Model({**fixed, **w}).forward(x, counts)
        delta = (o["score"] - y) / len(y)
        g = {"c": o["bag"].T @ delta, "d": np.array([delta.sum()])}
        d_bag = np.repeat(delta[:, None] * w["c"], counts, axis=0)
        inner = (d_bag * o["h"]).sum(1)
        mean = np.add.reduceat(o["attention"] * inner, np.cumsum(counts) - counts)
        d_e = o["attention"] * (inner - np.repeat(mean, counts))
        d_gate = d_e[:, None] * w["a"]
        g["a"] = (o["t"] * o["s"]).T @ d_e
        d_t, d_s = d_gate * o["s"] * (1 - o["t"] ** 2), d_gate * o["t"] * o["s"] * (1 - o["s"])
        g["V"], g["U"] = o["h"].T @ d_t, o["h"].T @ d_s
        d_h = (o["attention"][:, None] * d_bag + d_t @ w["V"].T + d_s @ w["U"].T) * (1 - o["h"] ** 2)
        g["W"], g["b"] = o["z"].T @ d_h, d_h.sum(0)
        for k in w:
            grad = g[k] + decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model({**fixed, **w})


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST_DOCUMENTS) -> Model:
    """Train on labelled documents whose fold of five is not 0, about ``most`` of them at most, picked by a hash of the key.

    Repeated labels of a key count once (the smaller one); rows without a label of 0 or 1 are left out. The driver
    receives ``FEATURES`` numbers for every passage of the sampled documents.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isin(0, 1)).groupBy(key).agg(F.min("quality").cast("long").alias("quality"))
    known = bounded_sample(known.where(fold(F.col(key), 5) != 0), F.col(key), most, 1)
    sample = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(known.select(F.col(key).alias("key"), "quality")), "key")
    schema = pa.schema([("key", pa.int64()), ("quality", pa.int64()), ("x", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            x, counts = encode_passages(texts_of(b.column("text")))
            ends = np.cumsum(counts)
            rows = [x[s:e].ravel() for s, e in zip(ends - counts, ends)]
            yield batch_of(schema, key=b.column("key"), quality=b.column("quality"), x=rows)

    found = sample.mapInArrow(run, "key long, quality long, x array<float>").toArrow()
    found = found.sort_by([("key", "ascending")])
    bags = [np.asarray(v.values, np.float32).reshape(-1, FEATURES) for v in found.column("x")]
    x = np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, FEATURES))
    return train(x, np.array([len(b) for b in bags], np.int64), np.asarray(found.column("quality"), np.float64))


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good likelier) and ``predicted`` of every row.

    NULL and empty texts are one passage without words and get its score. Columns of ``docs`` named so are
    replaced, all others and repeated rows are kept.
    """
    kept = docs.drop("score", "predicted")
    names = kept.columns
    narrow = kept.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(text).cast("string").alias("text"))
    row_type = narrow.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SCORE_BYTES):
            score = model.score(texts_of(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(score, pa.float64())], names=["row", "score"])

    scored = narrow.mapInArrow(run, f"row {row_type}, score double")
    return scored.select("row.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the training folds, score every row and mark the held-out ones."""
    return score_documents(docs, fit(docs, labels, key, text), key, text).withColumn("held_out", fold(F.col(key), 5) == 0)
