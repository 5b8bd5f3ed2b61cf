"""Language-model scoring by a hierarchical Pitman-Yor model over words.

A word is drawn in the restaurant of the whole word before it. That restaurant shares its parent, the last two bytes of that word, with all
words of that ending; those share the last byte alone, and these the root, whose base is uniform over the vocabulary and one unseen word.
A customer who opens a table is a customer of the parent. What a task must know of the 65,536 + 256 + 1 upper restaurants, customers and
tables of each, has a proven bound; the restaurants of whole words are as many as words, so their tables travel only where they are asked for.

Seating is sampled by Gibbs: a sweep seats all customers of each dish in each restaurant anew. Probabilities need only the number of
tables, so that number is drawn at once from its exact law given the weight of a new table. All restaurants' seats of one word lie together, so tasks
sample words independently, with the restaurants' totals of the sweep before. Random numbers come from a hash of word, restaurant and step.
After burn-in the predictive probabilities of the samples are averaged.

Documents are read in blocks, words are dealt into buckets by hash. A block tells each bucket its words and gets their numbers: ranks by
frequency, so that lists of them pack well. It then asks once for each (word before, word) in it, whatever its number of copies, and its
documents are scored with the answers. Between blocks and buckets go letters: a few rows with packed lists of numbers.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.sizing import materialize
from .common import SLICE_BYTES, batch_of, fold, slices

#: Text of one block of documents; a longer document is a block of its own.
BLOCK_BYTES = 32 << 20
#: The end of a text stands as the empty word, which no text holds; it also comes before the first word.
END = ""
CONTEXTS = 1 << 16
#: Text to one bucket of words, and the least number of buckets. Letters between all of them grow with the square of their number, so a bucket is as large as a block.
BUCKET_BYTES, LEAST_BUCKETS = BLOCK_BYTES, 64
#: Kinds of letters. To a block: its words' buckets and endings, some of its texts, its words' ranks, tables of their restaurants, answers.
HEAD, TEXT, RANK, TABLES, ANSWER = range(5)
#: To a bucket: words, totals, pairs asked for, what is sampled, seats after a sweep, followers and further tables of its words' restaurants, all their tables, those that were asked for.
WORDS, TOTAL, ASK, LIVE, STATE, FIRST, EXTRA, SEATED, REPLY = range(5, 14)
#: Entries of asks that are merged at once, more where a bucket has more pairs.
MERGED_TOGETHER = 1 << 21
LETTER = pa.schema([("receiver", pa.int64()), ("kind", pa.int32()), ("sender", pa.int64()), ("body", pa.binary())])
LETTER_DDL = "receiver long, kind int, sender long, body binary"
UPPER_TO_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Customers of a dish up to which its law is summed as a polynomial, and up to which it is looked up; integrals serve beyond.
FEW, TABLED = 16, 2048
#: Nodes of such an integral, points between which its logarithm is interpolated, integrals and terms of sums that are worked out together.
NODES, POINTS, INTEGRATED_TOGETHER, SUMMED_TOGETHER = 32, 16, 1 << 11, 1 << 18
#: The law is summed over so many standard deviations around the mean, and so many tables more below and above.
WIDTHS, BELOW, ABOVE = 7.0, 10, 22


@dataclass(frozen=True)
class Sampler:
    """``sweeps`` Gibbs sweeps over all customers, of which the first ``burn_in`` are not averaged."""

    sweeps: int = 3
    burn_in: int = 1
    strength: float = 1.0
    seed: int = 13


@dataclass
class Totals:
    """Customers and tables of all restaurants of the three levels: 65,536 contexts, 256 endings, the root."""

    customers: np.ndarray
    tables: np.ndarray

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of the restaurants of level 2 (contexts), 1 (endings) or 0 (the root)."""
        if k == 2:
            return self.customers, self.tables[:CONTEXTS]
        if k == 1:
            return self.tables[:CONTEXTS].reshape(256, 256).sum(0), self.tables[CONTEXTS : CONTEXTS + 256]
        return self.tables[CONTEXTS : CONTEXTS + 256].sum(keepdims=True), self.tables[CONTEXTS + 256 :]


@dataclass
class Model:
    """What every task needs: discounts of the upper restaurants and of those of whole words, words and tokens of the training part,
    totals before and after each sweep."""

    sampler: Sampler
    discount: float
    vocabulary: int
    tokens: int
    history: list[Totals] = field(default_factory=list)
    word_discount: float = 0.5

    def share(self, k: int, totals: Totals, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of a new table in the restaurants ``at`` of a level, and their customers with the strength."""
        customers, tables = totals.level(k)
        return self.sampler.strength + self.discount * tables[at], self.sampler.strength + customers[at]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each value (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def log_arrangements(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the generalised Stirling numbers: the weight of all arrangements of c customers at t tables stands at ``at[c] + t``."""
    rows, row = [], np.zeros(1)
    for c in range(1, TABLED + 1):
        rows.append(row)
        row = np.logaddexp(np.append(np.log(c - discount * np.arange(1, c + 1)) + row, -np.inf), np.append(-np.inf, row))
    c = np.arange(TABLED + 1)
    return c * (c - 1) // 2 - 1, np.concatenate(rows)


def log_factorial(n: np.ndarray) -> np.ndarray:
    """log n! by Stirling's series; below 9 the series is taken ten steps further up."""
    x = n + 1.0
    low = np.flatnonzero(x < 10)
    up = np.where(x < 10, x + 10, x)
    out = (up - 0.5) * np.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5)
    out[low] -= np.log(x[low, None] + np.arange(10)).sum(1)
    return out


def tilted(c: np.ndarray, new: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Saddle point, mean and variance of the tables of c customers: Poisson many tables of Sibuya sizes that sum to c.

    The saddle point x = 1 - y solves new * x * y ** (d - 1) = c; Newton's steps from y = new / (new + c) fall to it. Returned is log y.
    """
    log_y = np.log(new / (new + c))
    for _ in range(8):
        y = np.exp(log_y)
        log_y -= (np.log1p(-y) + (d - 1) * log_y + np.log(new / c)) / (d - 1 - y / (1 - y))
    y = np.exp(np.maximum(log_y, -300.0))
    mean = -np.expm1(d * log_y) * new / d
    return log_y, mean, np.maximum(mean - c * c / (c + new * (1 - d) * (1 - y) ** 2 * y ** (d - 2)), 0.0)


def log_sums(c: np.ndarray, t: np.ndarray, log_y: np.ndarray, d: float) -> np.ndarray:
    """log probability that ``t`` tables of Sibuya(d) sizes sum to ``c``. ``log_y``: about the saddle point.

    That is the c-th coefficient of (1 - (1 - x) ** d) ** t, by Cauchy's integral over x = exp(-s) on a parabola through the saddle point, or
    through 4 / c where that lies nearer to the cut; on a circle if the sizes vary so little that it needs all of it, for whole t only.
    """
    for _ in range(6):
        log_y = np.clip(log_y, -300.0, -1e-9)
        y, power = np.exp(log_y), np.exp(d * log_y)
        wrong = np.log(t / c * d * (1 - y) / (1 - power)) + (d - 1) * log_y
        log_y = log_y - wrong / np.minimum(d - 1 - y / (1 - y) + d * power / (1 - power), -1e-9)
    saddle = -np.log1p(-np.exp(np.clip(log_y, -300.0, -1e-9)))
    through = np.maximum(saddle, 4.0 / c)
    y = -np.expm1(-through)
    phi = 1 - y**d
    slope = (1 - y) * d * y ** (d - 1) / phi
    spread = np.sqrt(t * np.maximum(slope + (1 - y) ** 2 * d * (1 - d) * y ** (d - 2) / phi - slope**2, 1e-12))
    far = np.where(saddle * c >= 4, 4 / (through * spread), np.sqrt(40 / (c * through)))
    circle = (2 * through * far > np.pi)[:, None]
    far, through = np.minimum(far, np.pi / (2 * through))[:, None], through[:, None]
    u = (np.arange(NODES) + 0.5) / NODES
    s = np.where(circle, through + 1j * np.pi * u, through * (1 + 1j * far * u) ** 2)
    step = np.where(circle, 1.0, 2 * through * far * (1 + 1j * far * u) / np.pi) / NODES
    log_phi = np.log(1 - (-np.expm1(-s)) ** d) - np.log(phi)[:, None]
    total = (np.exp(c[:, None] * (s - through) + t[:, None] * log_phi) * step).real.sum(1)
    return np.log(np.maximum(total, 1e-300)) + c * through[:, 0] + t * np.log(phi)


def _flat(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All whole numbers from ``first`` to ``last`` of each row, one after the other: starts of the rows, row and value of each."""
    sizes = last - first + 1
    start = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(first)), sizes)
    return start, row, np.arange(len(row)) - (start - first)[row]


def _picked(log_p: np.ndarray, start: np.ndarray, row: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Place of the entry of each row where its running probability passes ``share`` of the row's."""
    p = np.exp(log_p - np.maximum.reduceat(log_p, start)[row])
    through = np.cumsum(p)
    before = through[start] - p[start]
    ends = np.append(start[1:], len(row)) - 1
    return np.clip(np.searchsorted(through, before + share * (through[ends] - before), side="right"), start, ends)


def _interpolated(c: np.ndarray, first: np.ndarray, last: np.ndarray, log_y: np.ndarray, row: np.ndarray, value: np.ndarray, d: float) -> np.ndarray:
    """``log_sums`` of every value of every row, by a polynomial through Chebyshev points: less log t, it is smooth down to t = 0."""
    points = -np.cos(np.pi * np.arange(POINTS) / (POINTS - 1))
    middle, half = (first + last) / 2, np.maximum(last - first, 1) / 2
    t = middle[:, None] + half[:, None] * points
    known = log_sums(np.repeat(c, POINTS), t.ravel(), np.repeat(log_y, POINTS), d).reshape(t.shape) - np.log(t)
    terms = np.linalg.solve(np.vander(points, POINTS), known.T)
    x = (value - middle[row]) / half[row]
    out = terms[0][row]
    for term in terms[1:]:
        out *= x
        out += term[row]
    return out + np.log(value)


def tables_of(customers: np.ndarray, new: np.ndarray, share: np.ndarray, d: float) -> np.ndarray:
    """A draw of the number of tables of each dish when all its customers are seated: the weight of t tables is new ** t times the
    generalised Stirling number of customers and t. ``share``, uniform, picks from the running sum of the law.
    """
    out = np.minimum(customers, 1)
    at, log_weight = log_arrangements(d)
    few = np.flatnonzero((customers > 1) & (customers <= FEW))
    for own in np.split(few[np.argsort(customers[few], kind="stable")], np.cumsum(np.bincount(customers[few], minlength=FEW + 1))[:-1]):
        if len(own):
            c = int(customers[own[0]])
            through = np.exp(log_weight[at[c] + 1 : at[c] + c + 1])[:, None] * new[own] ** np.arange(c)[:, None]
            np.cumsum(through, axis=0, out=through)
            out[own] = 1 + (through[:-1] <= share[own] * through[-1]).sum(0)
    for least, most in ((FEW, TABLED), (TABLED, np.inf)):
        some = np.flatnonzero((customers > least) & (customers <= most))
        log_y, mean, variance = tilted(customers[some], new[some], d)
        reach = WIDTHS * np.sqrt(variance + 1)
        first, last = (np.clip(x, 1, customers[some]).astype(np.int64) for x in (mean - reach - BELOW, mean + reach + ABOVE))
        cuts = np.flatnonzero(np.diff(np.cumsum(last - first + 1) // SUMMED_TOGETHER)) + 1
        for own in np.split(np.arange(len(some)), cuts) if len(some) else ():
            c, w = customers[some[own]], new[some[own]]
            start, row, t = _flat(first[own], last[own])
            if most == TABLED:
                log_p = log_weight[at[c][row] + t] + t * np.log(w)[row]
            else:
                log_p = t * np.log(w / d)[row] - log_factorial(t)
                # Where many sit alone, integrals are taken at whole numbers, each on its own.
                alone = last[own] > 0.6 * c
                each, rest = np.flatnonzero(alone[row]), np.flatnonzero(~alone)
                for i in (each[k : k + INTEGRATED_TOGETHER] for k in range(0, len(each), INTEGRATED_TOGETHER)):
                    log_p[i] += log_sums(c[row[i]], t[i], log_y[own][row[i]], d)
                for i in (rest[k : k + INTEGRATED_TOGETHER // POINTS] for k in range(0, len(rest), INTEGRATED_TOGETHER // POINTS)):
                    begin, r, v = _flat(first[own][i], last[own][i])
                    log_p[(start[i] - begin)[r] + np.arange(len(r))] += _interpolated(c[i], first[own][i], last[own][i], log_y[own][i], r, v, d)
            out[some[own]] = t[_picked(log_p, start, row, share[some[own]])]
    return out


class Level:
    """Customers and tables of all dishes of one level. How many sit at each table is not kept, as nothing depends on it."""

    def __init__(self, seed: np.ndarray, customers: np.ndarray, *_: object) -> None:
        """One table for each dish with customers, until they are moved. Further arguments, once room for tables, count for nothing."""
        self.seed, self.draws = seed, 0
        self.customers, self.tables = customers.copy(), np.minimum(customers, 1)

    @property
    def live(self) -> np.ndarray:
        """Dishes with two or more customers; the others have nothing to sample."""
        return np.flatnonzero(self.customers > 1)

    @property
    def room(self) -> np.ndarray:
        return self.tables

    @property
    def sizes(self) -> np.ndarray:
        """Customers at each table of the live dishes in one of the seatings with these numbers: all that may sit at the first."""
        t = self.tables[self.live]
        out = np.ones(int(t.sum()), np.int64)
        out[np.cumsum(t) - t] = self.customers[self.live] - t + 1
        return out

    def uniform(self, at: np.ndarray) -> np.ndarray:
        """The next random number of each dish in ``at``, a function of its seed and of how many were drawn before."""
        self.draws += 1
        return (mixed(self.seed[at] + np.uint64(self.draws * 0xD1342543DE82EF95 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53

    def move(self, new: np.ndarray, discount: float, moves: int = 1) -> None:
        """``moves`` times, all customers of each dish get up and sit down again, given the weights ``new`` of new tables."""
        at = self.live
        self.tables = np.minimum(self.customers, 1)
        for _ in range(moves if len(at) else 0):
            self.tables[at] = tables_of(self.customers[at], new[at], self.uniform(at), discount)

    def become(self, customers: np.ndarray, new: np.ndarray, discount: float) -> None:
        """Take the tables of the restaurants below for customers and seat them all."""
        self.customers = customers
        self.move(new, discount)


class Words:
    """All restaurants' dishes of a batch of words. ``word`` numbers the words, rising; ``context`` rises within a word."""

    def __init__(self, model: Model, seed: np.ndarray, word: np.ndarray, context: np.ndarray, customers: np.ndarray) -> None:
        self.model, self.context, self.word = model, context, word
        self.ending = context & 255
        at_ending = word * 256 + self.ending
        endings, self.up = np.unique(at_ending, return_inverse=True)
        self.ending_word, self.ending_at = endings >> 8, endings & 255
        s = mixed(seed + np.uint64(model.sampler.seed))
        self.seeds = (mixed(s + np.uint64(1 << 21)), mixed(s[self.ending_word] + np.uint64(1 << 20) + self.ending_at.astype(np.uint64)), mixed(s[word] + context.astype(np.uint64)))
        self.n_words, self.customers = len(seed), customers

    def predictive(self, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of each word in the root, in each ending's and in each context's restaurant."""
        m, d = self.model, self.model.discount
        (c0, t0), (c1, t1), (c2, t2) = ((x.customers, x.tables) for x in (self.top, self.mid, self.low))
        weight, size = m.share(0, totals, np.zeros(1, np.int64))
        top = (c0 - d * t0 + weight / (m.vocabulary + 1)) / size
        weight, size = m.share(1, totals, self.ending_at)
        mid = (c1 - d * t1 + weight * top[self.ending_word]) / size
        weight, size = m.share(2, totals, self.context)
        return top, mid, (c2 - d * t2 + weight * mid[self.up]) / size

    def _new(self, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of new tables: of each level, the restaurant's share times the word's probability in its parent."""
        top, mid, _ = self.predictive(totals)
        m = self.model
        root = m.share(0, totals, np.zeros(1, np.int64))[0]
        return np.repeat(root / (m.vocabulary + 1), self.n_words), m.share(1, totals, self.ending_at)[0] * top[self.ending_word], m.share(2, totals, self.context)[0] * mid[self.up]

    def _to_endings(self, of_contexts: np.ndarray) -> np.ndarray:
        return np.bincount(self.up, of_contexts, len(self.ending_at)).astype(np.int64)

    def _to_root(self, of_endings: np.ndarray) -> np.ndarray:
        return np.bincount(self.ending_word, of_endings, self.n_words).astype(np.int64)

    def start(self, _totals: Totals) -> None:
        """Before the first sweep every dish has one table."""
        self.low = Level(self.seeds[2], self.customers)
        self.mid = Level(self.seeds[1], self._to_endings(self.low.tables))
        self.top = Level(self.seeds[0], self._to_root(self.mid.tables))

    def sweep(self, totals: Totals) -> None:
        """One Gibbs sweep over all levels, from the contexts up."""
        d = self.model.discount
        top, mid, low = self._new(totals)
        self.low.move(low, d)
        self.mid.become(self._to_endings(self.low.tables), mid, d)
        self.top.become(self._to_root(self.mid.tables), top, d)

    def table_counts(self) -> np.ndarray:
        """Tables of these words in every restaurant."""
        out = np.zeros(CONTEXTS + 257, np.int64)
        out[:CONTEXTS] = np.bincount(self.context, self.low.tables, CONTEXTS)
        out[CONTEXTS : CONTEXTS + 256] = np.bincount(self.ending_at, self.mid.tables, 256)
        out[-1] = self.top.tables.sum()
        return out


class Followers(Words):
    """The same with the restaurants of whole words below. A pair with one customer has one table and nothing to sample, so each dish of
    an ending has a number of them (``singles``); the others are ``pairs``: their ``dish``, the number of the word ``before``, customers."""

    def __init__(self, model: Model, seed: np.ndarray, word: np.ndarray, context: np.ndarray, singles: np.ndarray, dish: np.ndarray, before: np.ndarray, customers: np.ndarray) -> None:
        super().__init__(model, seed, word, context, singles + np.bincount(dish, minlength=len(word)))
        s = mixed(seed + np.uint64(model.sampler.seed))
        self.singles, self.dish, self.before, self.of_pairs = singles, dish, before, customers
        self.pair_seed = mixed(s[word[dish]] + mixed(before.astype(np.uint64) + np.uint64(1 << 62)))

    def start(self, totals: Totals) -> None:
        super().start(totals)
        self.pairs = Level(self.pair_seed, self.of_pairs)

    def _from_pairs(self) -> np.ndarray:
        return self.singles + np.bincount(self.dish, self.pairs.tables, len(self.word)).astype(np.int64)

    def tables(self) -> tuple[np.ndarray, ...]:
        return self.pairs.tables, self.low.tables, self.mid.tables, self.top.tables

    def resume(self, sweeps: int, tables: list[np.ndarray]) -> None:
        """The seats after so many sweeps, from what ``tables`` gave then."""
        self.pairs = Level(self.pair_seed, self.of_pairs)
        self.pairs.tables = tables[0]
        self.low = Level(self.seeds[2], self._from_pairs())
        self.low.tables = tables[1]
        self.mid = Level(self.seeds[1], self._to_endings(tables[1]))
        self.mid.tables = tables[2]
        self.top = Level(self.seeds[0], self._to_root(tables[2]))
        self.top.tables = tables[3]
        for level in (self.pairs, self.low, self.mid, self.top):
            level.draws = sweeps

    def sweep_with(self, totals: Totals, tables_before: np.ndarray) -> None:
        """One Gibbs sweep over all levels, from the whole words up. ``tables_before``: all tables in the restaurant of each pair."""
        m = self.model
        top, mid, low = self._new(totals)
        own = (m.sampler.strength + m.word_discount * tables_before) * self.predictive(totals)[2][self.dish]
        self.pairs.move(own, m.word_discount)
        self.low.become(self._from_pairs(), low, m.discount)
        self.mid.become(self._to_endings(self.low.tables), mid, m.discount)
        self.top.become(self._to_root(self.mid.tables), top, m.discount)

    def totals(self) -> np.ndarray:
        """Customers of all contexts and tables in every restaurant above the whole words'."""
        return np.append(np.bincount(self.context, self.low.customers, CONTEXTS).astype(np.int64), self.table_counts())


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed bytes, low bytes first; each has as many as the largest needs."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    wide = np.ascontiguousarray(numbers, "<u8") if width > 4 else np.ascontiguousarray(numbers, "<u4")
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(wide.view(np.uint8).reshape(-1, wide.itemsize)[:, :width].T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def bundle(*lists: np.ndarray) -> bytes:
    """Several lists of numbers as one string."""
    parts = [packed(np.asarray(x)) for x in lists]
    return struct.pack(f"<{len(parts) + 1}I", len(parts), *map(len, parts)) + b"".join(parts)


def unbundled(data: bytes, most: int | None = None) -> list[np.ndarray]:
    """The lists of a bundle, ``most`` of them at most."""
    n = struct.unpack_from("<I", data)[0]
    ends = np.cumsum((4 * n + 4, *struct.unpack_from(f"<{n}I", data, 4)))
    return [unpacked(data[i:j]) for i, j in zip(ends, ends[1:][:most])]


def letters(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    """Receiver, kind, sender and body of each."""
    return batch_of(LETTER, **{f.name: [r[i] for r in rows] for i, f in enumerate(LETTER)})


def opened(table: pa.Table, kind: int, most: int | None = None) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sender and lists of each letter of a kind, by sender; ``most`` lists at most."""
    own = table.filter(pc.equal(table.column("kind"), kind)).sort_by("sender")
    for sender, body in zip(own.column("sender"), own.column("body")):
        yield sender.as_py(), unbundled(body.as_py(), most)


def handled(mail: DataFrame, answer: Callable[[int, pa.Table], list[tuple[int, int, int, bytes]]]) -> DataFrame:
    """The letters that each receiver of ``mail`` writes."""
    return mail.groupBy("receiver").applyInArrow(lambda t: pa.Table.from_batches([letters(answer(t.column("receiver")[0].as_py(), t))]), LETTER_DDL)


def summed(mail: DataFrame, size: int) -> np.ndarray:
    """The sum of the lists of all TOTAL letters, added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for body in b.column("body"):
                total += unbundled(body.as_py())[0]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    found = mail.where(F.col("kind") == TOTAL).select("body").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out


def steps(rising: np.ndarray) -> np.ndarray:
    """The first of some rising numbers and the differences that follow, small where they lie close."""
    return np.diff(rising, prepend=0)


def lowered(texts: pa.Array) -> pa.Array:
    """The texts with A-Z lower-cased, NULL as the empty text; an array of its own, not a slice."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = UPPER_TO_LOWER[np.frombuffer(filled.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
    return pa.Array.from_buffers(pa.large_string(), len(filled), [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(data.tobytes())])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words of some texts, number of the word of each token, tokens of each text: its words and the end."""
    # An end mark after each text's words: the only empty string that is kept.
    lists = pc.ascii_split_whitespace(lowered(texts))
    coded = lists.flatten().dictionary_encode()
    words, flat = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    end = pc.index(words, END).as_py()
    kept = flat != end
    row = np.repeat(np.arange(len(sizes)), sizes)[kept]
    if end < 0:
        end, words = len(words), pa.concat_arrays([words, pa.array([END])])
    own = np.bincount(row, minlength=len(sizes)) + 1
    out = np.full(int(own.sum()), end, np.int32)
    out[np.arange(len(row)) + row] = flat[kept]
    return words, out, own


def last_bytes(words: pa.Array) -> np.ndarray:
    """The last two bytes of each word as a number, the one byte of a short word, 0 for the end."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8).astype(np.int32)
    data, sizes = np.append(data, [0, 0]), np.diff(ends)
    return np.where(sizes > 0, data[ends[1:] - 1], 0) + 256 * np.where(sizes > 1, data[ends[1:] - 2], 0)


def numbered(code: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values of ``code``, rising, and the place of each entry's value among them; all are below ``limit``."""
    bits = len(code).bit_length()
    if limit.bit_length() + bits < 63:  # value and place in one number, as sorting numbers is faster than sorting places
        code <<= bits
        code |= np.arange(len(code))
        code.sort()
        order = (code & ((1 << bits) - 1)).astype(np.int32 if bits < 32 else np.int64)
        code >>= bits
    else:
        order = np.argsort(code)
        code = code[order]
    new = np.append(True, code[1:] != code[:-1])
    place, out = np.cumsum(new, dtype=np.int32), np.empty(len(new), np.int32)
    place -= 1
    out[order] = place
    return code[new], out


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: the sum of a hash of each byte and its place."""
    out = np.empty(len(words), np.uint64)
    for at in range(0, len(words), 1 << 16):
        some = words.slice(at, 1 << 16)
        ends = np.frombuffer(some.buffers()[1], np.int32)[some.offset : some.offset + len(some) + 1].astype(np.int64)
        data = np.frombuffer(some.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends -= ends[0]
        place = np.arange(len(data)) - np.repeat(ends[:-1], np.diff(ends))
        through = np.append(np.zeros(1, np.uint64), np.cumsum(mixed((place * 256 + data).astype(np.uint64)), dtype=np.uint64))
        out[at : at + len(some)] = mixed(through[ends[1:]] - through[ends[:-1]])
    return out


def spelled(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    """Words from their lengths and bytes."""
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.astype(np.uint8).tobytes())])


def tokenised(docs: DataFrame, training: Column, key: str, text: str, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Letters of each block. To itself: bucket and last bytes of its words, numbered by falling frequency (HEAD), and for some texts each
    whether there is a key, keys, training, tokens of each, numbers of all tokens (TEXT). To each bucket: the occurrences of each
    of its words in training texts, lengths, bytes (WORDS)."""

    def finish(number: int, texts: list[tuple], index: dict) -> Iterator[pa.RecordBatch]:
        words = pa.array(index, pa.string())
        index.clear()
        every, n = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for _, _, learned, sizes, own in texts:
            every += np.bincount(own, minlength=len(words))
            n += np.bincount(own[np.repeat(learned, sizes)], minlength=len(words))
        order = np.argsort(-every, kind="stable")
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        words, n = words.take(pa.array(order)), n[order]
        bucket = (hashes(words) % np.uint64(buckets)).astype(np.int64)
        yield letters([(number, HEAD, number, bundle(bucket, last_bytes(words)))])
        while texts:
            *rest, own = texts.pop()
            yield letters([(number, TEXT, number, bundle(*rest, place[own]))])
        by = np.argsort(bucket, kind="stable")
        ends, words, n = np.searchsorted(bucket[by], np.arange(buckets + 1)), words.take(pa.array(by)), n[by]
        at = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        full = np.flatnonzero(np.diff(ends))
        for some in np.split(full, range(256, len(full), 256)):
            yield letters([(b, WORDS, number, bundle(n[i:j], np.diff(at[i : j + 1]), data[at[i] : at[j]])) for b, i, j in zip(some.tolist(), ends[some].tolist(), ends[some + 1].tolist())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The table is written once, so the numbers of blocks need only be different: random ones are.
        numbers = np.random.default_rng()
        texts, held = [], 0
        index: dict = defaultdict(count().__next__)
        for b in slices(batches, "text", min(SLICE_BYTES, block_bytes)):
            size = pc.sum(pc.binary_length(b.column("text"))).as_py() or 0
            if texts and held + size > block_bytes:
                yield from finish(int(numbers.integers(1 << 62)), texts, index)
                texts, held, index = [], 0, defaultdict(count().__next__)
            words, flat, tokens = split_words(b.column("text"))
            own = np.fromiter(map(index.__getitem__, words.to_numpy(zero_copy_only=False)), np.int32, len(words))[flat]
            keys = b.column("key")
            texts.append((keys.is_valid().to_numpy(zero_copy_only=False), keys.fill_null(0).to_numpy().view(np.uint64), b.column("training").to_numpy(zero_copy_only=False).astype(bool), tokens, own))
            held += size
        if texts:
            yield from finish(int(numbers.integers(1 << 62)), texts, index)

    narrow = docs.select(docs[key].cast("long").alias("key"), F.coalesce(training, F.lit(False)).alias("training"), docs[text].cast("string").alias("text"))
    return narrow.mapInArrow(run, LETTER_DDL)


def ranked(bucket: int, mail: pa.Table) -> list[tuple[int, int, int, bytes]]:
    """A bucket numbers its words by falling occurrences in training texts. It tells each block ranks and occurrences of its words, in the
    block's order, and the totals: words and tokens."""
    asks = list(opened(mail, WORDS))
    coded = pa.concat_arrays([spelled(sizes, data) for _, (_, sizes, data) in asks]).dictionary_encode()
    words, at = coded.dictionary, coded.indices.to_numpy()
    n = np.bincount(at, np.concatenate([x[0] for _, x in asks]), len(words)).astype(np.int64)
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((hashes(words), -n))] = np.arange(len(words))
    ends = np.cumsum([0, *(len(x[0]) for _, x in asks)])
    rows = [(block, RANK, bucket, bundle(rank[at[i:j]], n[at[i:j]])) for (block, _), i, j in zip(asks, ends, ends[1:])]
    return [*rows, (bucket, TOTAL, bucket, bundle(np.array([(n > 0).sum(), n.sum()])))]


class Block:
    """A block of texts and its different (word, word before), in the order of buckets, ranks, last bytes and numbers of the word before.

    The number of a word is its rank in its bucket times the buckets, and its bucket.
    """

    def __init__(self, own: pa.Table, mail: pa.Table, buckets: int) -> None:
        pa.default_memory_pool().release_unused()
        ((number, (bucket, ending)),) = opened(own, HEAD)
        self.number, self.buckets, self.bucket, self.texts, tokens = number, buckets, bucket, [], []
        for _, (*rest, flat) in opened(own, TEXT):
            self.texts.append(rest)
            tokens.append(flat.astype(np.int32))
        self.by_bucket = np.argsort(bucket, kind="stable")
        rank, self.seen = (np.empty(len(bucket), np.int64) for _ in range(2))
        rank[self.by_bucket], self.seen[self.by_bucket] = (np.concatenate(x) for x in zip(*(x for _, x in opened(mail, RANK))))
        self.id = rank * buckets + bucket
        self.words, self.contexts = np.lexsort((rank, bucket)), np.lexsort((self.id, ending))
        self.rank, self.ending = rank[self.words], ending[self.contexts]
        word_at, context_at, n = np.empty(len(rank), np.int32), np.empty(len(rank), np.int32), len(rank)
        word_at[self.words] = context_at[self.contexts] = np.arange(n, dtype=np.int32)
        del rank, ending, bucket
        self.tokens = tokens = np.concatenate(tokens)
        code = word_at[tokens].astype(np.int64)
        code *= n
        code[1:] += context_at[tokens[:-1]]
        code[0] += context_at[tokens[-1]]  # each text ends with END, which comes before the next one's first word
        del word_at, context_at, tokens
        codes, self.pairs = numbered(code, n**2)
        del code
        self.word, self.context = (codes // n).astype(np.int32), (codes % n).astype(np.int32)
        del codes
        # First pair of each dish (word, last bytes of the word before), first dish of each word.
        last = self.ending[self.context]
        self.dish = np.flatnonzero(np.append(True, (self.word[1:] != self.word[:-1]) | (last[1:] != last[:-1])))
        self.last = last[self.dish]

    def asks(self) -> Iterator[pa.RecordBatch]:
        """To each bucket: the highest number of a word before, steps of the ranks of its words, dishes of each, last bytes and pairs of each dish, of each pair the number of the word before and occurrences in training texts."""
        n, at = np.zeros(len(self.word), np.int32), 0
        for _, _, learned, sizes in self.texts:
            own = self.pairs[at : at + int(sizes.sum())]
            at += len(own)
            n += np.bincount(own[np.repeat(learned.astype(bool), sizes)], minlength=len(n)).astype(np.int32)
        del self.pairs, self.tokens, own  # the asks are all that is wanted of this block
        word = np.searchsorted(self.word[self.dish], np.arange(len(self.rank) + 1))  # first dish of each word
        ends = np.searchsorted(self.bucket[self.words], np.arange(self.buckets + 1))
        dish = np.append(self.dish, len(self.word))
        full = np.flatnonzero(np.diff(ends))
        for some in np.split(full, range(64, len(full), 64)):
            rows = []
            for b, i, j in zip(some.tolist(), ends[some].tolist(), ends[some + 1].tolist()):
                k, m = word[i], word[j]
                p, q = dish[k], dish[m]
                before = self.id[self.contexts[self.context[p:q]]]
                rows.append((b, ASK, self.number, bundle(before.max(keepdims=True), steps(self.rank[i:j]), np.diff(word[i : j + 1]), self.last[k:m], np.diff(dish[k : m + 1]), before, n[p:q])))
            yield letters(rows)


class Bucket:
    """All pairs that blocks ask a bucket for, each once by word and word before, with their customers, contexts and dishes.

    Asks are read one after the other, as those for a very common word are many times its different pairs.
    """

    def __init__(self, mail: pa.Table) -> None:
        pa.default_memory_pool().release_unused()
        self.mail, self.numbers = mail, 1 + max(int(x[0]) for _, (x,) in opened(mail, ASK, 1))
        self.code, self.context, self.customers = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        held, size = [], 0
        for _, code, context, n, _ in self.asks():
            held.append((code, context.astype(np.int32), n))
            size += len(n)
            if size > max(MERGED_TOGETHER, len(self.code)):
                self._add(held)
                size = 0
        self._add(held)
        self.before = self.code % self.numbers
        code = self.code // self.numbers * CONTEXTS + self.context
        codes, self.dish = numbered(code, int(code.max()) + 1)
        self.word, self.dish_context = np.divmod(codes, CONTEXTS)
        # Pairs with several customers, by dish.
        live = np.flatnonzero(self.customers > 1)
        self.live = live[np.argsort(self.dish[live], kind="stable")]

    def asks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Block, pairs, their contexts and customers, and the first pair of each dish of every ask."""
        for block, (_, rank, per_word, last, per_dish, before, n) in opened(self.mail, ASK):
            yield block, np.repeat(np.repeat(np.cumsum(rank), per_word), per_dish) * self.numbers + before, np.repeat(last, per_dish), n, np.cumsum(per_dish) - per_dish

    def _add(self, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        code, context, n = (np.concatenate((x, *y)) for x, y in zip((self.code, self.context, self.customers), zip(*held) if held else ((),) * 3))
        held.clear()
        limit = int(code.max()) + 1
        self.code, at = numbered(code, limit)
        self.customers = np.bincount(at, n, len(self.code)).astype(np.int64)
        self.context = np.empty(len(self.code), np.int32)
        self.context[at] = context


def by_owner(before: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words in ``before`` by bucket and rank: bucket, rank, and the place of each entry's word among them."""
    most = int(before.max(initial=0)) // buckets + 1
    if not len(before):
        return before, before, before
    codes, at = numbered(before % buckets * most + before // buckets, buckets * most)
    return *np.divmod(codes, most), at


def to_owners(kind: int, bucket: int, owner: np.ndarray, rank: np.ndarray, *lists: np.ndarray) -> list[tuple[int, int, int, bytes]]:
    """A letter to each bucket that owns some of the words: steps of their ranks and what else is said of each."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
    return [(int(owner[i]), kind, bucket, bundle(steps(rank[i:j]), *(x[i:j] for x in lists))) for i, j in zip(first, np.append(first[1:], len(owner)))]


def begun(buckets: int) -> Callable[[int, pa.Table], list[tuple[int, int, int, bytes]]]:
    """A bucket's letters before the first sweep, and as totals those of one table for each dish with how many pairs and dishes have one customer or two."""

    def answer(bucket: int, mail: pa.Table) -> list[tuple[int, int, int, bytes]]:
        b = Bucket(mail)
        live, some, dishes = b.customers > 1, b.customers > 0, len(b.word)
        per_dish = np.bincount(b.dish[live], minlength=dishes)
        singles = np.bincount(b.dish[b.customers == 1], minlength=dishes)
        body = bundle(np.bincount(b.word), b.dish_context, singles, per_dish, b.before[b.live], b.customers[b.live])
        owner, rank, at = by_owner(b.before[some], buckets)
        rows = to_owners(FIRST, bucket, owner, rank, np.bincount(at, minlength=len(owner)), np.bincount(at, live[some], len(owner)) > 0)
        few = [(b.customers == k).sum() for k in (1, 2)]
        del b, live, some, at
        seats = seated(Model(Sampler(), 0.5, 0, 0), bucket, buckets, unbundled(body))
        seats.start(None)
        few += [(seats.customers == k).sum() for k in (1, 2)]
        return [(bucket, LIVE, bucket, body), (bucket, TOTAL, bucket, bundle(np.concatenate((seats.totals(), few)))), *rows]

    return answer


def seated(model: Model, bucket: int, buckets: int, live: list[np.ndarray]) -> Followers:
    """The seats of a bucket's words, not yet taken."""
    per_word, context, singles, per_dish, before, customers = live
    seed = mixed((np.arange(len(per_word)) * buckets + bucket).astype(np.uint64))
    return Followers(model, seed, np.repeat(np.arange(len(per_word)), per_word), context, singles, np.repeat(np.arange(len(context)), per_dish), before, customers)


def swept(model: Model, buckets: int) -> Callable[[int, pa.Table], list[tuple[int, int, int, bytes]]]:
    """A bucket's seats after one more sweep, their totals, and to the owners of the words before the tables beyond one for each pair."""
    done = len(model.history) - 1

    def answer(bucket: int, mail: pa.Table) -> list[tuple[int, int, int, bytes]]:
        ((_, live),) = opened(mail, LIVE)
        seats = seated(model, bucket, buckets, live)
        for _, tables in opened(mail, STATE):
            seats.resume(done, tables)
        if not done:
            seats.start(model.history[0])
        owner, rank, at = by_owner(seats.before, buckets)
        tables = np.concatenate([np.zeros(0, np.int64), *(x[0] for _, x in opened(mail, REPLY))])
        seats.sweep_with(model.history[-1], tables[at])
        further = np.bincount(at, seats.pairs.tables - 1, len(owner)).astype(np.int64)
        return [(bucket, STATE, done + 1, bundle(*seats.tables())), (bucket, TOTAL, bucket, bundle(seats.totals())), *to_owners(EXTRA, bucket, owner, rank, further)]

    return answer


def tabled(bucket: int, mail: pa.Table) -> list[tuple[int, int, int, bytes]]:
    """Tables in the restaurant of each word of a bucket, by rank, and to each bucket that sent letters those it samples with."""
    heard = [(sender, np.cumsum(x[0]), x[1], x[2].astype(bool) if len(x) > 2 else np.ones(len(x[0]), bool)) for kind in (FIRST, EXTRA) for sender, x in opened(mail, kind)]
    tables = np.zeros(max((int(rank[-1]) + 1 for _, rank, _, _ in heard), default=0), np.int64)
    for _, (before,) in opened(mail, SEATED):
        tables = np.append(before, tables[len(before) :])
    for _, rank, n, _ in heard:
        tables[rank] += n
    return [(bucket, SEATED, bucket, bundle(tables)), *((sender, REPLY, bucket, bundle(tables[rank[asked]])) for sender, rank, _, asked in heard if asked.any())]


def fit(started: DataFrame, sampler: Sampler, vocabulary: int, tokens: int, buckets: int) -> tuple[Model, list[DataFrame], list[DataFrame]]:
    """Model, seats (STATE) and tables of whole words' restaurants (SEATED) after each sweep."""
    size = 2 * CONTEXTS + 257
    total = summed(started, size + 4)
    once, twice = total[size::2].tolist(), total[size + 1 :: 2].tolist()
    word_discount, discount = (min(0.95, max(0.05, a / max(1, a + 2 * b))) for a, b in zip(once, twice))
    model = Model(sampler, discount, vocabulary, tokens, [Totals(total[:CONTEXTS], total[CONTEXTS:size])], word_discount)
    of = lambda mail, kind: mail.where(F.col("kind") == kind)
    first = tables = materialize(handled(of(started, FIRST), tabled), "first_tables", compression="uncompressed")
    live, seats, seatings = of(started, LIVE), None, []
    for _ in range(sampler.sweeps):
        mail = live.union(of(tables, REPLY))
        after = materialize(handled(mail if seats is None else mail.union(of(seats, STATE)), swept(model, buckets)), "seats", compression="uncompressed")
        total = summed(after, size)
        model.history.append(Totals(total[:CONTEXTS], total[CONTEXTS:]))
        tables = materialize(handled(of(after, EXTRA).union(of(first, SEATED)), tabled), "tables", compression="uncompressed")
        seats = after
        seatings.append((of(after, STATE), of(tables, SEATED)))
    return model, [x for x, _ in seatings], [x for _, x in seatings]


def answered(model: Model, buckets: int) -> Callable[[int, pa.Table], list[tuple[int, int, int, bytes]]]:
    """To each block: customers of each pair it asked for and their tables in all samples together, and of each sample the probability
    in the restaurant of each dish's last bytes, as 4-byte floats."""

    def answer(bucket: int, mail: pa.Table) -> list[tuple[int, int, int, bytes]]:
        b = Bucket(mail)
        del b.before, b.context
        ((_, live),) = opened(mail, LIVE)
        seats = seated(model, bucket, buckets, live)
        states = list(opened(mail, STATE))
        tables, p = np.where(b.customers == 1, len(states), 0), []
        for sweeps, state in states:
            seats.resume(sweeps, state)
            tables[b.live] += state[0]
            p.append(seats.predictive(model.history[sweeps])[2].astype("<f4").view("<u4"))
        rows = []
        for block, code, _, _, first in b.asks():
            pair = np.searchsorted(b.code, code)
            dish = b.dish[pair[first]]
            rows.append((block, ANSWER, bucket, bundle(b.customers[pair], tables[pair], *(x[dish] for x in p))))
        return rows

    return answer


def told(samples: int) -> Callable[[int, pa.Table], list[tuple[int, int, int, bytes]]]:
    """To each block the tables in the restaurants of its words, after each of some sweeps."""

    def answer(bucket: int, mail: pa.Table) -> list[tuple[int, int, int, bytes]]:
        # A bucket none of whose words comes before another has no tables; of those that no word follows there are none at the end.
        every = [np.append(x[0], 0) for _, x in opened(mail, SEATED)] or [np.zeros(1, np.int64)] * samples
        return [(block, TABLES, bucket, bundle(*(t[np.minimum(rank, len(t) - 1)] for t in every))) for block, (rank, _) in opened(mail, RANK)]

    return answer


def score_documents(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", sampler: Sampler = Sampler(), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, training, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased, and an end after the last. ``n_known`` counts tokens that occur in rows
    where ``training`` holds; ``base_score`` is their smoothed unigram log10 probability, ``score`` the model's, ``perplexity`` 10 to
    the power of -score over tokens. NULL and empty texts are the end alone. Rows with a NULL key stay, repeated rows stay repeated
    and are learned from as often. Without training rows both scores are those of the uniform distribution over one unseen word. An
    empty table gives an empty result; only the key, the text and what ``training`` names are read. Texts are read whole.
    """
    if sampler.burn_in >= sampler.sweeps:
        raise ValueError("burn_in must leave a sweep to average")
    buckets = max(LEAST_BUCKETS, (docs.agg(F.sum(F.octet_length(docs[text].cast("string")))).first()[0] or 0) // BUCKET_BYTES)
    blocks = materialize(tokenised(docs, training, key, text, buckets, block_bytes), "token_blocks", compression="uncompressed")
    of = lambda mail, *kinds: mail.where(F.col("kind").isin(*kinds))
    numbers = materialize(handled(of(blocks, WORDS), ranked), "word_numbers", compression="uncompressed")
    vocabulary, tokens = summed(numbers, 2).tolist()
    own, ranks = of(blocks, HEAD, TEXT).groupBy("receiver"), of(numbers, RANK)
    asks = own.cogroup(ranks.groupBy("receiver")).applyInArrow(lambda texts, mail: pa.Table.from_batches(Block(texts, mail, buckets).asks(), LETTER), LETTER_DDL)
    started = materialize(handled(asks, begun(buckets)), "pairs", compression="uncompressed")
    model, seats, tables = fit(started, sampler, vocabulary, tokens, buckets)
    kept = slice(sampler.burn_in, None)
    answers, to_blocks = of(asks, ASK).union(of(started, LIVE)), ranks.select(F.col("sender").alias("receiver"), "kind", F.col("receiver").alias("sender"), "body")
    for x in seats[kept]:
        answers = answers.union(x)
    for k, x in enumerate(tables[kept]):
        to_blocks = to_blocks.union(x.withColumn("sender", F.lit(k).cast("long")))
    mail = ranks.union(handled(answers, answered(model, buckets))).union(handled(to_blocks, told(len(tables[kept]))))
    schema = pa.schema([("key", pa.int64()), ("training", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())])
    strength, discount, whole = sampler.strength, model.word_discount, math.log10(tokens + vocabulary + 1)

    def scored(texts: pa.Table, mail: pa.Table) -> pa.Table:
        b = Block(texts, mail, buckets)
        kept, p = [], []
        for _, (customers, seats, *chances) in opened(mail, ANSWER):
            kept.append(customers - discount * seats / len(chances))
            p.append([x.astype("<u4").view("<f4") for x in chances])
        kept, p = np.concatenate(kept), [np.concatenate(x) for x in zip(*p)]
        per_dish = np.diff(np.append(b.dish, len(b.word)))
        logp = np.zeros(len(b.word))
        for chance, by_bucket in zip(p, zip(*(x for _, x in opened(mail, TABLES)))):
            tables = np.empty(len(b.id), np.int64)
            tables[b.by_bucket] = np.concatenate(by_bucket)
            new = np.repeat(chance.astype(np.float64), per_dish)
            new *= (strength + discount * tables[b.contexts])[b.context]
            logp += new
            del new
        logp /= len(p)
        logp += kept
        logp /= (strength + b.seen[b.contexts])[b.context]
        np.log10(logp, out=logp)
        base, out, done = np.log10(b.seen + 1.0) - whole, [], 0
        for valid, keys, learned, sizes in b.texts:
            end = done + int(sizes.sum())
            flat, at = b.tokens[done:end], np.cumsum(sizes) - sizes  # every text has its end, so no list is empty
            score = np.add.reduceat(logp[b.pairs[done:end]], at)
            known = np.add.reduceat((b.seen > 0)[flat].astype(np.int64), at)
            out.append(batch_of(schema, key=pa.array(keys.view(np.int64), mask=valid == 0), training=learned.astype(bool), n_tokens=sizes, n_known=known, train_tokens=np.full(len(at), tokens), base_score=np.add.reduceat(base[flat], at), score=score, perplexity=10.0 ** np.minimum(-score / sizes, 300)))
            done = end
        return pa.Table.from_batches(out, schema)

    rows = own.cogroup(mail.groupBy("receiver")).applyInArrow(scored, "key long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    return rows.withColumnRenamed("key", key)


def score_held_out(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2, sampler: Sampler = Sampler()) -> DataFrame:
    """``score_documents`` learned from all folds but one, with held_out in place of training."""
    found = score_documents(docs, fold(F.col(key), folds) != held, key, text, sampler)
    return found.withColumn("held_out", ~F.col("training")).drop("training")
