"""Near-duplicates by 64-bit SimHash fingerprints, found through Golay-code keys.

Fingerprint: words, overlapping shingles of three, a 64-bit hash each, majority per bit.
Two fingerprints link at two or fewer differing bits.

Keys: the 64 bits are three segments of 23, 23 and 18 bits, each read as a word of the
perfect binary Golay code of length 23. Two linked fingerprints have an equal segment
(pigeonhole: two errors over three segments), and the segment after it differs in at most two
bits. The codewords nearest to all words within one flip of a segment are its keys (six
at most); words at distance two share the word between them and so a key. Thus (which
segment, its exact value, one Golay index of the next) is a key that every linked pair shares.

Buckets of up to ``PAIR_BUCKET`` fingerprints are joined with themselves and verified.
Larger ones, which groups of many near copies fill, are split exactly: two words are
within two flips just if they share a word within one flip of both, so each
fingerprint is dealt to its 65 such words, and whatever meets there is linked to the least of
them without a pair being formed. Components come from alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from ..plans.sizing import materialize
from .common import batch_of, slices, texts_of

SHINGLE = 3
SEED = 42
MOST_BITS = 2
PAIR_BUCKET = 32
# The generator polynomial of the Golay code, and the places of the segments.
GOLAY_LENGTH, GOLAY_CHECK, GOLAY_POLYNOMIAL = 23, 11, 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))
UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BITS_OF_BYTE = np.array([[b >> i & 1 for i in range(8)] for b in range(256)], np.int64)


def fingerprint(text: str) -> int:
    """SimHash of one text: zero without words, one shingle of all words below three."""
    words = text.encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hashes = list(map(xxh64_intdigest, map(b" ".join, zip(words, words[1:], words[2:])), repeat(SEED)))
    lanes = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    set_bits = np.stack([np.bincount(lanes[:, k], minlength=256) @ BITS_OF_BYTE for k in range(8)]).ravel()
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp (the fingerprint as a signed long) of every whole text; NULL counts as empty."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = np.array([fingerprint(t) for t in texts_of(b.column("text"))], "<u8").view("<i8")
            yield batch_of(schema, key=b.column("key"), fp=fp)

    narrow = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    return narrow.mapInArrow(run, "key long, fp long").withColumnRenamed("key", key)


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: a row with the least key; ``keep_least`` says which rows without a key stay."""

    def signed(t: str) -> int:
        return int(np.uint64(fingerprint(t)).view(np.int64))

    return keep_least(docs, near_duplicates(docs, key, text), key, text, "fp", "long", signed)


def keep_least(docs: DataFrame, found: DataFrame, key: str, text: str, mark: str, kind: str, mark_of: Callable[[str], object]) -> DataFrame:
    """One row of ``docs`` for each component of ``found`` (key, ``mark``, component_id, root).

    Rows of one key are one document, of which one row stays. Rows without a key stay where their component has no
    other: one row with the component's least mark.
    """
    found = materialize(found, "components")
    keep = found.where(F.col(key) == F.col("component_id")).select(key).distinct()
    named = docs.join(keep, key, "left_semi").select(docs.columns).dropDuplicates([key])
    roots = found.where(F.col("component_id").isNull()).where(F.col(mark) == F.col("root")).select(F.col(mark).alias("mark")).distinct()
    columns = docs.columns
    unnamed = docs.where(F.col(key).isNull()).select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            marks = pa.array([mark_of(t) for t in texts_of(b.column("text"))], pa.string() if kind == "string" else pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("row"), marks], names=["row", "mark"])

    kinds = f"row {unnamed.schema['row'].dataType.simpleString()}, mark {kind}"
    return named.unionByName(unnamed.mapInArrow(run, kinds).join(roots, "mark", "left_semi").dropDuplicates(["mark"]).select("row.*"))


@cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each single bit, and the error pattern of each syndrome."""
    bit = np.zeros(GOLAY_LENGTH, np.int64)
    for i in range(GOLAY_LENGTH):
        r = 1 << i
        for top in range(GOLAY_LENGTH - 1, GOLAY_CHECK - 1, -1):
            if r >> top & 1:
                r ^= GOLAY_POLYNOMIAL << (top - GOLAY_CHECK)
        bit[i] = r
    errors = np.zeros(1 << GOLAY_CHECK, np.int64)
    n = GOLAY_LENGTH
    for i in range(n):
        errors[bit[i]] = 1 << i
        for j in range(i):
            errors[bit[i] ^ bit[j]] = 1 << i | 1 << j
            for k in range(j):
                errors[bit[i] ^ bit[j] ^ bit[k]] = 1 << i | 1 << j | 1 << k
    return bit, errors


def golay_keys(words: np.ndarray) -> np.ndarray:
    """Per 23-bit word, the indices of the codewords nearest to it and to its 23 neighbours (24 columns, with repeats)."""
    bit, errors = _golay()
    syndrome = np.zeros(len(words), np.int64)
    for i in range(GOLAY_LENGTH):
        syndrome ^= np.where(words >> i & 1, bit[i], 0)
    flips = np.concatenate(([0], 1 << np.arange(GOLAY_LENGTH)))
    codes = (words[:, None] ^ flips) ^ errors[syndrome[:, None] ^ np.concatenate(([0], bit))]
    return codes >> GOLAY_CHECK


def search_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every search key of the fingerprints (uint64)."""
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        code = np.sort(golay_keys(parts[(i + 1) % 3]), axis=1)
        fresh = np.ones(code.shape, bool)
        fresh[:, 1:] = code[:, 1:] != code[:, :-1]
        row, col = np.nonzero(fresh)
        rows.append(row)
        keys.append(i << 40 | parts[i][row] << 12 | code[row, col])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(distinct: DataFrame) -> DataFrame:
    """fp, key: every distinct fingerprint under each of its search keys."""
    schema = pa.schema([("fp", pa.int64()), ("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            row, key = search_keys(fp.view(np.uint64))
            yield batch_of(schema, fp=fp[row], key=key)

    return distinct.select("fp").mapInArrow(run, "fp long, key long")


def _near(a: Column, b: Column, bits: int = MOST_BITS) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= bits


def links(distinct: DataFrame, bucket: int = PAIR_BUCKET) -> DataFrame:
    """a, b (a > b): links that connect all distinct fingerprints within two bits of each other.

    Every link joins two linked fingerprints or two that share a neighbour of both; the components are those of
    all pairs at two or fewer bits. A bucket's size is counted before any pair is formed.
    """
    keyed = materialize(_keyed(distinct), "golay_keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    small = keyed.join(sizes.where(F.col("n") <= bucket).select("key"), "key", "left_semi")
    gathered = small.groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))  # at most ``bucket`` values
    # Near pairs within one bounded bucket, by position in its sorted list.
    pair = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("fps") - 1),
            lambda i: F.transform(
                F.filter(F.slice("fps", F.lit(1), i), lambda y: _near(y, F.element_at("fps", i + 1))),
                lambda y: F.struct(F.element_at("fps", i + 1).alias("a"), y.alias("b")),
            ),
        )
    )
    pairs = gathered.select(F.explode(pair).alias("p")).select("p.a", "p.b")
    large = keyed.join(sizes.where(F.col("n") > bucket).select("key"), "key", "left_semi").select("fp").distinct()
    masks = F.array(F.lit(0).cast("long"), *(F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)))
    middles = large.select("fp", F.explode(masks).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    # All fingerprints at one middle are linked to the least of them; two rows a middle suffice for most, so
    # the least is found first, with partial sums before the shuffle.
    least = middles.groupBy("mid").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("top > b").select("mid", "b")
    stars = middles.join(least, "mid").where(F.col("fp") > F.col("b")).select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, root: the least node of each component of ``edges`` (a, b), for all its other nodes.

    Alternates large-star and small-star steps; the edges of each round are a written table, and the rounds end when
    a round changes nothing. Raises if ``most_rounds`` did not suffice.
    """
    current = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    if not state[0]:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(most_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours of a node go to its least neighbour.
        large = both.where("b > a").join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: smaller neighbours of a node, and itself, go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(low, "a")
        small = near.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        current = materialize(small, "edges")
        before, state = state, current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp, component_id (the least key reachable over links, its own included), root (least fingerprint of the component) of every row.

    NULL and empty texts have fingerprint zero and link like any other; rows with a NULL key
    get a component too, whose id is NULL if no other key is in it. Repeated rows stay repeated.
    An empty table gives an empty result; only the key and the text are read.
    """
    hashed = materialize(fingerprints(docs, key, text), "fingerprints")
    distinct = hashed.groupBy("fp").agg(F.min(key).alias("least_key"))
    distinct = materialize(distinct, "distinct_fingerprints")
    root = components(links(distinct))
    rooted = distinct.join(root, distinct["fp"] == root["node"], "left").select("fp", "least_key", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_key").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return hashed.join(named, "fp").select(key, "fp", "component_id", "root")


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
