"""Byte-pair encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never be bridged by a merge,
so a word may be cut there. The fragments of all words of an Arrow slice are encoded
together: one flat symbol array, in which every round merges the best pair of every
fragment at once. Their ids, laid end to end, are those of the whole word.

Words come from the tokenizer's own rules: NFC, lower case, the split pattern. For
texts of ASCII and Latin letters and common punctuation white space splits words before
everything else, so ids are kept per white-space separated chunk; texts with any other
character go through the library's normalizer and splitter as a whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import batch_of, slices, texts_of

# What the tokenizer file states as pattern, word end and special strings.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

#: Characters whose lower case, composition and class are the same in every Unicode version.
PLAIN = regex.compile("[\t\n\r\x20-\x7e\xa1-įı-ɏ‐-‧‰-⁞]*")
NO_RANK = np.iinfo(np.int64).max
#: Kept chunks of one Python worker; beyond it the oldest are forgotten, which costs time only.
KEPT_CHUNKS = 400_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 stays, the others follow from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(kept))
    names = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class PairEncoder:
    """Vocabulary and merges of a byte-level BPE file whose words end in ``WORD_END``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.path = path
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        added = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.special = added
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.token_of = {i: t for t, i in (vocab | added).items()}
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + WORD_END] for s in symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.joinable = self._joinable(vocab, {s: b for b, s in enumerate(symbols)})
        self.word = regex.compile(WORD_PATTERN)
        self.chunk_word = regex.compile(WORD_PATTERN.replace(r"\s", r"\s\n") + r"|\n")
        self.kept: dict[str, bytes] = {}
        self._library = None

    @staticmethod
    def _joinable(vocab: dict[str, int], byte_of: dict[str, int]) -> np.ndarray:
        """True for each byte pair that some token holds."""
        inside = np.zeros((256, 256), bool)
        for token in vocab:
            b = [byte_of[c] for c in token.removesuffix(WORD_END) if c in byte_of]
            inside[b[:-1], b[1:]] = True
        return inside

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (non-empty, lower-case) words and the number of ids of each word."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        if not len(sizes):
            return np.zeros(0, np.int64), sizes
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes) - 1
        word_of = np.repeat(np.arange(len(sizes)), sizes)
        symbol = self.inner[data]
        symbol[ends] = self.last[data[ends]]
        # A symbol is tied to the next one within its word unless the byte pair forces a cut.
        tied = np.zeros(len(data), bool)
        tied[:-1] = self.joinable[data[:-1], data[1:]]
        tied[ends] = False
        fragment = np.zeros(len(data), np.int64)
        fragment[1:] = np.cumsum(~tied[:-1])
        place = np.arange(len(data))
        out_symbol, out_place = [], []
        rank = np.full(len(data), NO_RANK)
        rank[:-1] = np.where(tied[:-1], self._rank(symbol[:-1], symbol[1:]), NO_RANK)
        while len(symbol):
            heads = np.flatnonzero(np.concatenate(([True], fragment[1:] != fragment[:-1])))
            lengths = np.diff(np.append(heads, len(symbol)))
            best = np.minimum.reduceat(rank, heads)
            live = best < NO_RANK
            if not live.all():
                # Fragments without a further merge are done and leave the work.
                busy = np.repeat(live, lengths)
                out_symbol.append(symbol[~busy])
                out_place.append(place[~busy])
                symbol, rank, fragment, place, tied = symbol[busy], rank[busy], fragment[busy], place[busy], tied[busy]
                best, lengths = best[live], lengths[live]
                if not len(symbol):
                    break
            hit = rank == np.repeat(best, lengths)
            at = np.flatnonzero(hit)
            # Hits in a row ("aaa") overlap: every second one of such a run counts, from its left end.
            run = np.concatenate(([0], np.cumsum(np.diff(at) > 1)))
            first = np.flatnonzero(np.concatenate(([True], np.diff(run) > 0)))
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            tied[at] = tied[at + 1]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            now = np.cumsum(keep)[at] - 1
            symbol, rank, fragment, place, tied = symbol[keep], rank[keep], fragment[keep], place[keep], tied[keep]
            beside = np.zeros(len(symbol), bool)
            beside[now] = beside[np.maximum(now - 1, 0)] = True
            near = np.flatnonzero(beside)
            right = np.minimum(near + 1, len(symbol) - 1)
            rank[near] = np.where(tied[near], self._rank(symbol[near], symbol[right]), NO_RANK)
        symbols, places = np.concatenate(out_symbol), np.concatenate(out_place)
        order = np.argsort(places, kind="stable")
        return symbols[order], np.bincount(word_of[places], minlength=len(sizes))

    def _library_words(self, text: str) -> list[str]:
        """Normalised words of any text by the library's own normalizer and the split pattern."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._split_symbols(self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text)))

    @staticmethod
    def _split_symbols(pieces: list[tuple[str, tuple[int, int]]]) -> list[str]:
        back = {s: b for b, s in enumerate(byte_symbols())}
        return [bytes(back[c] for c in word).decode("utf-8") for word, _ in pieces]

    def _parts(self, text: str) -> list[str]:
        """Text between special strings, and these strings themselves."""
        return self.special_split.split(text) if self.special_split and any(s in text for s in self.special) else [text]

    def learn(self, texts: list[str]) -> list[bytes | None]:
        """Keep the ids of every new chunk of the plain texts; ids of other texts are returned at their place."""
        if len(self.kept) > KEPT_CHUNKS:
            for chunk in list(self.kept)[: KEPT_CHUNKS // 2]:
                del self.kept[chunk]
        fresh: dict[str, None] = {}
        odd: list[tuple[int, list[str | int]]] = []
        for i, text in enumerate(texts):
            if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
                fresh.update(dict.fromkeys(set(text.split()).difference(self.kept)))
            else:
                odd.append((i, [x for p in self._parts(text) for x in ([self.special[p]] if p in self.special else self._library_words(p) if p else [])]))
        chunks = list(fresh)
        words: list[str] = []
        owner: list[int] = []
        at = 0
        for word in self.chunk_word.findall("\n".join(chunks).lower()):
            if word == "\n":
                at += 1
            else:
                words.append(word)
                owner.append(at)
        for _, parts in odd:
            words.extend(p for p in parts if isinstance(p, str))
        ids, counts = self.encode_words(words)
        ids = ids.astype("<u4")
        per_chunk = np.bincount(np.array(owner, np.int64), weights=counts[: len(owner)], minlength=len(chunks)).astype(np.int64)
        ends = np.cumsum(per_chunk) * 4
        blob, start = ids.tobytes(), 0
        for chunk, end in zip(chunks, ends.tolist()):
            self.kept[chunk] = blob[start:end]
            start = end
        found: list[bytes | None] = [None] * len(texts)
        word_at, id_at = len(owner), start // 4
        for i, parts in odd:
            out = []
            for p in parts:
                if isinstance(p, str):
                    n = int(counts[word_at])
                    out.append(ids[id_at : id_at + n])
                    word_at, id_at = word_at + 1, id_at + n
                else:
                    out.append(np.array([p], "<u4"))
            found[i] = b"".join(x.tobytes() for x in out)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        kept, out = self.kept, []
        for text, odd in zip(texts, self.learn(texts)):
            out.append(b"".join(map(kept.__getitem__, text.split())) if odd is None else odd)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by one space, special ones included: the file names no decoder."""
        return " ".join([self.token_of[i] for i in ids.tolist() if i in self.token_of])


_ENCODERS: dict[str, PairEncoder] = {}


def encoder(path: str) -> PairEncoder:
    """One encoder for each file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PairEncoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (array of int) of every whole text.

    NULL and empty texts have no ids; repeated rows stay; other columns are not read. An
    empty table gives an empty result.
    """
    schema = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, "text"):
            blobs = enc.encode(texts_of(b.column("text")))
            offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in blobs]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
            yield pa.RecordBatch.from_arrays([b.column("key").cast(pa.int64()), ids.cast(schema.field("ids").type)], schema=schema)

    narrow = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    return narrow.mapInArrow(run, "key long, ids array<int>").withColumnRenamed("key", key)


def digest_documents(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row of ``encode_documents``."""
    schema = pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        top = max(enc.token_of) + 1
        number = np.array([str(i) for i in range(top)], object)
        token = np.array([enc.token_of.get(i, "") for i in range(top)], object)
        for b in batches:
            lists = b.column("ids")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            counts, ids_sha, decoded_sha = np.diff(offsets), [], []
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                part = flat[s:e]
                ids_sha.append(hashlib.sha256(" ".join(number[part].tolist()).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(" ".join(token[part].tolist()).encode()).hexdigest())
            yield batch_of(schema, key=b.column("key"), n_tokens=counts, ids_sha256=ids_sha, decoded_sha256=decoded_sha)

    return encoded.select(encoded[key].alias("key"), "ids").mapInArrow(run, "key long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
