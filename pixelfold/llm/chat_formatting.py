"""Chat formatting with offset-aligned loss masks.

A conversation is rendered turn by turn, ``<s>[INST]role[/INST]text</s>``, control strings inside roles and texts
being escaped reversibly. The rendered text is encoded once with offsets; the sorted spans of the turns to be learned
are intersected with the sorted token spans by binary search, which gives a mask per token and the
exact characters under it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_of

# Fixed values of the template: start, role close, turn close, and the escape character.
OPEN, MIDDLE, CLOSE, ESCAPE = "<s>[INST]", "[/INST]", "</s>", "\\"
LEARNED_ROLE = "assistant"
#: A longer conversation is held in segments of whole turns. Between two turns the tokenizer sees ``s``, ``><``, ``s``: the marks
#: are a piece of their own, which goes to the earlier segment, so the ids are those of one encoding of the whole.
SEGMENT_CHARS = 1 << 20

_CONTROL = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=/?s>|/?INST\])")
_TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(CLOSE), re.S)


def escape(text: str) -> str:
    """No control string is left; one more escape character where there were some already."""
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]], learned: str = LEARNED_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text of (role, text) turns, and the span of the escaped text of each turn to be learned."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + MIDDLE, escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns back from the formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


@cache
def tokenizer(path: str):
    """The tokenizer with offsets that cover every character, white space included; special strings are text."""
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    t.no_truncation()
    t.no_padding()
    return t


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Mask of the tokens that touch a span, and the characters of each span that tokens cover, as merged ranges."""
    mask = np.zeros(len(starts), bool)
    covered: list[tuple[int, int]] = []
    for low, high in spans:
        first = int(np.searchsorted(ends, low, side="right"))
        last = int(np.searchsorted(starts, high, side="left"))
        if low == high or first >= last:
            continue
        mask[first:last] = True
        a, b = np.maximum(starts[first:last], low), np.minimum(ends[first:last], high)
        cut = np.flatnonzero(a[1:] > np.maximum.accumulate(b)[:-1])
        covered += zip(a[np.concatenate(([0], cut + 1))].tolist(), np.maximum.accumulate(b)[np.concatenate((cut, [len(b) - 1]))].tolist())
    return mask, covered


def format_conversations(rows: DataFrame, path: str, learned: str = LEARNED_ROLE, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """key, segment, text, ids, starts, ends, mask, learned_starts, learned_ends: one row per conversation segment, in order.

    Turns are ordered by their number, NULL first, then role and text; repeated rows are turns of their own. NULL roles and texts
    are empty; rows with a NULL key are one conversation. The rows of a conversation stream through one
    task in sorted order, ``SEGMENT_CHARS`` at a time, as its digest is sequential; nothing of it is collected.
    Ids of the segments together are those of the whole conversation encoded once; starts and ends count from the segment's
    first character, and its last token may end one character behind it.
    An empty table gives an empty result; other columns are not read.
    """
    narrow = rows.select(
        F.col(key).cast("long").alias("key"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    ordered = narrow.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    schema = pa.schema([("key", pa.int64()), ("segment", pa.int64()), ("text", pa.string()), ("ids", ints), ("starts", longs), ("ends", longs), ("mask", pa.list_(pa.bool_())), ("learned_starts", longs), ("learned_ends", longs)])

    def row_of(owner: int | None, segment: int, turns: list[tuple[str, str]], more: bool) -> tuple:
        formatted, spans = render(turns, learned)
        # The mark between two segments is encoded with the earlier one.
        skipped = 1 if segment else 0
        e = tokenizer(path).encode(formatted[skipped:] + (OPEN[0] if more else ""), add_special_tokens=False)
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2) + skipped
        mask, covered = masked(offsets[:, 0], offsets[:, 1], spans)
        return owner, segment, formatted, np.array(e.ids, np.int32), offsets[:, 0], offsets[:, 1], mask, [a for a, _ in covered], [b for _, b in covered]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, segment, turns, chars, started = None, 0, [], 0, False
        done: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, held
            if done:
                yield batch_of(schema, **{f.name: [r[i] for r in done] for i, f in enumerate(schema)})
            done, held = [], 0

        for b in batches:
            for k, r, t in zip(b.column("key").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()):
                new = not started or k != owner
                if turns and (new or chars >= SEGMENT_CHARS):
                    done.append(row_of(owner, segment, turns, not new))
                    held, segment, turns, chars = held + chars, segment + 1, [], 0
                if new:
                    owner, segment, started = k, 0, True
                turns.append((r, t))
                chars += len(r) + len(t)
                if held >= SEGMENT_CHARS:
                    yield from flush()
        if turns:
            done.append(row_of(owner, segment, turns, False))
        yield from flush()

    kinds = "key long, segment long, text string, ids array<int>, starts array<long>, ends array<long>, mask array<boolean>, learned_starts array<long>, learned_ends array<long>"
    return ordered.mapInArrow(run, kinds).withColumnRenamed("key", key)


def digest_conversations(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Digests read back from the formatted texts and masks, one row per conversation.

    ``formatted`` must come straight from ``format_conversations``: the segments of a conversation follow each other.
    """
    schema = pa.schema([("key", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: list | None = None

        def closed(rows: list[list]) -> pa.RecordBatch:
            return batch_of(schema, key=[r[0] for r in rows], n_turns=[r[1] for r in rows], turns_sha256=[r[2].hexdigest() for r in rows], loss_chars=[r[3] for r in rows], loss_sha256=[r[4].hexdigest() for r in rows], formatted_chars=[r[5] for r in rows])

        for b in batches:
            done = []
            for k, segment, text, lows, highs in zip(*(b.column(c).to_pylist() for c in ("key", "segment", "text", "learned_starts", "learned_ends"))):
                if segment == 0:
                    if open_row:
                        done.append(open_row)
                    open_row = [k, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(text):
                    open_row[1] += 1
                    open_row[2].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for low, high in zip(lows, highs):
                    body = unescape(text[low:high])
                    open_row[3] += len(body)
                    open_row[4].update(body.encode("utf-8", "surrogatepass"))
                open_row[5] += len(text)
            if done:
                yield closed(done)
        if open_row:
            yield closed([open_row])

    narrow = formatted.select(F.col(key).alias("key"), "segment", "text", "learned_starts", "learned_ends")
    return narrow.mapInArrow(run, "key long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("key", key)
