"""Conversation structure repair by a persistent dynamic programme over edits.

A conversation is read in order of its turns. For every state of the role pattern ``(s?(ua)+)?`` the programme keeps the
cheapest edits that lead there and, among equally cheap ones, the ASCII-least string of their initials. Edits are
linked nodes: a longer prefix points to the shorter one it extends, so all states share their common past. Each node has
binary-lifting ancestors and a rolling hash of its whole prefix; a tie is settled by searching the longest common prefix
down the ancestors, and what the hashes call equal is verified character by character up to the first shared node.

Forward comparison is exact: two equally cheap prefixes of one state have consumed the same rows, so one can be a proper
prefix of the other only by further inserts, which cost more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACES

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: States of the pattern: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ((USER, "u"),), SYSTEM: ((USER, "u"),), USER: ((ASSISTANT, "a"),), ASSISTANT: ((USER, "u"),)}
ROLE = {"u": "user", "a": "assistant"}
HASH_BASE, HASH_PRIME = 1_000_003, (1 << 61) - 1
#: Rows and characters that wait for their edit before the shared past is written out.
MOST_WAITING, MOST_CHARACTERS = 256, 1 << 20


class Prefixes:
    """Edit prefixes as linked nodes; node 0 is the empty prefix."""

    def __init__(self, base: int = HASH_BASE, prime: int = HASH_PRIME) -> None:
        self.base, self.prime = base, prime
        self.char, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[0]]

    def extend(self, node: int, char: str) -> int:
        """The prefix ``node`` followed by ``char``."""
        new = len(self.char)
        self.char.append(char)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + ord(char)) % self.prime)
        ups, step, level = [node], node, 0
        while level < len(self.up[step]) and step:
            step = self.up[step][level]
            ups.append(step)
            level += 1
        self.up.append(ups)
        return new

    def ancestor(self, node: int, depth: int) -> int:
        """The prefix of ``node`` with ``depth`` characters."""
        steps = self.depth[node] - depth
        level = 0
        while steps:
            if steps & 1:
                node = self.up[node][level]
            steps >>= 1
            level += 1
        return node

    def text(self, node: int, above: int = 0) -> str:
        """Characters of ``node`` after its prefix ``above``."""
        out = []
        while node != above:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _equal(self, a: int, b: int) -> bool:
        """Whether two prefixes of one length are equal, looked at up to the node that they share."""
        while a != b:
            if self.char[a] != self.char[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def parting(self, a: int, b: int) -> tuple[int, int]:
        """The first nodes at which two prefixes of one length differ, (0, 0) if they do not."""
        first, second = a, b
        if self.hash[a] != self.hash[b]:
            for level in range(len(self.up[a]) - 1, -1, -1):
                if level < min(len(self.up[a]), len(self.up[b])):
                    x, y = self.up[a][level], self.up[b][level]
                    if self.hash[x] != self.hash[y]:
                        a, b = x, y
            if self._equal(self.up[a][0], self.up[b][0]):
                return a, b
        elif self._equal(a, b):
            return 0, 0
        # Different prefixes with one hash: the exact place is found by walking.
        found = 0, 0
        while first != second:
            if self.char[first] != self.char[second]:
                found = first, second
            first, second = self.up[first][0], self.up[second][0]
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether ``a`` comes before ``b`` in ASCII order; a proper prefix comes before what extends it."""
        if a == b:
            return False
        shorter = min(self.depth[a], self.depth[b])
        x, y = self.parting(self.ancestor(a, shorter), self.ancestor(b, shorter))
        if x == y:
            return self.depth[a] < self.depth[b]
        return self.char[x] < self.char[y]


class Repair:
    """The cheapest edits of one conversation whose rows arrive in order; rows are held only until their edit is certain."""

    def __init__(self, prefixes: type[Prefixes] = Prefixes, most_waiting: int = MOST_WAITING) -> None:
        self.make, self.most_waiting, self.most_characters = prefixes, most_waiting, MOST_CHARACTERS
        self.rows_at, self.characters_at = self.most_waiting, self.most_characters
        self.nodes = prefixes()
        self.cells: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.waiting: list[tuple[str, str]] = []
        self.characters = 0
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.out_state, self.any_out = START, False
        self._insert()

    def _offer(self, cells: dict[int, tuple[int, int]], state: int, cost: int, node: int, char: str) -> bool:
        have = cells.get(state)
        if have is not None and have[0] < cost:
            return False
        new = self.nodes.extend(node, char)
        if have is None or cost < have[0] or self.nodes.less(new, have[1]):
            cells[state] = (cost, new)
            return True
        return False

    def _insert(self) -> None:
        """Inserts at the present place: two at most lead anywhere without running in a circle."""
        for _ in range(2):
            for state, (cost, node) in sorted(self.cells.items()):
                for target, _ in NEXT[state]:
                    self._offer(self.cells, target, cost + INSERT_COST, node, INSERT)
        # A state is given up once another does strictly better whatever follows: after an assistant row every
        # way on from the start or the system row is open as well (a system row kept later costs at most 4 more to
        # delete), and after a user row an insert leads to it.
        cells = self.cells
        if ASSISTANT in cells:
            best = cells[ASSISTANT][0]
            if START in cells and best + DELETE_COST < cells[START][0]:
                del cells[START]
            if SYSTEM in cells and best < cells[SYSTEM][0]:
                del cells[SYSTEM]

    def row(self, role: str, text: str, fault: str | None) -> None:
        """The next row; ``fault`` is blank, duplicate, truncated or None."""
        extra = TRUNCATED_COST if fault == "truncated" else 0
        initial = role[:1]
        cells: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in sorted(self.cells.items()):
            self._offer(cells, state, cost + DELETE_COST, node, DELETE)
            if fault in ("blank", "duplicate"):
                continue
            if initial == "s" and state == START:
                self._offer(cells, SYSTEM, cost + extra, node, KEEP)
            for target, wanted in NEXT[state]:
                if initial == wanted:
                    self._offer(cells, target, cost + extra, node, KEEP)
                else:
                    self._offer(cells, target, cost + REROLE_COST + extra, node, REROLE)
        self.cells = cells
        self.waiting.append((role, text))
        self.characters += len(text)
        self._insert()
        if len(self.waiting) >= self.rows_at or self.characters >= self.characters_at:
            self._settle()
            # What still waits has to double before it is looked at again, so the work stays linear.
            self.rows_at, self.characters_at = max(self.most_waiting, 2 * len(self.waiting)), max(self.most_characters, 2 * self.characters)

    def _shared(self) -> int:
        """The longest prefix that all live states share."""
        n = self.nodes
        ends = [node for _, node in self.cells.values()]
        low, high = 0, min(n.depth[e] for e in ends)
        while low < high:
            mid = (low + high + 1) // 2
            if len({n.ancestor(e, mid) for e in ends}) == 1:
                low = mid
            else:
                high = mid - 1
        return n.ancestor(ends[0], low)

    def _settle(self) -> None:
        """Write out the shared past and keep only the nodes after it."""
        n, past = self.nodes, self._shared()
        self._emit(n.text(past))
        fresh = self.make()
        moved = {past: 0}
        for state, (cost, node) in self.cells.items():
            path = []
            while node not in moved:
                path.append(node)
                node = n.up[node][0]
            at = moved[node]
            for old in reversed(path):
                at = moved[old] = fresh.extend(at, n.char[old])
            self.cells[state] = (cost, at)
        self.nodes = fresh

    def _emit(self, edits: str) -> None:
        self.audit.append(edits)
        used = 0
        for e in edits:
            role, text = "", ""
            if e != INSERT:
                role, text = self.waiting[used]
                used += 1
            if e == DELETE:
                continue
            if e == KEEP and role[:1] == "s":
                self.out_state = SYSTEM
            else:
                self.out_state, initial = NEXT[self.out_state][0]
                role = role if e == KEEP else ROLE[initial]
            self.digest.update(("\n" if self.any_out else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.any_out = True
        self.characters -= sum(len(t) for _, t in self.waiting[:used])
        del self.waiting[:used]

    def finish(self) -> tuple[int, str, str]:
        """Cost, audit and the hash of the repaired rows."""
        n = self.nodes
        best: tuple[int, int] | None = None
        for state in (START, ASSISTANT):
            cell = self.cells.get(state)
            if cell and (best is None or cell[0] < best[0] or (cell[0] == best[0] and n.less(cell[1], best[1]))):
                best = cell
        if best is None:
            raise RuntimeError("no way to a complete pattern")
        self._emit(n.text(best[1]))
        return best[0], "".join(self.audit), self.digest.hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the rows with faults put in by a hash of their conversation and turn.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (kept here with ``gone`` set, so that its conversation is not lost), 1
    empties the text, 2 removes its ends of sentences, 3 repeats the row, 4 makes its role user. NULLs count as one space,
    but a NULL turn stays NULL and a NULL conversation is one of its own.
    """
    blank = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(F.encode(name, "utf-8")) % 20
    role, text = F.coalesce(F.col("role").cast("string"), blank), F.coalesce(F.col("text").cast("string"), blank)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """The rows with their first fault: blank, duplicate (role and text seen earlier in the conversation), truncated, or NULL.

    Rows of one turn stand in order of role and text. One exchange by conversation serves this window and what follows.
    """
    visible = f"[^{SPACES}]"
    seen = Window.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    last: Column = F.regexp_extract("text", f"({visible})[{SPACES}]*\\z", 1)
    fault = F.when(~F.col("text").rlike(visible), "blank").when(F.col("nth") > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    return rows.repartition("conv_id").withColumn("nth", F.row_number().over(seen)).withColumn("fault", fault).drop("nth")


OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OUT_SCHEMA = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Conversation:
    """Counts and repair of one conversation."""

    def __init__(self, conv_id: int | None) -> None:
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.conv_id, self.illegal = conv_id, 0
        self.first_turn: int | None = None
        self.last_turn: int | None = None
        self.turns = 0
        self.initial: str | None = None
        self.repair = Repair()

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        self.repair.row(role, text, fault)

    def result(self) -> dict:
        cost, audit, digest = self.repair.finish()
        gaps = 0 if self.first_turn is None or self.last_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``rows``: conv_id, turn, role, text and, if there, ``gone`` (the row does not exist, but its conversation does). NULL role and
    text count as one space, a row with an empty role cannot be kept under it; NULL turns come first. Rows with a NULL conv_id are one conversation. Repeated rows are
    duplicates of the first. An empty table gives an empty result; further columns are not read.

    A conversation's hash runs over all its repaired rows in order, so its rows pass through one task: sorted outside the heap by
    Spark and streamed, with only the rows in memory whose edit is not yet certain.
    """
    blank = F.lit(" ")
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"), gone.alias("gone"))
    line = faults(plain).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("gone"), F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == "duplicate")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Conversation | None = None
        for b in batches:
            done = []
            columns = (b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault"))
            for conv_id, turn, role, text, away, fault in zip(*columns):
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        done.append(own.result())
                    own = Conversation(conv_id)
                if not away:
                    own.row(turn, role, text, fault)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=OUT_SCHEMA)
        if own is not None:
            yield pa.RecordBatch.from_pylist([own.result()], schema=OUT_SCHEMA)

    return line.select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(run, OUT)
