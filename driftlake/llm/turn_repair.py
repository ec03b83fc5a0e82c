"""Cheapest repair of conversations, by dynamic programming over a grammar of their turns.

A turn is a symbol: its role (system, user, assistant, other) and its first fault (none, blank,
duplicate, truncated).  Rows may be kept, given another role, or deleted, and empty turns may be
put in, so that the roles' initials read ``(s?(ua)+)?``; each edit has a cost.

1. Sequences of symbols are compressed by Re-Pair over the whole corpus: Spark counts neighbours,
   the most frequent pair becomes a rule.  Pairs whose places can't overlap, because no symbol ends
   one and begins another, are replaced in the same round.  Rules are few (MOST_RULES); what they
   don't cover stays as it is, so their number changes no result.
2. A symbol has a transfer matrix: for every state of the automaton before and after it the least
   cost, and the rank of its audit among those from the same state.  Matrices are composed in the
   min-plus semiring, once per rule and from the bottom up, for all conversations.  The audit is a
   rope: an entry names the state between both halves, and is spelled out only for the path taken.
3. Costs are passed back from a conversation's end, states forward from its start, and rows are
   rewritten in order.

Why ranks are enough: inserts count to the row after them, so an audit ends on a row's letter and
holds one for each row.  Of two audits of the same rows neither begins with the other, and the
order of two concatenations is decided by their first halves, or by their second if those are equal.

Long conversations are cut into segments of at most SEGMENT rows wherever the sorted rows happen
to be, so one that holds a third of all rows is spread over tasks up to its matrices.  Costs and
states pass through its segments as a stream with four numbers at hand.  The repaired texts are
hashed in order, as SHA-256 asks; they pass through one task a conversation as a stream, never held
together (``with_text`` does hold them).  An audit is one value of one letter a row.

Edge cases: null roles and texts are one space.  Rows without a turn come first; rows of one turn
stand by role, then by SHA-256 of the text.  Repeated rows are duplicates.  Rows without a
conversation form one of their own.  Roles count by their first letter only; an empty one is like
any other.  A conversation without rows has zeros, an empty audit and no text.  Gaps beyond a long
give the largest one.  Texts of any length pass as they are.  No rows give no rows.  Only
``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import ASCII_SPACE, stored

SEGMENT = 4096
ROUNDS = 8
PAIRS_A_ROUND = 32
MOST_RULES = 256
TOGETHER = 1 << 20  # symbols handled at once

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs of edits (fixed values)
FAULTS = 4  # none, blank, duplicate, truncated
TERMINALS = 4 * FAULTS
STATES = 4  # nothing yet, after system, after user, after assistant
NEVER = 1 << 40
TRAILS = [b"", b"II", b"I", b""]  # inserts that complete what ends in each state
LARGEST = (1 << 63) - 1

SEGMENT_SCHEMA = (
    "conv_id long, turn long, role string, digest binary, part long, symbols binary, "
    "first_turn long, last_turn long, n_turns long"
)
RESULT_SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string, repaired string"
)
_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

# Adjacent roles (system, user, assistant, other) that are allowed: su, ua, au.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


# -- matrices ---------------------------------------------------------------------------------

def _after(state: int, role: int) -> int | None:
    """State after a turn of ``role``, or None if the pattern forbids it."""
    before = {0: (0,), 1: (0, 1, 3), 2: (2,)}.get(role, ())
    return role + 1 if state in before else None


def _wanted(state: int) -> int:
    """Role of an inserted turn: assistant after user, else user."""
    return 2 if state == 2 else 1


def _terminal(symbol: int) -> tuple[list[list[int]], list[list[bytes]]]:
    """Costs and audits of one row between any two states."""
    role, fault = divmod(symbol, FAULTS)
    cost = [[NEVER] * STATES for _ in range(STATES)]
    audit = [[b"~"] * STATES for _ in range(STATES)]
    extra = TRUNCATED if fault == 3 else 0
    for start in range(STATES):
        state = start
        for inserts in range(STATES):
            options = [(DELETE, b"D", state)]
            if fault in (0, 3):
                options.append((KEEP + extra, b"K", _after(state, role)))
                options += [(REROLE + extra, b"R", _after(state, r)) for r in (1, 2)]
            for price, letter, end in options:
                if end is not None:
                    found = (INSERT * inserts + price, b"I" * inserts + letter)
                    if found < (cost[start][end], audit[start][end]):
                        cost[start][end], audit[start][end] = found
            state = _after(state, _wanted(state))
    return cost, audit


@functools.lru_cache(maxsize=1)
def _terminals() -> tuple[np.ndarray, np.ndarray, list]:
    costs, audits = zip(*map(_terminal, range(TERMINALS)), strict=True)
    ranks = [[[sorted(row).index(a) for a in row] for row in audit] for audit in audits]
    # Entries that can't be reached share a rank; no path takes them.
    return np.array(costs, np.int64), np.array(ranks, np.int64), audits


class Arena:
    """Matrices by number: terminals, then whatever is composed of earlier ones."""

    def __init__(self, rounds: list[list[tuple[int, int]]]):
        self.cost, self.rank, self.audits = _terminals()
        self.split = np.zeros_like(self.rank)
        self.left = self.right = np.full(TERMINALS, -1, np.int64)
        self.rounds = []
        for rules in rounds:
            pairs = np.array(rules, np.int64).reshape(-1, 2)
            numbers = self.compose(pairs[:, 0], pairs[:, 1])
            self.rounds.append({(int(a), int(b)): int(n) for (a, b), n in zip(pairs, numbers, strict=True)})
        self.shared = len(self.left)
        self.spelled = functools.lru_cache(maxsize=4096)(self._spell)

    def forget(self) -> None:
        """Drop what isn't shared by all conversations."""
        for name in ("cost", "rank", "split", "left", "right"):
            setattr(self, name, getattr(self, name)[: self.shared])

    def compose(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of new matrices, each of ``left`` followed by ``right``."""
        base = len(self.left)
        rank = self.rank[left]
        total = self.cost[left][:, :, :, None] + self.cost[right][:, None, :, :]
        key = total * STATES + rank[:, :, :, None]
        split = key.argmin(axis=2)
        cost = np.minimum(np.take_along_axis(total, split[:, :, None, :], 2)[:, :, 0, :], NEVER)
        own = np.take_along_axis(rank, split, 2)
        then = self.rank[right][np.arange(len(right))[:, None, None], split, np.arange(STATES)]
        order = own * STATES + then + np.where(cost >= NEVER, STATES * STATES, 0)
        order = order.argsort(axis=2, kind="stable").argsort(axis=2, kind="stable")
        self.cost = np.concatenate([self.cost, cost])
        self.rank = np.concatenate([self.rank, order])
        self.split = np.concatenate([self.split, split])
        self.left, self.right = np.append(self.left, left), np.append(self.right, right)
        return np.arange(base, base + len(left))

    def encode(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences after all rounds of replacements, and their lengths."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        for rules in self.rounds:
            symbols, owner = replace(symbols, owner, rules)
        return symbols, np.bincount(owner, minlength=len(lengths))

    def roots(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Matrix of each whole sequence: neighbours are composed until one is left."""
        nodes, counts = self.encode(symbols.copy(), lengths)
        while len(counts) and counts.max() > 1:
            starts = np.cumsum(counts) - counts
            place = np.arange(len(nodes)) - np.repeat(starts, counts)
            paired = (place % 2 == 0) & (place + 1 < np.repeat(counts, counts))
            at = np.flatnonzero(paired)
            nodes[at] = self.compose(nodes[at], nodes[at + 1])
            nodes = nodes[place % 2 == 0]
            counts = (counts + 1) // 2
        return nodes

    def _spell(self, node: int, start: int, end: int) -> bytes:
        return b"".join(self._letters(node, start, end))

    def _letters(self, node: int, start: int, end: int) -> Iterator[bytes]:
        waiting = [(node, start, end)]
        while waiting:
            node, start, end = waiting.pop()
            if self.left[node] < 0:
                yield self.audits[node][start][end]
                continue
            middle = int(self.split[node, start, end])
            waiting.append((int(self.right[node]), middle, end))
            waiting.append((int(self.left[node]), start, middle))

    def audit(self, node: int, start: int, end: int) -> bytes:
        """The rope spelled out; what hangs below a shared rule is kept."""
        out, waiting = [], [(node, start, end)]
        while waiting:
            node, start, end = waiting.pop()
            if node < self.shared:
                out.append(self.spelled(node, start, end))
                continue
            middle = int(self.split[node, start, end])
            waiting.append((int(self.right[node]), middle, end))
            waiting.append((int(self.left[node]), start, middle))
        return b"".join(out)


# -- grammar ----------------------------------------------------------------------------------

def replace(symbols: np.ndarray, owner: np.ndarray, rules: dict) -> tuple[np.ndarray, np.ndarray]:
    """One round: every place of a pair becomes its rule's number."""
    if len(symbols) < 2 or not rules:
        return symbols, owner
    size = int(max(symbols.max(), *(max(p) for p in rules))) + 1
    table = np.zeros(size * size, np.int64)
    for (a, b), number in rules.items():
        table[a * size + b] = number
    found = np.append(np.where(owner[1:] == owner[:-1], table[symbols[:-1] * size + symbols[1:]], 0), 0)
    doubles = [a for a, b in rules if a == b]
    if doubles:  # in a run of one symbol every second place
        same = np.append(False, (symbols[1:] == symbols[:-1]) & (owner[1:] == owner[:-1]))
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(symbols))))
        odd = (np.arange(len(symbols)) - first) % 2 == 1
        found[np.isin(symbols, doubles) & odd & (found > 0) & np.append(same[1:], False)] = 0
    gone = np.append(False, found[:-1] > 0)
    return np.where(found > 0, found, symbols)[~gone], owner[~gone]


def choose(counts: list[tuple[int, int, int]], most: int) -> list[tuple[int, int]]:
    """The most frequent pairs whose places can't overlap: no symbol both ends and begins one."""
    begins, ends, out = set(), set(), []
    for a, b, _ in sorted(counts, key=lambda c: (-c[2], c[0], c[1])):
        if len(out) == most:
            break
        if a in ends or b in begins or (a == b and (a in begins or b in ends)):
            continue
        begins.add(a)
        ends.add(b)
        out.append((a, b))
    return out


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(s, np.uint8) for s in column.to_pylist()]
    lengths = np.array([len(p) for p in parts], np.int64)
    return np.concatenate([np.zeros(0, np.uint8), *parts]).astype(np.int64), lengths


def _neighbours(rounds: list[list[tuple[int, int]]]):
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arena = Arena(rounds)
        for batch in batches:
            symbols, lengths = arena.encode(*_symbols(batch.column("symbols")))
            owner = np.repeat(np.arange(len(lengths)), lengths)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, place = np.unique((symbols[inner] << 16) | symbols[inner + 1], return_inverse=True)
            weights = batch.column("count").to_numpy()[owner[inner]]
            n = np.bincount(place, weights, len(pairs)).astype(np.int64)
            columns = [pa.array(c).cast(f.type) for c, f in zip((pairs >> 16, pairs & 0xFFFF, n), schema, strict=True)]
            yield pa.record_batch(columns, schema=schema)

    return run


def grammar(sequences: DataFrame) -> list[list[tuple[int, int]]]:
    """Rules by round, from ``sequences`` (symbols, count).

    A round gathers the counts of distinct pairs, at most (TERMINALS + MOST_RULES) squared.
    """
    rounds: list[list[tuple[int, int]]] = []
    while len(rounds) < ROUNDS and (left := MOST_RULES - sum(map(len, rounds))) > 0:
        counted = sequences.mapInArrow(_neighbours(rounds), "a int, b int, n long")
        counts = counted.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 1").collect()
        rules = choose([tuple(r) for r in counts], min(left, PAIRS_A_ROUND))
        if not rules:
            break
        rounds.append(rules)
    return rounds


# -- rows to segments -------------------------------------------------------------------------

def _rows(turns: DataFrame, copies: Column) -> DataFrame:
    """conv_id, turn, role, text, digest and number of copies of every row."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _distinct_turns(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number; kind is the symbol as if it were no duplicate."""
    body = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    fault = F.when(body == "", 1).when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = (role * FAULTS + fault).cast("int").alias("kind")
    return (
        rows.filter("copies > 0").select("conv_id", "turn", "role", "digest", kind, "copies")
        .groupBy("conv_id", "turn", "role", "digest", "kind").agg(F.sum("copies").alias("n"))
    )


def _marked(turns: DataFrame) -> DataFrame:
    """Distinct turns in order, each first one of its role and text behind a row of kind -1."""
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = turns.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("place")).select(
        "conv_id", F.col("place.turn").alias("turn"), "role", "digest", F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("n"))
    keys = ["conv_id", "turn", "role", "digest"]
    return turns.select(*keys, "kind", "n").union(first).repartitionByRange(*keys).sortWithinPartitions(*keys, "kind")


def _cut(conv, turn, has_turn, first, kind, copies) -> Iterator[tuple]:
    """(row it begins in, copies of it before, symbols, first, last and number of turns) of segments.

    Rows come in order; ``conv`` tells conversations apart by number.
    """
    doubled = np.where(kind % FAULTS == 1, kind, kind - kind % FAULTS + 2)
    lead = np.where(first, kind, doubled)
    # A row of many copies counts as several rows.
    pieces = -(-copies // SEGMENT)
    row = np.repeat(np.arange(len(conv)), pieces)
    skipped = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
    n = np.minimum(copies[row] - skipped, SEGMENT)
    start = 0
    while start < len(row):
        total = np.cumsum(n[start:])
        stop = start + max(1, int(np.searchsorted(total, TOGETHER, side="right")))
        own = row[start:stop]
        symbols = np.repeat(doubled[own], n[start:stop])
        heads = np.cumsum(n[start:stop]) - n[start:stop]
        symbols[heads[skipped[start:stop] == 0]] = lead[own[skipped[start:stop] == 0]]
        of = np.repeat(np.arange(start, stop), n[start:stop])  # the piece a symbol belongs to
        edges = np.flatnonzero(np.append(True, conv[row[of]][1:] != conv[row[of]][:-1]))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(symbols)], strict=True):
            for x in range(a, b, SEGMENT):
                y = min(x + SEGMENT, b)
                piece = of[x]
                before = int(skipped[piece] + x - heads[piece - start])
                rows = row[of[x:y]]
                turns = turn[rows][has_turn[rows]]
                distinct = 1 + int(np.count_nonzero(turns[1:] != turns[:-1])) if len(turns) else 0
                ends = (int(turns[0]), int(turns[-1])) if len(turns) else (None, None)
                yield int(row[piece]), before, symbols[x:y].astype(np.uint8).tobytes(), *ends, distinct
        start = stop


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()),
        ("part", pa.int64()), ("symbols", pa.binary()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
        ("n_turns", pa.int64())])
    marked = False
    for batch in batches:
        kind = batch.column("kind").to_numpy().astype(np.int64)
        if not len(kind):
            continue
        before = np.append(marked, kind[:-1] < 0)
        marked = bool(kind[-1] < 0)
        rows = np.flatnonzero(kind >= 0)
        own = pa.Table.from_batches([batch]).take(pa.array(rows))
        id_, turn = (own.column(c).combine_chunks() for c in ("conv_id", "turn"))
        value, known = id_.fill_null(0).to_numpy(), id_.is_valid().to_numpy(zero_copy_only=False)
        conv = np.cumsum(np.append(0, (value[1:] != value[:-1]) | (known[1:] != known[:-1]))[: len(rows)])
        has_turn = turn.is_valid().to_numpy(zero_copy_only=False)
        found = list(_cut(conv, turn.fill_null(0).to_numpy(), has_turn, before[rows], kind[rows],
                          own.column("n").to_numpy()))
        at, part, symbols, first, last, n_turns = zip(*found, strict=True) if found else [[]] * 6
        keys = own.take(pa.array(at, pa.int64())).select(["conv_id", "turn", "role", "digest"]).combine_chunks()
        columns = [*keys.columns, part, symbols, first, last, n_turns]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type)
                   for c, f in zip(columns, schema, strict=True)]
        yield pa.record_batch(columns, schema=schema)


# -- costs backward, states forward -----------------------------------------------------------

def _backward(rounds: list[list[tuple[int, int]]]):
    """Adds to segments, latest first, the state each start leads to, and the cost up to the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arena, last, ahead = Arena(rounds), None, None
        finish = np.array([INSERT * len(t) for t in TRAILS], np.int64)
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            if not ids:
                continue
            arena.forget()
            roots = arena.roots(*_symbols(batch.column("symbols")))
            cost, rank = arena.cost[roots], arena.rank[roots]
            place = [0] * len(ids)
            for i in range(1, len(ids)):
                place[i] = place[i - 1] + 1 if ids[i] == ids[i - 1] else 0
            place = np.array(place)
            goes, left = np.zeros((len(ids), STATES), np.int8), np.zeros((len(ids), STATES), np.int64)
            for step in range(int(place.max()) + 1):
                at = np.flatnonzero(place == step)
                if step:
                    beyond = left[at - 1]
                else:
                    beyond = np.repeat(finish[None], len(at), 0)
                    if ahead is not None and ids[0] == last:
                        beyond[0] = ahead
                key = (cost[at] + beyond[:, None, :]) * STATES + rank[at]
                goes[at] = key.argmin(axis=2)
                left[at] = np.minimum(key.min(axis=2) // STATES, NEVER)
            last, ahead = ids[-1], left[-1]
            columns = [batch.column(c) for c in batch.schema.names]
            columns += [pa.array([g.tobytes() for g in goes], pa.binary()), pa.array(left[:, 0])]
            yield pa.record_batch(columns, names=[*batch.schema.names, "goes", "cost"])

    return run


class _Conversation:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, conv_id, with_text: bool):
        self.conv_id = conv_id
        self.numbers = dict.fromkeys(_NUMBERS, 0)
        self.state = 0  # after the segments so far
        self.shown = 0  # after the turns written so far
        self.audit: list[bytes] = []
        self.letters: deque[int] = deque()
        self.hash = hashlib.sha256()
        self.lines: list[str] | None = [] if with_text else None
        self.written = False
        self.roles: np.ndarray | None = None
        self.turns = [None, None, 0]  # first, last, distinct

    def segment(self, arena: Arena, root: int, symbols: bytes, goes: bytes, cost: int, first, last, n_turns) -> None:
        if self.roles is None:
            self.numbers["cost"] = cost
        end = goes[self.state]
        letters = arena.audit(root, self.state, end)
        self.state = end
        self.audit.append(letters)
        self.letters.extend(letters)
        found = np.frombuffer(symbols, np.uint8)
        count = np.bincount(found % FAULTS, minlength=FAULTS)
        for name, n in zip(("blank", "duplicate", "truncated"), count[1:].tolist(), strict=True):
            self.numbers[name] += n
        roles = found // FAULTS
        joined = roles if self.roles is None else np.append(self.roles, roles)
        self.numbers["illegal"] += int(np.count_nonzero(~_LEGAL[joined[:-1], joined[1:]]))
        self.roles = roles[-1:]
        if n_turns:
            start, before, distinct = self.turns
            self.turns = [first if start is None else start, last, distinct + n_turns - (before == first)]

    def _write(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.hash.update((b"\n" if self.written else b"") + line.encode())
        self.written = True
        if self.lines is not None:
            self.lines.append(line)

    def _fill(self, text: str) -> None:
        role = _wanted(self.shown)
        self.shown = role + 1
        self._write("assistant" if role == 2 else "user", text)

    def row(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            while (letter := self.letters.popleft()) == 73:  # I
                self._fill("")
            if letter == 75:  # K
                self.shown = {"s": 1, "u": 2, "a": 3}[role[0]]
                self._write(role, text)
            elif letter == 82:  # R
                self._fill(text)

    def result(self) -> tuple:
        trail = TRAILS[self.state]
        for _ in trail:
            self._fill("")
        if self.turns[2]:
            self.numbers["gaps"] = min(self.turns[1] - self.turns[0] + 1 - self.turns[2], LARGEST)
        audit = b"".join([*self.audit, trail]).decode()
        text = "\n".join(self.lines) if self.lines is not None else None
        return self.conv_id, *self.numbers.values(), audit, self.hash.hexdigest(), text


def _rewrite(rounds: list[list[tuple[int, int]]], with_text: bool):
    names = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 3

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arena, now = Arena(rounds), None
        plain = ["conv_id", "kind", "role", "text", "copies"]
        parts = ["symbols", "goes", "cost", "first_turn", "last_turn", "n_turns"]
        for batch in batches:
            done = []
            whole = pa.Table.from_batches([batch])
            of = np.flatnonzero(batch.column("kind").to_numpy() == 0)
            segments = whole.select(parts).take(pa.array(of)).combine_chunks()
            arena.forget()
            column = segments.column("symbols")
            roots = iter(arena.roots(*_symbols(column)).tolist())
            details = iter(zip(*(segments.column(c).to_pylist() for c in parts), strict=True))
            for conv_id, kind, role, text, copies in zip(*(batch.column(c).to_pylist() for c in plain), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv_id, with_text)
                if kind == 0:
                    now.segment(arena, next(roots), *next(details))
                elif copies:
                    now.row(role, text, copies)
            yield table(done)
        yield table([now.result()] if now is not None else [])

    return run


def repair(turns: DataFrame, copies: Column | None = None, with_text: bool = False) -> DataFrame:
    """Each conversation's faults, least cost, audit, and its repaired turns as digest and, with
    ``with_text``, as text (``role:text`` lines).

    ``copies``: how many times a row stands; rows of 0 only name their conversation.
    """
    rows = _rows(turns, F.lit(1) if copies is None else copies)
    distinct = stored(_distinct_turns(rows), "turns")
    segments = stored(_marked(distinct).mapInArrow(_segments, SEGMENT_SCHEMA), "segments")
    sequences = stored(segments.groupBy("symbols").count(), "sequences")
    rounds = grammar(sequences)
    latest = [F.desc("turn"), F.desc("role"), F.desc("digest"), F.desc("part")]
    decided = (
        segments.repartition("conv_id").sortWithinPartitions("conv_id", *latest)
        .mapInArrow(_backward(rounds), f"{SEGMENT_SCHEMA}, goes binary, cost long")
    )
    both = decided.withColumn("kind", F.lit(0)).unionByName(
        rows.withColumn("kind", F.lit(1)).withColumn("part", F.lit(0).cast("long"))
        .withColumn("text", F.when(F.col("copies") > 0, F.col("text"))), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "kind", "part")
    repaired = ordered.mapInArrow(_rewrite(rounds, with_text), RESULT_SCHEMA)
    return repaired if with_text else repaired.drop("repaired")


def damage(turns: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with faults put in by a hash of conversation and turn, and each row's copies.

    0 of 20 drops the row, 1 empties its text, 2 removes ``. ! ?``, 3 repeats it, 4 makes it the
    user's.
    """
    def text_of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    chance = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = turns.select(
        "conv_id", "turn",
        F.when(chance == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
        F.when(chance == 1, F.lit("")).when(chance == 2, F.translate(text_of("text"), ".!?", ""))
        .otherwise(text_of("text")).alias("text"),
        F.when(chance == 0, 0).when(chance == 3, 2).otherwise(1).alias("copies"))
    return rows, F.col("copies")
