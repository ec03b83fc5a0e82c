"""Best-fit packing of token sequences after linear grouping.

Only the number of pieces of each length decides a packing, so the plan is made from that
histogram, which has at most ``capacity`` rows for any corpus:

1. Long pieces, above capacity / SHARE, are sorted by length and cut into GROUPS groups of equal
   cardinality; within a group all count as long as its longest.
2. With so few sizes, configurations (what a sequence holds) are chosen one after another: the
   longest size left, and what a knapsack over the other sizes finds to fill the rest best.  Each
   is used as often as pieces last.
3. The actual pieces take the places of the rounded ones, which frees what rounding had added.
4. Short pieces go, longest first, where they leave the least room (best fit), and open a new
   sequence only where none has room.

The plan says which run of pieces of a length goes to which run of sequences, so every piece finds
its sequence from its length and its rank among pieces of that length.  Ranks come from counts by
(length, hash bucket); the plan's size depends on ``capacity`` alone, never on the corpus.

Edge cases: a null or empty text is a piece of the end token alone; equal texts, repeated rows and
null ids are packed like any other; a text longer than ``capacity`` is cut into full pieces and a
last one; no rows give no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import functools
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.chunks import ChunkTable
from driftlake.llm.common import blocks, stored, text_buffer, tidy

GROUPS = 512
SHARE = 4
RANK_BUCKETS = 256
BLOCK_BYTES = 4 << 20
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass
class Plan:
    """Runs of pieces: those of ``length`` with ranks from ``rank`` on go ``each`` to a sequence,
    beginning with ``sequence``."""

    capacity: int
    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    sequences: int = 0

    def put(self, length: int, rank: int, sequence: int, each: int = 1) -> None:
        self.length.append(length)
        self.rank.append(rank)
        self.sequence.append(sequence)
        self.each.append(each)

    def arrays(self) -> tuple[np.ndarray, ...]:
        key = (np.array(self.length, np.int64) << 48) + np.array(self.rank, np.int64)
        order = np.argsort(key)
        return key[order], *(np.array(x, np.int64)[order] for x in (self.rank, self.sequence, self.each))


def _knapsack(sizes: list[int], left: list[int], capacity: int) -> dict[int, int]:
    """The fullest way to use ``capacity`` with the sizes left: group to number.  Longer sizes come
    first, so of equally full ways that with the longest pieces is taken."""
    reach = np.full(capacity + 1, -1, np.int32)  # item that reached this fill first
    reach[0] = 0
    items = []
    for group, size in enumerate(sizes):
        amount, part = min(left[group], capacity // size), 1
        while amount > 0:
            part = min(part, amount)
            amount -= part
            items.append((group, part, size * part))
            fresh = np.flatnonzero((reach[: capacity + 1 - size * part] >= 0)
                                   & (reach[: capacity + 1 - size * part] < len(items))
                                   & (reach[size * part :] < 0))
            reach[fresh + size * part] = len(items)
            part *= 2
        if reach[capacity] >= 0:
            break
    fill, chosen = int(np.flatnonzero(reach >= 0)[-1]), {}
    while fill:
        group, part, size = items[reach[fill] - 1]
        chosen[group] = chosen.get(group, 0) + part
        fill -= size
    return chosen


def make_plan(counts: dict[int, int], capacity: int, groups: int = GROUPS, share: int = SHARE) -> Plan:
    """Plan for ``counts`` pieces by length."""
    plan = Plan(capacity)
    room: dict[int, list[list[int]]] = {}  # residual to runs of sequences [first, end)

    def free(residual: int, first: int, end: int) -> None:
        if residual and end > first:
            room.setdefault(residual, []).append([first, end])

    large = sorted((n for n in counts if n > capacity // share), reverse=True)
    total = sum(counts[n] for n in large)
    if total:
        begins, at = [], 0  # place of the first piece of each length in the sorted list
        for n in large:
            begins.append(at)
            at += counts[n]
        width = -(-total // groups)
        edges = list(range(0, total, width))
        sizes = [large[bisect.bisect_right(begins, e) - 1] for e in edges]
        left = [min(width, total - e) for e in edges]
        taken = [0] * len(edges)
        while any(left):
            longest = next(g for g, n in enumerate(left) if n)
            left[longest] -= 1
            chosen = _knapsack(sizes, left, capacity - sizes[longest])
            left[longest] += 1
            chosen[longest] = chosen.get(longest, 0) + 1
            times = min(left[g] // k for g, k in chosen.items())
            cuts, runs = {0, times}, []
            for g, k in chosen.items():
                for _ in range(k):  # a place of the configuration takes a run of the group
                    u, end = edges[g] + taken[g], edges[g] + taken[g] + times
                    taken[g] += times
                    left[g] -= times
                    run = []
                    while u < end:
                        i = bisect.bisect_right(begins, u) - 1
                        stop = min(end, begins[i] + counts[large[i]])
                        offset = times - (end - u)
                        plan.put(large[i], u - begins[i], plan.sequences + offset)
                        run.append((offset, large[i]))
                        cuts.add(offset)
                        u = stop
                    runs.append(run)
            points = sorted(cuts)
            for first, end in zip(points, points[1:], strict=False):
                used = sum(run[bisect.bisect_right(run, (first, capacity + 1)) - 1][1] for run in runs)
                free(capacity - used, plan.sequences + first, plan.sequences + end)
            plan.sequences += times
    residuals = sorted(room)
    for n in sorted((n for n in counts if n <= capacity // share), reverse=True):
        rank, left_n = 0, counts[n]
        while left_n:
            i = bisect.bisect_left(residuals, n)
            if i < len(residuals):
                residual = residuals[i]
                first, end = room[residual].pop()
                if not room[residual]:
                    del room[residual]
                    residuals.pop(i)
            else:
                residual, first = capacity, plan.sequences
                end = first + -(-left_n // (capacity // n))
                plan.sequences = end
            each = residual // n
            placed = min(left_n, each * (end - first))
            full, rest = divmod(placed, each)
            plan.put(n, rank, first, each)
            rank, left_n = rank + placed, left_n - placed
            for r, a, b in (
                (residual - each * n, first, first + full),
                (residual - rest * n, first + full, first + full + (rest > 0)),
                (residual, first + full + (rest > 0), end),
            ):
                if r and b > a:
                    if r not in room:
                        bisect.insort(residuals, r)
                    free(r, a, b)
    return plan


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def in_order(values: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences that were found in ``order``, put back in their own order."""
    back = np.argsort(order)
    begins, own = np.cumsum(lengths) - lengths, lengths[back]
    at = np.repeat(begins[back] - (np.cumsum(own) - own), own) + np.arange(len(values))
    return values[at], own


def _resolver(path: str, together: int = 500):
    """Ids of distinct chunks by the library, many to a call, told apart by their places."""
    tokenizer = _tokenizer(path)

    last = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
    for token, number in tokenizer.get_vocab().items():
        last[number] = token.endswith("</w>")

    def by_ends(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of plain letters: each ends with a token that ends a word."""
        ids = np.array(tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(last[ids])
        return ids, np.diff(ends, prepend=-1)

    def by_places(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any chunks, told apart by where they begin."""
        found = tokenizer.encode(" ".join(some), add_special_tokens=False)
        begins = np.cumsum([0, *(len(t) + 1 for t in some[:-1])])
        places = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
        own = np.searchsorted(begins, places, side="right") - 1
        return np.array(found.ids, np.uint32), np.bincount(own, minlength=len(some))

    def resolve(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        # Letters of one byte's range stay one letter each in lower case.
        plain = np.fromiter((t.isalpha() and max(t) < "\u0100" for t in texts), bool, len(texts))
        values, lengths, order = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], []
        for which, encode in ((np.flatnonzero(plain), by_ends), (np.flatnonzero(~plain), by_places)):
            for a in range(0, len(which), together):
                ids, sizes = encode([texts[i] for i in which[a : a + together]])
                values.append(ids)
                lengths.append(sizes)
            order.append(which)
        return in_order(np.concatenate(values), np.concatenate(lengths), np.concatenate(order))

    return resolve


def _cutter(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(_resolver(path))
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for a, b in blocks(offsets, BLOCK_BYTES):
                values, at = chunks.sequences(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for i in range(a, b):
                    own = np.append(values[at[i - a] : at[i - a + 1]], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        rows.append((ids[i], piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def cut(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(_cutter(path, capacity, end_id)), PIECE_SCHEMA)


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with ``rank``, from 0 without gaps among the pieces of a length."""
    keys = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_BUCKETS)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = keys.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keys.withColumn("nth", F.row_number().over(own) - 1)
    return ranked.join(first, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("nth"))


def _placer(arrays: tuple[np.ndarray, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first_rank, first_sequence, each = arrays
        for batch in batches:
            length, rank = (batch.column(n).to_numpy().astype(np.int64) for n in ("length", "rank"))
            at = np.searchsorted(key, (length << 48) + rank, side="right") - 1
            sequence = first_sequence[at] + (rank - first_rank[at]) // each[at]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(sequence)],
                                  names=[*names, "sequence_id"])

    return run


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    pieces = stored(cut(docs, path, capacity, end_id), "pieces")
    found = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    plan = make_plan({r["length"]: r["count"] for r in found}, capacity)
    placed = _ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    placed = placed.mapInArrow(_placer(plan.arrays()), f"{PIECE_SCHEMA}, sequence_id long")
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
