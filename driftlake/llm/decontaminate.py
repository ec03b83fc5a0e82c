"""Benchmark decontamination by an FM-index per training shard.

A shard is a block of documents within a task.  Its words become symbols: those of the test
phrases have numbers, all others are separators, and so are the places between documents; runs of
symbols too short for any phrase are left out.  No two separators count as equal, so a suffix ends
at its next separator, which keeps the sorting of the shard's suffixes short, and no match can
cross one.

The index is the last column of the sorted suffixes as a wavelet matrix with running counts, and
the text places of every SAMPLE-th suffix and of those that follow a separator.  All windows are
searched backward at once; every row found walks back until a sampled place says where it is.
Places become word spans, overlapping spans merge, and documents get them as byte spans.

The test phrases go to the tasks in blocks of about ``block_bytes``; with more than one, each pass
over the documents searches one block and adds to the hits before.  Passes are stages of their own
with written rows in between, so each task, and the driver, holds one block.

Edge cases: a null or empty document has no words and no hits; items without words match nothing;
an item shorter than a window matches as a whole; a null item id is listed as an empty string;
items with equal texts are all listed; repeated documents are all returned with equal results; no
documents give no rows.  A text beyond SHARD_BYTES is a shard of its own, whose words and index one
task holds, some ten times its size.  Of documents only ``text`` is read, the rest is handed on in ``row``.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.llm.common import blocks, stored, text_buffer, tidy

WINDOW = 10
SAMPLE = 16
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

# Lower-cases A-Z, keeps 0-9, a-z and bytes of other letters, turns the rest into a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


@dataclass
class Phrases:
    """Distinct windows of test items, padded to WINDOW symbols, and the items of each."""

    symbols: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[object, str | None]]) -> Phrases:
        symbols: dict[bytes, int] = {}
        owners: dict[tuple, set] = defaultdict(set)
        for item_id, text in items:
            ids = [symbols.setdefault(w, len(symbols) + 1) for w in words_of(text)]
            for i in range(max(len(ids) - WINDOW, 0) + 1 if ids else 0):
                owners[tuple(ids[i : i + WINDOW])].add("" if item_id is None else str(item_id))
        windows = np.zeros((len(owners), WINDOW), np.int64)
        for row, window in zip(windows, owners, strict=True):
            row[: len(window)] = window
        lengths = np.array([len(w) for w in owners], np.int64)
        return cls(symbols, windows, lengths, [sorted(o) for o in owners.values()])


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes; symbol 0 is a separator that equals no other, earlier ones first.

    Prefix doubling: each round orders what is still tied by the ranks of the places twice as far
    on.  The last symbol must be 0.
    """
    n, zeros = len(symbols), symbols == 0
    rank = symbols + np.count_nonzero(zeros)
    rank[zeros] = np.arange(np.count_nonzero(zeros))
    order = np.argsort(rank, kind="stable")
    sorted_ = rank[order]
    first = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    tied, step = np.flatnonzero(~(first & np.append(first[1:], True))), 1
    while len(tied):
        some = order[tied]
        key = (rank[some] << 32) | rank[some + step]
        by = np.argsort(key, kind="stable")
        some, key = some[by], key[by]
        order[tied] = some
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[some] = tied[np.maximum.accumulate(np.where(first, np.arange(len(tied)), 0))]
        tied, step = tied[~(first & np.append(first[1:], True))], step * 2
    return order


class WaveletMatrix:
    """Occurrences of a symbol before a place, and the symbol at a place, for many at once."""

    def __init__(self, values: np.ndarray, most: int):
        self.levels = []
        for bit in reversed(range(max(int(most).bit_length(), 1))):
            bits = (values >> bit) & 1
            ones = np.concatenate([[0], np.cumsum(bits)]).astype(np.int32)
            zeros = len(values) - int(ones[-1])
            self.levels.append((bit, ones, zeros))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        begin = np.zeros_like(place)
        for bit, ones, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            place = np.where(one, zeros + ones[place], place - ones[place])
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
        return place - begin

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(place)
        for bit, ones, zeros in self.levels:
            one = ones[place + 1] - ones[place]
            symbol |= one.astype(np.int64) << bit
            place = np.where(one == 1, zeros + ones[place], place - ones[place])
        return symbol


class FmIndex:
    """Backward search over a shard; see the module's text."""

    def __init__(self, symbols: np.ndarray, most: int):
        order = suffix_order(symbols)
        self.last = WaveletMatrix(symbols[order - 1], most)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=most + 1))])
        self.sampled = (order % SAMPLE == 0) | (symbols[order - 1] == 0)
        self.nth = np.cumsum(self.sampled) - 1
        self.places = order[self.sampled]
        self.size = len(symbols)

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each window."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.size)
        for step in range(windows.shape[1]):
            some = np.flatnonzero((lengths > step) & (high > low))
            if not len(some):
                break
            symbol = windows[some, lengths[some] - 1 - step]
            base = self.before[symbol]
            low[some] = base + self.last.rank(symbol, low[some])
            high[some] = base + self.last.rank(symbol, high[some])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows."""
        out, steps = np.empty(len(rows), np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            done = self.sampled[rows]
            out[left[done]] = self.places[self.nth[rows[done]]] + steps
            left, rows = left[~done], rows[~done]
            symbol = self.last.access(rows)
            rows = self.before[symbol] + self.last.rank(symbol, rows)
            steps += 1
        return out


@dataclass
class Hits:
    """What a shard's documents have: number of words, hit words, byte spans, items."""

    n_words: np.ndarray
    n_hit: np.ndarray
    spans: list[list[dict]]
    items: list[list[str]]


def search_shard(texts: list[bytes], phrases: Phrases, earlier: tuple[list, list] | None = None) -> Hits:
    """Hits of a block of documents, with the spans and items of ``earlier`` passes added."""
    joined = b" ".join(texts).translate(_WORD_BYTES)
    words = joined.split()
    ids = np.fromiter(map(phrases.symbols.get, words, itertools.repeat(0)), np.int64, len(words))
    inside = np.frombuffer(joined + b" ", np.uint8) != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])  # of the documents
    first = np.searchsorted(starts, begins)  # word each document begins with
    n_words = np.diff(first)
    items = [set(i) for i in earlier[1]] if earlier else [set() for _ in texts]
    cover = np.zeros(len(words) + 1, np.int64)
    for i, spans in enumerate(earlier[0] if earlier else ()):
        for span in spans:  # words that begin within it
            a, b = np.searchsorted(starts, [begins[i] + span["start"], begins[i] + span["end"]])
            cover[a], cover[b] = cover[a] + 1, cover[b] - 1
    at, which = _occurrences(ids, first, phrases)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    hit = np.cumsum(cover)[:-1] > 0
    counted = np.concatenate([[0], np.cumsum(hit)])
    n_hit = counted[first[1:]] - counted[first[:-1]]
    owner = np.searchsorted(first, at, side="right") - 1
    for pair in np.unique(owner * max(len(phrases.items), 1) + which):
        items[pair // len(phrases.items)].update(phrases.items[pair % len(phrases.items)])
    out = [[] for _ in texts]
    for i in np.flatnonzero(n_hit):
        own = np.flatnonzero(hit[first[i] : first[i + 1]]) + first[i]
        breaks = np.flatnonzero(np.diff(own) > 1)
        for a, b in zip(own[np.append(0, breaks + 1)], own[np.append(breaks, len(own) - 1)], strict=True):
            out[i].append({"start": int(starts[a] - begins[i]), "end": int(ends[b] - begins[i])})
    return Hits(n_words, n_hit, out, [sorted(i) for i in items])


def _occurrences(ids: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word places where windows occur in a shard, and which window each is.

    ``ids`` has the words' symbols, ``first`` the word each document begins with.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.windows) or not len(ids):
        return none
    # Runs of known words, cut between documents, that are long enough for a window.
    fresh = np.ones(len(ids) + 1, bool)
    fresh[1:-1] = (ids[1:] == 0) | (ids[:-1] == 0)
    fresh[first] = True
    edges = np.flatnonzero(fresh)
    sizes = np.diff(edges)
    fits = (ids[edges[:-1]] > 0) & (sizes >= phrases.lengths.min())
    edges, sizes = edges[:-1][fits], sizes[fits]
    if not len(edges):
        return none
    stops = np.cumsum(sizes + 1)
    word = np.repeat(edges - (stops - sizes - 1), sizes + 1) + np.arange(stops[-1])
    symbols = np.append(ids, 0)[word]
    symbols[stops - 1] = 0
    index = FmIndex(symbols, len(phrases.symbols))
    low, high = index.search(phrases.windows, phrases.lengths)
    found = high - low
    which = np.repeat(np.arange(len(found)), found)
    rows = np.repeat(low - (np.cumsum(found) - found), found) + np.arange(len(which))
    return word[index.locate(rows)], which


def without(text: bytes, spans: list[dict]) -> str:
    """What is left of a text once its spans are cut out."""
    at, kept = 0, []
    for span in spans:
        kept.append(text[at : span["start"]])
        at = span["end"]
    return b"".join([*kept, text[at:]]).decode()


def _finder(phrases: Phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(pc.struct_field(batch.column("row"), "text"))
            for a, b in blocks(offsets, SHARD_BYTES):
                earlier = None
                if "spans" in batch.schema.names:
                    earlier = tuple(batch.column(n).slice(a, b - a).to_pylist() for n in ("spans", "items"))
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(a, b)]
                hits = search_shard(texts, phrases, earlier)
                left = [without(t, spans) if spans else None for t, spans in zip(texts, hits.spans, strict=True)]
                yield pa.record_batch(
                    [batch.column("row").slice(a, b - a), pa.array(hits.n_words, pa.int64()),
                     pa.array(hits.n_hit, pa.int64()),
                     pa.array(hits.spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(hits.items, pa.list_(pa.string())), pa.array(left, pa.string())],
                    names=["row", "n_words", "n_hit", "spans", "items", "left"])

    return run


def _search(rows: DataFrame, items: list[tuple]) -> DataFrame:
    schema = T.StructType([
        rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("left", T.StringType())])
    return rows.mapInArrow(tidy(_finder(Phrases.of(items))), schema)


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The test items, about ``block_bytes`` of text at a time."""
    rows = items.select("item_id", "text")
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    number = max(1, -(-size // block_bytes))
    for i in range(number):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == i
        yield [tuple(r) for r in rows.filter(own).collect()]  # about ``block_bytes``


def find(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document as a struct ``row`` with n_words, n_hit, spans (bytes of the text), items and
    left (the text without the spans, null if there are none).

    A hit word lies in an occurrence of a window; a span covers consecutive hit words.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    parts = item_blocks(items, block_bytes)
    found = rows
    for number, part in enumerate(parts):
        # A pass of its own for each block: a stage then holds the phrases of one.
        found = _search(stored(found, "decontamination") if number else found, part)
    return found


def remove_spans(found: DataFrame) -> DataFrame:
    """The documents of :func:`find` with the spans cut out of their texts; others as they are.

    Documents that consist of hit words alone go.  ``n_chars``, if there, follows the text.
    """
    columns = found.schema["row"].dataType.fieldNames()
    hit = F.col("n_hit") > 0
    changed = {
        "text": F.when(hit, F.col("left")).otherwise(F.col("row.text")),
        "n_chars": F.when(hit, F.length("left").cast("long")).otherwise(F.col("row.n_chars"))
        if "n_chars" in columns else None,
    }
    kept = found.filter("n_hit = 0 or n_hit < n_words")
    return kept.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns))
