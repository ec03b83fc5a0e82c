"""Removal of repeated passages by suffix arrays, sorted bucket by bucket with a difference cover.

A byte goes if it lies in a string of ``length`` bytes that also starts in a text with a smaller
id.  Strings are judged on the input, within one text each.

1. Equal texts are one text with its smallest id; of the others nothing stays.  The distinct texts
   are dealt to blocks by digest, which is the only time they are shuffled.
2. Every window of ``length`` bytes has an anchor: of the GRAM-byte strings in it the one with the
   smallest hash.  Equal windows have equal anchors, so the suffixes that may match meet in one
   suffix bucket if a window goes where its anchor's hash says.  Consecutive windows with the same
   anchor form a segment.  First only anchor hashes are exchanged: a segment whose anchor no other
   text has cannot match and is not sent.
3. A task sorts one suffix bucket at a time.  Segments that are equal throughout are merged; the
   suffixes of those left are sorted by their first COVER bytes, and longer ties are resolved by
   the ranks of a precomputed sample: positions whose number modulo COVER is in a difference
   cover.  Any two suffixes reach sample positions at one common distance below COVER, so one
   comparison of ranks settles them.  Neighbours in that order with ``length`` equal bytes are
   matches, and all but those of the smallest id are removed.
4. Spans go back to their blocks, where the texts still lie, and become counts and digests.

A task holds one block (``block_bytes``) or one part of a suffix bucket (PART segments, or the
distinct segments of one anchor if they are more).  Equal segments of a block are merged before
they are sent, so a passage that a third of all texts share is sent once a block.

Edge cases: a null text counts as empty; texts shorter than ``length`` keep everything; a null id
counts as the largest; rows that repeat an id, with equal or other texts, remove nothing from each
other; all rows are returned; a text beyond a block's size is a block of its own, which one task
holds; no rows give no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import (
    from40, give_back, join_groups, low40, mix, own_group, partitions_for, powers, runs, stored, text_buffer,
)

LENGTH = 50
GRAM = 20
COVER = 32
ROW = 128  # bytes a segment is laid out in; its text is at most 2 * LENGTH - GRAM long
PART = 100_000
HASH_BYTES = 1 << 19
LAST_ID = 2**63 - 1
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1000))


def difference_cover(v: int) -> list[int]:
    """A small set of residues whose differences are all residues modulo ``v``."""
    cover, missing = [0], set(range(1, v))
    while missing:
        def gain(x):
            return len(missing & {d % v for c in cover for d in (x - c, c - x)})

        best = max(range(v), key=lambda x: (gain(x), -x))
        cover.append(best)
        missing -= {d % v for c in cover for d in (best - c, c - best)}
    return sorted(cover)


class CoverOrder:
    """Sorts suffixes of rows of bytes (ROW each, zeros after the end) to a depth of 2 * COVER.

    ``rank`` has the rank of every sample position among all by their next 2 * COVER bytes.
    """

    cover = difference_cover(COVER)
    # Distance from suffixes at phases a and b to sample positions, the same for both.
    distance = np.array([[next(d for d in range(COVER) if (a + d) % COVER in s and (b + d) % COVER in s)
                          for b in range(COVER)] for a in range(COVER) for s in [set(difference_cover(COVER))]])

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.flat = rows.reshape(-1)
        columns = np.array([c for c in range(ROW - COVER) if c % COVER in self.cover])
        self.slot = np.full(ROW, -1)
        self.slot[columns] = np.arange(len(columns))
        self.width = len(columns)
        places = (np.arange(len(rows))[:, None] * ROW + columns).ravel()
        half = self._dense(self.words(places, COVER // 8))
        # Doubling: positions COVER further on are sample positions too.
        on = np.zeros(len(half), np.int64)
        further = columns + COVER < ROW - COVER
        grid = half.reshape(len(rows), -1)
        on.reshape(len(rows), -1)[:, further] = grid[:, self.slot[columns[further] + COVER]]
        self.rank = self._dense([half, on])

    def words(self, places: np.ndarray, count: int) -> list[np.ndarray]:
        """The next 8 * count bytes of each place, as numbers in the order of the bytes."""
        out = []
        for w in range(count):
            word = np.zeros(len(places), np.uint64)
            for i in range(8):
                word = (word << np.uint64(8)) | self.flat[places + 8 * w + i].astype(np.uint64)
            out.append(word)
        return out

    @staticmethod
    def _dense(keys: list[np.ndarray]) -> np.ndarray:
        order = np.lexsort(keys[::-1])
        fresh = np.zeros(len(order), bool)
        for key in keys:
            fresh[1:] |= key[order[1:]] != key[order[:-1]]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(fresh)
        return out

    def _sample(self, places: np.ndarray) -> np.ndarray:
        return self.rank[places // ROW * self.width + self.slot[places % ROW]]

    def sort(self, places: np.ndarray) -> np.ndarray:
        """Places in the order of their suffixes.

        Ties of COVER bytes are split by a pivot each: its elements compare with the pivot by the
        ranks at their common distance, all groups of a round at once.
        """
        keys = self.words(places, COVER // 8)
        order = np.lexsort(keys[::-1])
        places = places[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = False
        for key in keys:
            fresh[1:] |= key[order[1:]] != key[order[:-1]]
        group = np.cumsum(fresh) - 1
        left = np.flatnonzero(np.bincount(group)[group] > 1)
        while len(left):
            own, at = places[left], group[left]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            sizes = np.diff(np.append(first, len(at)))
            pivot = np.repeat(own[first + sizes // 2], sizes)
            d = self.distance[own % COVER, pivot % COVER]
            sign = np.sign(self._sample(own + d) - self._sample(pivot + d))
            by = np.lexsort((sign, at))
            places[left] = own[by]
            sign = sign[by]
            fresh = np.append(True, (at[1:] != at[:-1]) | (sign[1:] != sign[:-1]))
            # Those equal to their pivot are settled, and so are groups of one.
            first = np.flatnonzero(fresh)
            sizes = np.diff(np.append(first, len(at)))
            group[left] = np.repeat(left[first], sizes)
            left = left[(np.repeat(sizes, sizes) > 1) & (sign != 0)]
        return places


class Segments:
    """Segments of texts: parallel arrays, and their bytes one after another."""

    fields = (("own", np.uint32), ("doc", np.int64), ("start", np.uint32), ("size", np.uint8),
              ("shift", np.uint8), ("anchor", np.uint64))

    def __init__(self, data: np.ndarray, at: np.ndarray, **arrays: np.ndarray):
        self.data, self.at = data, at
        for name, kind in self.fields:
            setattr(self, name, arrays[name].astype(kind, copy=False))

    def __len__(self) -> int:
        return len(self.own)

    def take(self, some: np.ndarray) -> Segments:
        return Segments(self.data, self.at[some], **{n: getattr(self, n)[some] for n, _ in self.fields})

    def rows(self) -> np.ndarray:
        """Bytes of each segment in a row of its own, zeros after the end."""
        place = np.arange(2 * LENGTH - GRAM)
        inside = place < self.size[:, None]
        out = np.zeros((len(self), ROW), np.uint8)
        out[:, : len(place)] = np.where(inside, self.data[np.minimum(self.at[:, None] + place, len(self.data) - 1)], 0)
        return out

    def pack(self) -> tuple[bytes, ...]:
        """The arrays as bytes, in the order of ``fields``, and the text."""
        text = self.data[np.repeat(self.at - (np.cumsum(self.size, dtype=np.int64) - self.size), self.size)
                         + np.arange(int(self.size.sum(dtype=np.int64)))]
        return *(getattr(self, n).tobytes() for n, _ in self.fields), text.tobytes()

    @classmethod
    def unpack(cls, packed: list[tuple[bytes, ...]]) -> Segments:
        arrays = {n: np.concatenate([np.frombuffer(p[i], t) for p in packed]) for i, (n, t) in enumerate(cls.fields)}
        data = np.concatenate([np.frombuffer(p[-1], np.uint8) for p in packed])
        sizes = arrays["size"].astype(np.int64)
        return cls(data, np.cumsum(sizes) - sizes, **arrays)


def merge_equal(segments: Segments) -> tuple[np.ndarray, np.ndarray]:
    """For each segment the place of an equal one with the smallest id, and those places.

    Equal means the same bytes around the same anchor at the same place.
    """
    rows = segments.rows()[:, : 2 * LENGTH - GRAM]
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    keys = [segments.anchor, segments.shift, segments.size, *words.T]
    order = np.lexsort([segments.doc, *keys[::-1]])
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    first = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    least = np.empty(len(order), np.int64)
    least[order] = first
    return least, order[fresh]


def repeated_windows(segments: Segments) -> list[np.ndarray]:
    """For each of distinct segments, sorted by anchor, which windows a smaller id has too."""
    if not len(segments):
        return []
    counts = segments.size.astype(np.int64) - LENGTH + 1
    owner = np.repeat(np.arange(len(segments)), counts)
    column = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    hit = np.zeros(len(owner), bool)
    order = CoverOrder(segments.rows())
    places = order.sort(owner * ROW + column)
    index = (np.cumsum(counts) - counts)[places // ROW] + places % ROW
    same = np.ones(max(len(places) - 1, 0), bool)
    tail = np.uint64(2**64 - 2 ** (64 - 8 * (LENGTH % 8))) if LENGTH % 8 else np.uint64(2**64 - 1)
    words = order.words(places, -(-LENGTH // 8))
    words[-1] = words[-1] & tail
    for word in words:
        same &= word[1:] == word[:-1]
    run = np.flatnonzero(np.append(True, ~same))
    docs = segments.doc[places // ROW]
    least = np.repeat(np.minimum.reduceat(docs, run), np.diff(np.append(run, len(docs))))
    hit[index] = docs > least
    return np.split(hit, np.cumsum(counts)[:-1])


def spans_of(segments: Segments) -> np.ndarray:
    """Rows (own, start, end) of bytes to remove, of all segments of some anchors."""
    out = []
    order = np.argsort(segments.anchor, kind="stable")
    ends = runs(segments.anchor[order])[1]
    begin = 0
    while begin < len(order):  # whole anchors, about PART segments at a time
        end = int(ends[min(np.searchsorted(ends, begin + PART), len(ends) - 1)])
        part = segments.take(order[begin:end])
        begin = end
        least, distinct = merge_equal(part)
        later = part.doc > part.doc[least]
        out.append((part.own[later], part.start[later], part.start[later] + part.size[later]))
        # Anchors with one segment alone have no more to compare.
        anchors = part.anchor[distinct]
        several = np.ones(len(distinct), bool)
        several[1:] = anchors[1:] == anchors[:-1]
        several[:-1] |= several[1:]
        if len(distinct):
            several[0] = len(distinct) > 1 and anchors[0] == anchors[1]
        open_ = distinct[several]
        hits = repeated_windows(part.take(open_))
        members: dict[int, list[int]] = {}
        wanted = set(open_[[bool(h.any()) for h in hits]].tolist()) if len(open_) else set()
        for j in np.flatnonzero(~later & np.isin(least, list(wanted))) if wanted else ():
            members.setdefault(int(least[j]), []).append(int(j))
        for i, hit in zip(open_.tolist(), hits, strict=True):
            if i not in wanted:
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            for a, b in zip(edge[0::2], edge[1::2], strict=True):
                for j in members[i]:
                    out.append(([part.own[j]], [part.start[j] + a], [part.start[j] + b - 1 + LENGTH]))
    if not out:
        return np.zeros((0, 3), np.int64)
    return np.stack([np.concatenate([np.asarray(o[i], np.int64) for o in out]) for i in range(3)], axis=1)


def find_segments(data: np.ndarray, offsets: np.ndarray, docs: np.ndarray) -> Segments:
    """All segments of a block of texts."""
    found = {n: [] for n in ("own", "start", "size", "shift", "anchor", "at")}
    reach = LENGTH - GRAM + 1  # anchors to choose from in a window
    begin = 0
    total = int(offsets[-1])
    while begin + LENGTH <= total:
        part = data[begin : begin + HASH_BYTES + LENGTH - 1]
        with np.errstate(over="ignore"):
            power, back = (powers(b, HASH_BYTES + LENGTH) for b in (_BASE, _INVERSE))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * power[: len(part)])])
            grams = mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(part) - GRAM + 1])
        low = np.uint64((1 << 20) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < reach:
            least = np.minimum(least[: len(least) - (reach - span)], least[reach - span :])
        anchor = (least & low).astype(np.int64)
        start = np.arange(len(anchor)) + begin
        own = np.searchsorted(offsets, start, side="right") - 1
        valid = start + LENGTH <= offsets[own + 1]
        change = np.append(True, (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1]) | ~valid[:-1]) & valid
        first = np.flatnonzero(change)
        # A segment ends where the next begins or where windows stop being valid.
        stop = np.flatnonzero(np.append(change[1:] | ~valid[1:], True) & valid)
        found["own"].append(own[first])
        found["start"].append(start[first] - offsets[own[first]])
        found["size"].append(stop - first + LENGTH)
        found["shift"].append(anchor[first] - first)
        found["anchor"].append(grams[anchor[first]])
        found["at"].append(start[first])
        begin += len(anchor)
    arrays = {n: np.concatenate([np.zeros(0, np.uint64 if n == "anchor" else np.int64), *v]) for n, v in found.items()}
    at = arrays.pop("at").astype(np.int64)
    own = arrays["own"].astype(np.int64)
    return Segments(data, at, doc=docs[own] if len(own) else np.zeros(0, np.int64), **arrays)


class Block:
    """The distinct texts of a block, in the order of their digests."""

    def __init__(self, rows: pa.Table):
        docs = rows.column("least").to_numpy()
        digests = np.array(rows.column("sha").to_pylist())
        order = np.lexsort([docs, digests])
        order = order[np.append(True, digests[order][1:] != digests[order][:-1])[: len(order)]]
        texts = rows.column("text").take(pa.array(order))
        self.docs, self.digests = docs[order], digests[order]
        self.data, self.offsets = text_buffer(texts)

    def segments(self) -> Segments:
        return find_segments(self.data, self.offsets, self.docs)


def _least_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct text of a batch once, with its smallest id."""
    for batch in batches:
        docs, digests = batch.column("least").to_numpy(), np.array(batch.column("sha").to_pylist())
        order = np.lexsort([docs, digests])
        order = order[np.append(True, digests[order][1:] != digests[order][:-1])[: len(order)]]
        yield batch if len(order) == len(docs) else batch.take(pa.array(np.sort(order)))


def _short(anchors: np.ndarray, bits: int) -> np.ndarray:
    """Anchors as they are exchanged: the bucket's bits, then the lowest 40."""
    return (anchors >> np.uint64(64 - bits)) << np.uint64(40) | anchors & np.uint64((1 << 40) - 1)


def _by_bucket(anchors: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs (bucket, first, end) of sorted anchors."""
    buckets = anchors >> np.uint64(40)
    for a, b in zip(*runs(buckets), strict=True):
        yield int(buckets[a]), int(a), int(b)


def _table(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


ANCHORS = [("bucket", pa.int32()), ("block", pa.int64()), ("anchors", pa.binary())]
SEGMENTS = [("bucket", pa.int32()), ("block", pa.int64()), *((n, pa.binary()) for n, _ in Segments.fields), ("text", pa.binary())]
SPANS = [("block", pa.int64()), ("spans", pa.binary())]
RESULTS = [("sha", pa.string()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]


def _anchors(bits: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        found = np.unique(_short(Block(rows).segments().anchor, bits))
        block = key[0].as_py()
        return _table([(bucket, block, low40(found[a:b])) for bucket, a, b in _by_bucket(found)], ANCHORS)

    return run


def _meet(key: tuple, rows: pa.Table) -> pa.Table:
    """To each block those of its anchors that another block has too."""
    bucket, out = key[0].as_py(), []
    high = np.uint64(bucket) << np.uint64(40)
    anchors = [from40(a) | high for a in rows.column("anchors").to_pylist()]
    every = np.sort(np.concatenate(anchors))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    for block, own in zip(rows.column("block").to_pylist(), anchors, strict=True):
        own = own[np.isin(own, shared, assume_unique=True)]
        if len(own):
            out.append((bucket, block, low40(own)))
    return _table(out, ANCHORS)


def _send(bits: int):
    def run(key: tuple, rows: pa.Table, shared: pa.Table) -> pa.Table:
        """Segments whose anchor another text has; those equal within the block only once."""
        if not len(rows):
            return _table([], SEGMENTS)
        block, segments = key[0].as_py(), Block(rows).segments()
        told = [from40(a) | np.uint64(b) << np.uint64(40) for b, a in zip(shared.column("bucket").to_pylist(), shared.column("anchors").to_pylist(), strict=True)]
        anchors = _short(segments.anchor, bits)
        order = np.lexsort([segments.own, anchors])
        a, o = anchors[order], segments.own[order]
        local = a[1:][(a[1:] == a[:-1]) & (o[1:] != o[:-1])]
        known = np.unique(np.concatenate([local, *told]))
        segments = segments.take(np.flatnonzero(np.isin(anchors, known)))
        segments.anchor = _short(segments.anchor, bits)
        least, distinct = merge_equal(segments)
        later = segments.doc > segments.doc[least]
        spans = np.stack([segments.own[later], segments.start[later],
                          segments.start[later].astype(np.int64) + segments.size[later]], axis=1).astype("<i8")
        nothing = (None,) * (len(SEGMENTS) - 3)
        out = [(own_group(block), block, spans.tobytes(), *nothing)]
        rest = segments.take(np.flatnonzero(~later))
        rest = rest.take(np.argsort(rest.anchor, kind="stable"))
        for bucket, a, b in _by_bucket(rest.anchor):
            out.append((bucket, block, *rest.take(np.arange(a, b)).pack()))
        return _table(out, SEGMENTS)

    return run


def _sort_bucket(key: tuple, rows: pa.Table) -> pa.Table:
    """Spans to remove, by block, of one suffix bucket."""
    give_back()  # what the bucket before took
    names = [n for n, _ in SEGMENTS]
    blocks = rows.column("block").to_pylist()
    if key[0].as_py() < 0:
        return _table(list(zip(blocks, rows.column("own").to_pylist(), strict=True)), SPANS)
    columns = [rows.column(n).to_pylist() for n in names[2:]]
    segments = Segments.unpack(list(zip(*columns, strict=True)))
    # Numbers that tell the places of all blocks apart.
    sizes = [len(own) // 4 for own in columns[0]]
    which = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    place, segments.own = segments.own, np.arange(len(segments), dtype=np.uint32)
    spans = spans_of(segments)
    source = which[spans[:, 0]]
    order = np.argsort(source, kind="stable")
    spans, source = spans[order], source[order]
    spans[:, 0] = place[spans[:, 0]]
    return _table([(blocks[source[a]], spans[a:b].astype("<i8").tobytes())
                   for a, b in zip(*runs(source), strict=True)], SPANS)


def _cut(with_text: bool):
    def run(key: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        give_back()  # what the block before took
        if not len(rows):
            return _table([], RESULTS)
        block = Block(rows)
        spans = np.concatenate([np.zeros((0, 3), np.int64), *(
            np.frombuffer(s, "<i8").reshape(-1, 3) for s in found.column("spans").to_pylist())])
        cover = np.zeros(len(block.data) + 1, np.int32)
        base = block.offsets[spans[:, 0]]
        np.add.at(cover, base + spans[:, 1], 1)
        np.add.at(cover, base + spans[:, 2], -1)
        gone = np.cumsum(cover)[:-1] > 0
        out = []
        for i, digest in enumerate(block.digests.tolist()):
            a, b = block.offsets[i], block.offsets[i + 1]
            own = gone[a:b]
            removed = int(np.count_nonzero(own))
            edges = np.count_nonzero(own[1:] & ~own[:-1]) + int(removed > 0 and own[0])
            kept = block.data[a:b][~own].tobytes() if removed or with_text else None
            out.append((digest, removed, edges, hashlib.sha256(kept).hexdigest() if removed else digest,
                        kept.decode("utf-8", "replace") if with_text else None))
        return _table(out, RESULTS)

    return run


def _schema(fields: list[tuple[str, pa.DataType]]) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{n} {names[t]}" for n, t in fields)


def remove_repeats(docs: DataFrame, block_bytes: int = 8 << 20, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the text left) of every row."""
    parts = partitions_for(docs)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("least"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, -(-total // block_bytes))
    bits = max(4, math.ceil(math.log2(8 * parts)))
    texts = rows.select(F.pmod(F.xxhash64("sha"), F.lit(number)).alias("block"), "least", "sha", "text").mapInArrow(
        _least_of_batch, "block long, least long, sha string, text string")
    by_block = texts.groupBy("block")
    shared = by_block.applyInArrow(_anchors(bits), _schema(ANCHORS)).groupBy("bucket").applyInArrow(_meet, _schema(ANCHORS))
    segments = by_block.cogroup(shared.groupBy("block")).applyInArrow(_send(bits), _schema(SEGMENTS))
    spans = segments.groupBy("bucket").applyInArrow(_sort_bucket, _schema(SPANS))
    found = by_block.cogroup(spans.groupBy("block")).applyInArrow(_cut(with_text), _schema(RESULTS))
    # Only ids, sizes and digests of the rows are left to be joined.
    plain = rows.select("doc_id", "least", "n_bytes", "sha")
    first = plain.groupBy("sha").agg(F.min("least").alias("first"), F.count("*").alias("times"))
    copy = (F.col("least") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    columns = [
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, EMPTY_SHA).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(copy, "").otherwise(F.col("kept")).alias("kept"))
        return plain.join(first.join(found, "sha"), "sha").select(*columns)
    groups = stored(first.join(found.drop("kept"), "sha"), "removed")
    once = plain.groupBy(*plain.columns).agg(F.count("*").cast("int").alias("again"))
    joined = join_groups(once, groups, "sha", "times")
    return joined.select(*columns, F.explode(F.sequence(F.lit(1), F.col("again")))).drop("col")
