"""Near-duplicate documents: exact Jaccard join of word shingles through signature trees.

1. Each text becomes its set of distinct 64-bit shingle hashes.  Texts of equal sets are one class.
2. Shingles are dealt to buckets by hash, a block of documents at a time, and counted.  Of a set
   only shingles that another set has too can be part of an overlap, so only those go back to
   their document, rarest first.
3. Two sets that overlap enough share a shingle among the rarest of each (as many as may miss,
   plus one).  Sets without a shared one there are done.  The others are candidates; those that
   share such a shingle, directly or through others, form a candidate group.
4. Within a group the sets are leaves of a signature tree.  A node holds the OR of its sets'
   bitmaps and the range of their sizes, which bound the overlap of any set below it with any set
   below another node.  The tree is joined with itself: pairs of nodes whose bound is too small
   are left out, and so are pairs that are known to be connected already; what remains is compared
   exactly.  Of a group of many near copies about one comparison a copy is made.
5. A group of more than CHUNK sets does not go to one task.  Its sets are first compared with the
   group's smallest one.  Those linked with it are connected, and need not meet each other; in a
   group of near copies that is nearly all of them.  The others meet in one of two ways, whichever
   sends fewer sets: where they share one of their rarest shingles (see 3), each of these a group
   of its own, so a set is sent once for each; or in chunks, every two of which meet, and every one
   with each chunk of those linked.  Chained groups go the first way, however large, and what is
   sent grows with their size alone.  Only sets that share one single rare shingle, more than CHUNK
   of them and not linked with the first one, are left to meet chunk by chunk.

Shuffled are packed arrays, not rows per shingle.  A hot shingle weighs 7 bytes in its bucket for
each document that has it (and copies within a block count once).  Hashes stand for shingles and
classes: for two different ones to be taken for the same has a chance of about 1 in 2^64 a pair.

Blocks are runs of an input partition's rows, so a task that is run again must meet the same rows in
the same order: documents should come from a stored table, as between the stages of a pipeline.

Edge cases: null and empty texts, and texts of white space, have empty sets and link with nothing;
fewer words than a shingle are one shingle; repeated rows are one class and are all returned; a
null id takes part but names no component unless the component has no other; a text beyond a block's
size is hashed in parts, and its set, eight bytes a shingle, is held by one task; no rows give no rows.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import (
    blocks,
    from56,
    join_groups,
    low56,
    mix,
    one_row_each,
    own_group,
    partitions_for,
    pieces,
    powers,
    row_key,
    runs,
    stored,
    text_buffer,
    tidy,
)
from driftlake.llm.graph import components

BLOCK_BYTES = 8 << 20
HASH_BYTES = 1 << 20
BITS = 2048
LEAF = 16
FAN_OUT = 4
CHUNK = 2048
PAYLOAD_SCHEMA = "bucket int, block long, docs binary, own binary, hashes binary"
SHARED_SCHEMA = "block long, docs binary, own binary, hashes binary, frequency binary"
SETS_SCHEMA = "class long, n long, prefix int, shared binary"
EDGE_SCHEMA = "a long, b long"

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


_BYTE = mix(np.arange(256, dtype=np.uint64))


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a run of texts, and the number of words of each text."""
    inside = ~_SPACE[data]
    fresh, last = inside.copy(), inside.copy()
    fresh[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    fresh[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    # One pair of tables serves all parts of ordinary size.
    n = HASH_BYTES if len(data) < HASH_BYTES else len(data)
    power = powers(_BASE, n + 1)[: len(data) + 1]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[data]] * power[:-1])])
    back = powers(_INVERSE, n + 1)
    words = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return words, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    out = []
    with np.errstate(over="ignore"):
        for a, b in blocks(offsets, HASH_BYTES):
            part = data[offsets[a] : offsets[b]]
            if not len(part):
                out += [np.zeros(0, np.uint64)] * (b - a)
                continue
            if b - a == 1:
                found = [_word_hashes(p, np.array([0, len(p)])) for p in pieces(part, HASH_BYTES)]
                words = np.concatenate([f[0] for f in found])
                counts = np.array([len(words)])
            else:
                words, counts = _word_hashes(part, offsets[a : b + 1] - offsets[a])
            rolled = np.zeros(max(len(words) - k + 1, 0), np.uint64)
            for j in range(k if len(rolled) else 0):
                rolled += words[j : j + len(rolled)] * factors[j]
            rolled = mix(rolled)
            at = 0
            for n in counts.tolist():
                if n >= k:
                    found = np.sort(rolled[at : at + n - k + 1])
                    out.append(found[np.append(True, found[1:] != found[:-1])])
                elif n:
                    out.append(mix(np.sum(words[at : at + n] * factors[:n], keepdims=True) + np.uint64(n)))
                else:
                    out.append(np.zeros(0, np.uint64))
                at += n
    return out


def class_of(hashes: np.ndarray) -> int:
    """Identity of a set, as a signed 64-bit number."""
    with np.errstate(over="ignore"):
        total = mix(np.array([np.sum(mix(hashes), dtype=np.uint64) + np.uint64(len(hashes))]))
    return int(total.view(np.int64)[0])


def least_overlap(n: int, threshold: tuple[int, int]) -> int:
    """Shingles that a set of ``n`` shares at least with any set it links with."""
    return -(-threshold[0] * n // threshold[1])


def _profile(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(*text_buffer(batch.column("text")), k)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("digest"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_of(s) for s in sets], pa.int64())],
                names=["doc_id", "digest", "n_shingles", "class"])

    return run


def _deal(k: int, bucket_bits: int):
    """Shingles of each block, by bucket: the document's place in the block, and of the hash what
    the bucket, which is its first ``bucket_bits`` (8 or more), does not say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in blocks(offsets, BLOCK_BYTES):
                sets = {class_of(s): s for s in shingle_sets(
                    data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k) if len(s)}
                if not sets:
                    continue
                classes = np.fromiter(sets, np.int64, len(sets))
                sizes = np.array([len(s) for s in sets.values()], np.int64)
                hashes = np.concatenate(list(sets.values()))
                own = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
                order = np.arange(len(classes), dtype=np.uint64)
                count += 1
                place = np.uint64(TaskContext.get().partitionId() << 24 | count)
                block = class_of(np.append(mix(classes.view(np.uint64)) + order, mix(np.array([place]))))
                bucket = (hashes >> np.uint64(64 - bucket_bits)).astype(np.uint32 if bucket_bits > 16 else np.uint16)
                order = np.argsort(bucket, kind="stable")
                bucket, hashes, own = bucket[order], hashes[order], own[order]
                rows = [(own_group(block), block, classes.tobytes() + sizes.tobytes(), None, None)]
                for x, y in zip(*runs(bucket), strict=True):
                    rows.append((int(bucket[x]), block, None, own[x:y].tobytes(), low56(hashes[x:y])))
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["bucket", "block", "docs", "own", "hashes"])

    return run


def _count(bucket_bits: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        return _shared(key, rows, bucket_bits)

    return run


def _shared(key: tuple, rows: pa.Table, bucket_bits: int) -> pa.Table:
    """Of a bucket's shingles those of two documents or more, with how frequent they are."""
    names = ["block", "docs", "own", "hashes", "frequency"]
    if key[0].as_py() < 0:
        return rows.select(names[:4]).append_column("frequency", pa.nulls(len(rows), pa.binary()))
    hashes = [from56(h) for h in rows.column("hashes").to_pylist()]
    every = np.sort(np.concatenate(hashes))
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    counts = np.diff(np.append(first, len(every)))
    shared, counts = every[first][counts > 1], counts[counts > 1]
    # Any function of the shingle may order a prefix; an eighth of an octave is fine enough.
    steps = np.minimum(np.floor(8 * np.log2(counts)), 255).astype(np.uint8)
    out = []
    for block, own, some in zip(rows.column("block").to_pylist(), rows.column("own").to_pylist(), hashes, strict=True):
        at = np.minimum(np.searchsorted(shared, some), max(len(shared) - 1, 0))
        hit = np.flatnonzero(shared[at] == some) if len(shared) else np.zeros(0, np.int64)
        if len(hit):
            whole = some[hit] | np.uint64(key[0].as_py()) << np.uint64(64 - bucket_bits)
            out.append((block, None, np.frombuffer(own, np.uint32)[hit].tobytes(), whole.tobytes(), steps[at[hit]].tobytes()))
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*out, strict=True)) or [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _candidates(threshold: tuple[int, int]):
    def run(rows: pa.Table) -> pa.Table:
        """Sets of a block whose rarest shingles include a shared one, rarest shingles first."""
        names, out = ["class", "n", "prefix", "shared"], []
        table = rows.to_pydict()
        parts = [i for i, d in enumerate(table["docs"]) if d is None]
        docs = next((d for d in table["docs"] if d is not None), None)
        if parts:
            whole = np.frombuffer(docs, np.int64)
            classes, sizes = whole[: len(whole) // 2], whole[len(whole) // 2 :]
            own = np.concatenate([np.frombuffer(table["own"][i], np.uint32) for i in parts])
            shared = np.concatenate([np.frombuffer(table["hashes"][i], np.uint64) for i in parts])
            steps = np.concatenate([np.frombuffer(table["frequency"][i], np.uint8) for i in parts])
            have = np.bincount(own, minlength=len(classes))
            need = -(-threshold[0] * sizes // threshold[1])
            prefix = np.maximum(have - need + 1, 0)  # rarest shingles less those nobody shares
            keep = prefix[own] > 0
            own, shared, steps = own[keep], shared[keep], steps[keep]
            order = np.lexsort((shared, steps, own))
            own, shared = own[order], shared[order]
            for a, b in zip(*runs(own), strict=True):
                i = own[a]
                out.append((classes[i], sizes[i], prefix[i], shared[a:b].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def _deal_prefixes(bucket_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.frombuffer(s, np.uint64)[:p] for s, p in zip(
                batch.column("shared").to_pylist(), batch.column("prefix").to_pylist(), strict=True)]
            if not keys:
                continue  # an empty batch
            own = np.repeat(np.asarray(batch.column("class").to_numpy()), [len(k) for k in keys])
            keys = np.concatenate(keys)
            bucket = mix(keys) >> np.uint64(64 - bucket_bits)
            order = np.argsort(bucket, kind="stable")
            bucket, keys, own = bucket[order], keys[order], own[order]
            rows = [(int(bucket[x]), keys[x:y].tobytes(), own[x:y].tobytes())
                    for x, y in zip(*runs(bucket), strict=True)]
            kinds = (pa.int32(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                  names=["bucket", "keys", "classes"])

    return run


def _stars(rows: pa.Table) -> pa.Table:
    """Edges from each class with a prefix shingle to the smallest class with it."""
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in rows.column("keys").to_pylist()])
    classes = np.concatenate([np.frombuffer(c, np.int64) for c in rows.column("classes").to_pylist()])
    order = np.argsort(keys, kind="stable")
    keys, classes = keys[order], classes[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    least = np.repeat(np.minimum.reduceat(classes, first), np.diff(np.append(first, len(keys))))
    edges = np.unique(np.stack([classes, least], axis=1)[classes != least], axis=0)
    return pa.table([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])


class SignatureTree:
    """Sets under nodes that hold OR-ed bitmaps and size ranges; joined with itself or another.

    ``sizes`` are those of the whole sets, ``sets`` the sorted shingles that others share; sets
    that are ``joined`` are known to be connected with each other.
    """

    def __init__(
        self, classes: list[int], sizes: list[int], sets: list[np.ndarray], threshold: tuple[int, int],
        joined: list[bool] | None = None,
    ):
        order = sorted(range(len(sets)), key=lambda i: (sizes[i], int(sets[i][0]) if len(sets[i]) else 0))
        self.classes = [classes[i] for i in order]
        self.sets = [sets[i] for i in order]
        self.sizes = np.array([sizes[i] for i in order], np.int64)
        self.threshold = threshold
        bits = np.zeros((len(sets), BITS), bool)
        for row, s in zip(bits, self.sets, strict=True):
            row[(s % np.uint64(BITS)).astype(np.int64)] = True
        self.bits = np.packbits(bits, axis=1).view(np.uint64)
        ones = bits.sum(axis=1)
        # Shingles beyond the first of a bit: a common bit may stand for that many more.
        self.excess = np.array([len(s) for s in self.sets]) - ones
        self.labels = np.arange(len(sets))
        if joined is not None:
            known = np.array([joined[i] for i in order], bool)
            self.labels[known] = np.flatnonzero(known)[:1] if known.any() else 0
        self.nodes: dict[tuple[int, int], tuple] = {}

    def node(self, a: int, b: int) -> tuple:
        """OR of the bitmaps, smallest and largest size, largest excess of the sets a .. b - 1."""
        found = self.nodes.get((a, b))
        if found is None:
            if b - a <= LEAF:
                found = (np.bitwise_or.reduce(self.bits[a:b], axis=0), int(self.sizes[a:b].min()),
                         int(self.sizes[a:b].max()), int(self.excess[a:b].max()))
            else:
                below = [self.node(x, y) for x, y in self.children(a, b)]
                found = (np.bitwise_or.reduce([n[0] for n in below], axis=0), min(n[1] for n in below),
                         max(n[2] for n in below), max(n[3] for n in below))
            self.nodes[a, b] = found
        return found

    @staticmethod
    def children(a: int, b: int) -> list[tuple[int, int]]:
        step = max(LEAF, -(-(b - a) // FAN_OUT))
        return [(x, min(x + step, b)) for x in range(a, b, step)]

    def apart(self, x: tuple, y: tuple) -> bool:
        """Whether no set below one node can overlap enough with any below the other."""
        p, q = self.threshold
        if x[2] * q < p * y[1] or y[2] * q < p * x[1]:
            return True
        common = int(np.bitwise_count(x[0] & y[0]).sum()) + min(x[3], y[3])
        return common * (p + q) < p * (x[1] + y[1])

    def linked(self, i: int, j: int) -> bool:
        p, q = self.threshold
        common = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        return q * common >= p * int(self.sizes[i] + self.sizes[j] - common)

    def _pairs(self, i: int, a: int, b: int) -> None:
        """Compare one set with the sets a .. b - 1 that it isn't connected with."""
        p, q = self.threshold
        some = np.arange(a, b)[self.labels[a:b] != self.labels[i]]
        n, m = int(self.sizes[i]), self.sizes[some]
        common = np.bitwise_count(self.bits[some] & self.bits[i]).sum(axis=1) + np.minimum(self.excess[some], self.excess[i])
        for j in some[(common * (p + q) >= p * (n + m)) & (m * q >= p * n) & (n * q >= p * m)]:
            if self.labels[i] != self.labels[j] and self.linked(i, j):
                self.labels[self.labels == self.labels[j]] = self.labels[i]

    def _one_label(self, a: int, b: int) -> int:
        """The label of all sets a .. b - 1, or -1 if they differ."""
        own = self.labels[a:b]
        return int(own[0]) if (own == own[0]).all() else -1

    def join_self(self, a: int = 0, b: int | None = None) -> None:
        b = len(self.sets) if b is None else b
        if b - a <= LEAF:
            for i in range(a + 1, b):
                self._pairs(i, a, i)
            return
        below = self.children(a, b)
        for child in below:
            self.join_self(*child)
        for k, child in enumerate(below):
            for other in below[k + 1 :]:
                self.join(child, other)

    def join(self, x: tuple[int, int], y: tuple[int, int]) -> None:
        label = self._one_label(*x)
        if label >= 0 and label == self._one_label(*y):
            return
        if self.apart(self.node(*x), self.node(*y)):
            return
        if x[1] - x[0] <= LEAF and y[1] - y[0] <= LEAF:
            for i in range(*x):
                self._pairs(i, *y)
        elif x[1] - x[0] >= y[1] - y[0]:
            for child in self.children(*x):
                self.join(child, y)
        else:
            for child in self.children(*y):
                self.join(x, child)


def _join_groups(threshold: tuple[int, int]):
    """Trees of the groups of a partition, sorted by group; edges to the first set of a component."""

    def solve(rows: list[tuple]) -> list[tuple[int, int]]:
        distinct = {r[0]: r for r in rows}
        tree = SignatureTree(list(distinct), [r[1] for r in distinct.values()],
                             [np.sort(np.frombuffer(r[2], np.uint64)) for r in distinct.values()],
                             threshold, [r[3] for r in distinct.values()])
        tree.join_self()
        first: dict[int, int] = {}
        edges = []
        for label, own in zip(tree.labels.tolist(), tree.classes, strict=True):
            root = first.setdefault(label, own)
            if root != own:
                edges.append((own, root))
        return edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, edges = None, [], []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("part", "class", "n", "shared", "near")]
            for part, *row in zip(*columns, strict=True):
                if part != current:
                    if len(rows) > 1:
                        edges += solve(rows)
                    current, rows = part, []
                rows.append(tuple(row))
            yield pa.record_batch([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])
            edges = []
        if len(rows) > 1:
            edges = solve(rows)
        yield pa.record_batch([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def links(docs: DataFrame, k: int, threshold: tuple[int, int], chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) between classes that connect what links connect."""
    parts = partitions_for(docs)
    bits = max(8, math.ceil(math.log2(4 * parts)))
    texts = docs.select("text")
    dealt = texts.mapInArrow(tidy(_deal(k, bits)), PAYLOAD_SCHEMA)
    shared = dealt.groupBy("bucket").applyInArrow(_count(bits), SHARED_SCHEMA)
    sets = stored(shared.groupBy("block").applyInArrow(_candidates(threshold), SETS_SCHEMA), "sets")
    stars = sets.select("class", "prefix", "shared").mapInArrow(
        _deal_prefixes(bits), "bucket int, keys binary, classes binary").groupBy("bucket").applyInArrow(_stars, EDGE_SCHEMA)
    groups = stored(components(stars).withColumnRenamed("node", "class"), "groups")
    # Blocks that hold copies of a class have written it each; one is enough.
    distinct = sets.dropDuplicates(["class"])
    sizes = stored(groups.groupBy("root").agg(F.count("*").alias("members")), "group_sizes")
    sized = join_groups(groups, sizes, "root", "members", "class")
    whole = sized.filter(F.col("members") <= chunk).select(
        "class", F.lit(False).alias("near"), F.col("root").cast("string").alias("part"))
    # The first set of a large group goes to its members in lots of about a chunk.
    lots = F.ceil(F.col("members") / F.lit(chunk)).cast("int")
    large = sized.filter(F.col("members") > chunk).select(
        "class", "root", "members", F.pmod(F.xxhash64("class"), lots).cast("int").alias("lot"))
    first = distinct.join(large.filter("class = root").select("class", "members"), "class").select(
        F.col("class").alias("root"), F.col("n").alias("first_n"), F.col("shared").alias("first_shared"),
        F.explode(F.sequence(F.lit(0), lots - 1)).alias("lot"))
    compared = distinct.join(large.drop("members"), "class").join(first, ["root", "lot"]).mapInArrow(
        _near_first(threshold), "class long, root long, near boolean")
    compared = stored(compared, "compared")
    told = compared.filter("near and class <> root").select(F.col("class").alias("a"), F.col("root").alias("b"))
    parts_of = whole.union(_parts(stored(_units(compared, distinct, chunk), "units"), chunk))
    joined = (
        distinct.drop("prefix").join(parts_of, "class").repartition(parts, "part").sortWithinPartitions("part", "class")
        .mapInArrow(tidy(_join_groups(threshold)), EDGE_SCHEMA)
    )
    return told.union(joined)


def _near_first(threshold: tuple[int, int]):
    p, q = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for n, shared, m, other in zip(*(batch.column(c).to_pylist() for c in (
                    "n", "shared", "first_n", "first_shared")), strict=True):
                common = len(np.intersect1d(np.frombuffer(shared, np.uint64), np.frombuffer(other, np.uint64), assume_unique=True))
                near.append(q * common >= p * (n + m - common))
            yield pa.record_batch([batch.column("class"), batch.column("root"), pa.array(near, pa.bool_())],
                                  names=["class", "root", "near"])

    return run


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each of a set's rarest shingles."""
    for batch in batches:
        keys = [np.frombuffer(s, np.uint64)[:p] for s, p in zip(
            batch.column("shared").to_pylist(), batch.column("prefix").to_pylist(), strict=True)]
        own = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
        shingles = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
        yield pa.record_batch([*(batch.column(c).take(own) for c in ("class", "root", "near")), pa.array(shingles)],
                              names=["class", "root", "near", "shingle"])


def _counted(rows: DataFrame, *by: str) -> DataFrame:
    """Sets linked with the first one (``nears``) and others (``fars``), where pairs are still open."""
    sizes = rows.groupBy(*by).agg(F.count_if("near").alias("nears"), F.count_if(~F.col("near")).alias("fars"))
    return sizes.withColumn("members", F.col("nears") + F.col("fars")).filter("fars > 0 and members > 1")


def _units(compared: DataFrame, distinct: DataFrame, chunk: int) -> DataFrame:
    """class, near and unit: the sets of a large group that have to meet, as one unit of the whole
    group or one for each rare shingle, whichever sends fewer sets."""
    keyed = stored(
        compared.join(distinct.select("class", "prefix", "shared"), "class")
        .mapInArrow(_prefixes, "class long, root long, near boolean, shingle long"), "prefixes")
    shared = _counted(keyed, "root", "shingle")
    nears, fars = (F.ceil(F.col(c) / F.lit(chunk)) for c in ("nears", "fars"))
    by_chunk = _counted(compared, "root").withColumn(
        "by_chunk", F.col("nears") * fars + F.col("fars") * (fars + F.when(F.col("nears") > 0, nears).otherwise(0)))
    by_prefix = shared.groupBy("root").agg(F.sum("members").alias("by_prefix"))
    ways = stored(by_chunk.join(by_prefix, "root", "left").select(
        "root", "members", (F.col("by_prefix") < F.col("by_chunk")).alias("split")), "ways")
    unit = F.col("root").cast("string")
    whole = join_groups(compared, ways, "root", "members", "class").filter("members is not null and not coalesce(split, false)")
    split = join_groups(keyed, ways.filter("split"), "root", "members", "class").filter("split")
    return whole.select("class", "near", unit.alias("unit")).union(
        split.select("class", "near", F.concat_ws("/", unit, "shingle").alias("unit")))


def _parts(units: DataFrame, chunk: int) -> DataFrame:
    """class, near and part: which tasks get which sets, for the pairs of a unit that are still open."""
    open_ = stored(_counted(units, "unit").select(
        "unit", "members", *(F.ceil(F.col(c) / F.lit(chunk)).cast("int").alias(c) for c in ("nears", "fars"))), "open")
    rows = join_groups(units, open_, "unit", "members", "class").filter("members is not null").withColumn("own", F.pmod(
        F.xxhash64("class"), F.when(F.col("near"), F.col("nears")).otherwise(F.col("fars"))).cast("int"))

    def each(count: str, name):
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col(count) - 1, F.lit(0))), name)).otherwise(
            F.array().cast("array<string>"))

    def far_near(far, near):
        return F.concat_ws(":", "unit", far, F.lit("near"), near)

    def far_far(other):
        return F.concat_ws(":", "unit", F.least("own", other), F.lit("far"), F.greatest("own", other))

    single = (F.col("members") <= chunk) | (F.col("nears") == 1) & (F.col("fars") == 1)
    where = (
        F.when(single, F.array(F.col("unit")))
        .when(F.col("near"), each("fars", lambda far: far_near(far, F.col("own"))))
        .otherwise(F.concat(each("fars", far_far), each("nears", lambda near: far_near(F.col("own"), near))))
    )
    return rows.select("class", "near", F.explode(where).alias("part"))


def near_duplicates(
    docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (75, 100), chunk: int = CHUNK
) -> DataFrame:
    """doc_id, digest (of the text), n_shingles, class and component_id of every document.

    The component_id is the smallest id reachable by links, the document's own included.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    profile = stored(
        rows.mapInArrow(tidy(_profile(k)), "doc_id long, digest long, n_shingles long, class long"), "profile")
    roots = components(links(rows, k, threshold, chunk))
    classes = profile.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(roots, classes["class"] == roots["node"], "left").select(
        "class", "least", F.coalesce("root", "class").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(smallest, "root").select("class", "root", "component")
    return profile.join(named, "class", "left").select(
        "doc_id", "digest", "n_shingles", "class", "root",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def first_of_each(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Documents without a shingle stay.  Of rows that repeat an id and a text any one is returned.
    """
    found = near_duplicates(docs, k, threshold)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    linked = found.filter("n_shingles > 0").groupBy("root").agg(first).select("first.doc_id", "first.digest")
    alone = found.filter("n_shingles = 0").select("doc_id", "digest")
    kept = linked.union(alone).select(row_key(F.col("doc_id"), F.col("digest")).alias("key"))
    return one_row_each(docs, kept, F.xxhash64("text"))
