"""Exact deduplication by Grace hashing.

Texts are equal when they are identical without ASCII white space.  Each map task first merges
equal texts within a slice of some MB, comparing complete content, so a text that a third of all rows hold is
shuffled once per slice and not once per row.  The merged records are shuffled by content hash;
each task then partitions what it gets by further hash bits into spill files, recursively, until
a bucket fits an open-addressing table that compares complete content.  A group of equal texts
comes out as one row; the documents, which travel without their text, find it by their digest, and
groups of a large share of all rows are sent to them instead.

A table counts its content and what its entries take, so texts of a few bytes fill it as well.  A
text of any length is one record; two of them must fit into a task.

Edge cases: a null text counts as empty; texts without any other character than white space form
one group; among equal candidates a null id comes after any id; rows that repeat an id and a text
are all returned, one of them kept.  No rows give no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import ASCII_SPACE, blocks, join_groups, one_row_each, partitions_for, row_key, stored, tidy

FAN_OUT = 16
SLICE_BYTES = 4 << 20
GROUP_SCHEMA = "content binary, points long, keep_id long, rows long"
FOUND_SCHEMA = "text_sha256 string, points long, keep_id long, group_size long"
HEAD = struct.Struct("<16sqqqq")  # hash, length of the content, points, id, rows
# What an entry takes beside its content: the list, five objects in it, its share of the slots.
ENTRY_BYTES = 360
NO_ID = -(2**63)  # stands for a null id in spill files


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def better(a: tuple, b: tuple) -> tuple:
    """The candidate that stays: most code points, then smallest id, null ids last."""
    def key(c):
        return (-c[0], c[1] is None, c[1] if c[1] is not None else 0)

    return a if key(a) <= key(b) else b


class ContentTable:
    """Open addressing with linear probing; entries are equal when their whole content is.

    ``slots`` holds places in ``entries``; an entry is [hash, content, points, id, rows].
    """

    def __init__(self, capacity: int = 1024):
        self.slots = [-1] * capacity
        self.entries: list[list] = []
        self.bytes = 0

    def _find(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (place := self.slots[at]) >= 0:
            entry = self.entries[place]
            if entry[0] == digest and entry[1] == content:
                return at
            at = (at + 1) & mask
        return at

    def add(self, digest: bytes, content: bytes, points: int, doc_id, rows: int) -> None:
        at = self._find(digest, content)
        if self.slots[at] >= 0:
            entry = self.entries[self.slots[at]]
            entry[2], entry[3] = better((entry[2], entry[3]), (points, doc_id))
            entry[4] += rows
            return
        self.slots[at] = len(self.entries)
        self.entries.append([digest, content, points, doc_id, rows])
        self.bytes += len(content) + ENTRY_BYTES
        if len(self.entries) * 2 > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for place, entry in enumerate(self.entries):
                self.slots[self._find(entry[0], entry[1])] = place


def _hash(content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16).digest()


def _write(file, digest, content, points, doc_id, rows) -> None:
    file.write(HEAD.pack(digest, len(content), points, NO_ID if doc_id is None else doc_id, rows))
    file.write(content)


def _read(path: str) -> Iterator[tuple]:
    with open(path, "rb") as file:
        while head := file.read(HEAD.size):
            digest, size, points, doc_id, rows = HEAD.unpack(head)
            yield digest, file.read(size), points, None if doc_id == NO_ID else doc_id, rows


def grace(records: Iterator[tuple], limit: int, folder: str, level: int = 0) -> Iterator[list]:
    """Groups of equal content among (hash, content, points, id, rows) records.

    Holds distinct content and what its entries take, ``limit`` bytes in all, plus one record.  Beyond
    that, the table
    and all later records go to FAN_OUT spill files by the next hash byte, each handled alike.
    Repeats merge in the table and take no room, so only distinct content can overfill a bucket.
    """
    table, files, paths = ContentTable(), None, []
    try:
        for record in records:
            if files is None:
                table.add(*record)
                if table.bytes <= limit or len(table.entries) == 1 or level >= 16:
                    continue
                paths = [os.path.join(folder, f"{level}-{i}") for i in range(FAN_OUT)]
                files = [open(path, "wb") for path in paths]
                for entry in table.entries:
                    _write(files[entry[0][15 - level] % FAN_OUT], *entry)
                table = ContentTable()
            else:
                _write(files[record[0][15 - level] % FAN_OUT], *record)
    finally:
        for file in files or []:
            file.close()
    yield from table.entries
    for path in paths:
        yield from grace(_read(path), limit, folder, level + 1)
        os.remove(path)


def _merge_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in _slices(batch, "content"):
            table, part = ContentTable(), batch.slice(start, end - start)
            columns = [part.column(name).to_pylist() for name in ("content", "points", "doc_id")]
            for content, points, doc_id in zip(*columns, strict=True):
                table.add(_hash(content), content, points, doc_id, 1)
            _, contents, points, ids, rows = map(list, zip(*table.entries, strict=True))
            yield pa.record_batch(
                [pa.array(contents, pa.binary()), pa.array(points, pa.int64()),
                 pa.array(ids, pa.int64()), pa.array(rows, pa.int64())],
                names=["content", "points", "keep_id", "rows"],
            )


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int]]:
    """Runs of rows with about SLICE_BYTES of content, so that few are Python objects at a time."""
    sizes = pc.binary_length(batch.column(column)).to_numpy()
    return blocks(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), SLICE_BYTES)


def _group_partition(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            names = ("content", "points", "keep_id", "rows")
            for batch in batches:
                for start, end in _slices(batch, "content"):
                    part = batch.slice(start, end - start)
                    for content, *rest in zip(*(part.column(n).to_pylist() for n in names), strict=True):
                        yield (_hash(content), content, *rest)

        folder, found = tempfile.mkdtemp(prefix="grace-"), []

        def flush():
            return pa.record_batch(
                [pa.array([f[i] for f in found], t) for i, t in
                 enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=["text_sha256", "points", "keep_id", "group_size"],
            )

        try:
            for _, content, points, doc_id, rows in grace(records(), limit, folder):
                found.append((hashlib.sha256(content).hexdigest(), points, doc_id, rows))
                if len(found) == 10_000:
                    yield flush()
                    found = []
            yield flush()
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return run


def equal_groups(docs: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """One row per group of equal texts: digest, id that stays, its code points, rows."""
    merged = docs.select(
        normalized(F.col("text")).cast("binary").alias("content"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("points"),
        F.col("doc_id").cast("long").alias("doc_id"),
    ).mapInArrow(tidy(_merge_batch), GROUP_SCHEMA)
    parts = partitions_for(docs)
    return merged.repartition(parts, F.xxhash64("content")).mapInArrow(
        tidy(_group_partition(limit)), FOUND_SCHEMA
    )


def exact_dedup(docs: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document."""
    members = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.sha2(normalized(F.col("text")).cast("binary"), 256).alias("text_sha256"),
            F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("own"),
        )
        .groupBy("doc_id", "text_sha256", "own")
        .agg(F.count("*").cast("int").alias("times"))
    )
    joined = join_groups(members, stored(equal_groups(docs, limit), "groups"), "text_sha256", "group_size")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("own") == F.col("points"))
    return joined.select(
        "doc_id", "keep_id", "group_size", "text_sha256", stays.alias("stays"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("stays") & (F.col("nth") == 1)).alias("kept"), "text_sha256",
    )


def distinct_documents(docs: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """The documents that stay, one of each group, with all their columns.

    Of rows that repeat the id and the text of the one that stays, any one is returned.
    """
    groups = equal_groups(docs, limit)
    digest = F.concat_ws(":", F.sha2(normalized(F.col("text")).cast("binary"), 256),
                         F.coalesce(F.length("text"), F.lit(0)).cast("string"))
    kept = groups.select(row_key(
        F.col("keep_id"), F.concat_ws(":", "text_sha256", F.col("points").cast("string"))).alias("key"))
    return one_row_each(docs, kept, digest)
