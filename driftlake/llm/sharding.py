"""Reproducible shuffle into shards: a Feistel permutation of global row numbers (DataFrame only).

Rows get a global number first: a row's hash bucket decides its place among the buckets, its id
its place within.  A Feistel network over Z_a x Z_b, a * b just above the row count, permutes the
numbers; numbers that land beyond the count walk on along their cycle until they are back in
range.  The image p of a row says everything: shard ``p mod shards``, slot ``p div shards``.
Shards therefore differ by at most one row and slots have no gaps, and :func:`row_number_at`
computes the row number that sits in a given shard and slot without any table.

Edge cases: null text counts as empty (size 8, crc 0); rows with a null id take part, numbered
after the others of their bucket; repeated rows get places of their own; no rows give no rows.
Of a text of any length only size and checksum travel.
Only ``doc_id`` and ``text`` are read, so further columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 6
# Numbers of the hash buckets; the offsets table has that many rows, whatever the input's size.
BUCKETS = 4096
# A cycle has at most a - 1 numbers out of range in a row, and a <= 64 up to 4,096 rows.  Beyond,
# 64 in a row have a probability below 1e-100; the plan raises an error rather than be wrong.
WALK = 64


def _sides(total: Column) -> tuple[Column, Column]:
    a = F.greatest(F.ceil(F.sqrt(total.cast("double"))), F.lit(1)).cast("long")
    return a, F.floor((total + a - 1) / a).cast("long")


def _step(left: Column, right: Column, a: Column, b: Column, seed: int, i: int, sign: int):
    """Both sides after round ``i`` (``sign`` 1), or before it (``sign`` -1)."""
    if i % 2 == 0:
        key = F.pmod(F.xxhash64(right, F.lit(seed), F.lit(i)), a)
        return F.pmod(left + sign * key, a), right
    key = F.pmod(F.xxhash64(left, F.lit(seed), F.lit(i)), b)
    return left, F.pmod(right + sign * key, b)


def _round(state: Column, a: Column, b: Column, change) -> Column:
    """Apply one round to a struct of both sides, without copying its expression."""
    return F.element_at(F.transform(F.array(state), lambda s: change(s["l"], s["r"])), 1)


def permute(x: Column, total: Column, seed: int, inverse: bool = False) -> Column:
    """Image of ``x`` under the Feistel network; may lie at or above ``total``."""
    a, b = _sides(total)
    state = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, b).alias("r"))
    for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):

        def change(left, right, i=i):
            left, right = _step(left, right, a, b, seed, i, -1 if inverse else 1)
            return F.struct(left.alias("l"), right.alias("r"))

        state = _round(state, a, b, change)
    return F.element_at(F.transform(F.array(state), lambda s: s["l"] * b + s["r"]), 1)


def walk(x: Column, total: Column, seed: int, inverse: bool = False) -> Column:
    """Image of ``x`` within ``0 .. total - 1``: a permutation of that range."""

    def onward(y, _):
        return F.when(y < total, y).otherwise(permute(y, total, seed, inverse))

    first = F.transform(F.array(permute(x, total, seed, inverse)), lambda y: F.when(y < total, y).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), y, onward)))
    return F.element_at(F.transform(first, lambda y: F.when(y < total, y).otherwise(
        F.raise_error(F.lit("the cycle walk did not end")).cast("long"))), 1)


def row_number_at(shard: Column, slot: Column, shards: int, total: Column, seed: int = 1) -> Column:
    """Global row number of the row in a given place."""
    return walk(slot * F.lit(shards) + shard, total, seed, inverse=True)


def numbered(rows: DataFrame, order: list, bucket: Column) -> DataFrame:
    """``rows`` with ``row_number`` from 0 without gaps, and their ``total``.

    One shuffle of the rows, by hash bucket; the offsets are a table of BUCKETS rows.
    """
    rows = rows.withColumn("bucket", F.pmod(bucket, F.lit(BUCKETS)).cast("int"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select(
            "bucket",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
            F.sum("n").over(Window.orderBy(F.lit(0)).rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
        )
    )
    within = F.row_number().over(Window.partitionBy("bucket").orderBy(*order))
    return (
        rows.withColumn("within", within)
        .join(F.broadcast(offsets), "bucket")
        .withColumn("row_number", F.col("first") + F.col("within") - 1)
        .drop("bucket", "within", "first")
    )


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, row_number, total, shard and slot of every document."""
    rows = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("hash"),
    )
    rows = numbered(rows, ["hash", "doc_id", "size", "text_crc32"], F.col("hash"))
    place = rows.withColumn("place", walk(F.col("row_number"), F.col("total"), seed))
    return place.select(
        "doc_id", "size", "text_crc32", "row_number", "total",
        F.pmod(F.col("place"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
    )
