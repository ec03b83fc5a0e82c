"""Small helpers the operators share: reading tables, text buffers, blocks, stable hashes."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlake.session import scratch_dir

# ASCII white space: the class [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"

_BLANKS = np.frombuffer(ASCII_SPACE.encode(), np.uint8)

# Groups of many rows that are sent to every task: at most so many, and only those above so many rows.
HEAVY_GROUPS, HEAVY_ROWS = 10_000, 1_000

# Odd 64-bit constants of the integer mixer (fixed values).
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new folder under the shared one, and read back.

    Cuts the lineage: what follows survives lost executors without computing ``df`` again.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, label)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system.  A Python worker goes on with other tasks, and so do its
    neighbours on the machine; without this it keeps the most it has ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, a function of Arrow batches, that gives memory back when a task is through."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return through


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers, the same on every machine."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + STEP
        x = (x ^ (x >> np.uint64(30))) * MIX_1
        x = (x ^ (x >> np.uint64(27))) * MIX_2
        return x ^ (x >> np.uint64(31))


def pieces(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in parts of about ``limit`` bytes, each but the last ending on white space.

    A stretch without white space stays whole, however long it is.
    """
    start = 0
    while start < len(data):
        end = min(start + limit, len(data))
        if end < len(data):
            blank = np.flatnonzero(np.isin(data[start:end], _BLANKS))
            while not len(blank) and end < len(data):
                blank = end - start + np.flatnonzero(np.isin(data[end : end + limit], _BLANKS))[:1]
                end = min(end + limit, len(data))
            end = start + int(blank[-1]) + 1 if len(blank) else end
        yield data[start:end]
        start = end


@functools.lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64; not to be written to."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def low40(values: np.ndarray) -> bytes:
    """The lowest 40 bits of each number, five bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def from40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def low56(values: np.ndarray) -> bytes:
    """The lowest 56 bits of each number, seven bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def from56(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.reshape(-1).view("<u8")


def own_group(block: int) -> int:
    """Bucket below 0 for a block's rows that only need to reach their block: a group of its own, so
    no group grows with the number of blocks."""
    return -1 - (block & 0x7FFFFFFF)


def ascii_lower(column):
    """Lower-case A-Z only, as the contracts say; other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def partitions_for(df: DataFrame, least: int = 1) -> int:
    """How many shuffle partitions the session asks for."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end places of the runs of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return first, np.append(first[1:], len(values))


def row_key(doc_id: Column, digest: Column) -> Column:
    """Text that tells rows apart by id and digest of their content."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")), digest.cast("string"))


def one_row_each(docs: DataFrame, kept: DataFrame, digest: Column) -> DataFrame:
    """Rows of ``docs`` whose key is among ``kept`` (key string), one of each key, all columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, row_key(F.col("doc_id"), digest).alias("key")).join(kept, "key", "left_semi")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return rows.withColumn("nth", nth).filter("nth = 1").select("row.*")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, n_rows: str, spread: str = "doc_id") -> DataFrame:
    """``rows`` (``spread``, ``key`` and others) with the columns of their group, ``groups`` holding one
    row for each key and in ``n_rows`` how many rows it has.  Rows without a group stay, with nulls.

    A key that a third of all rows hold doesn't lead them into one task: groups with more than
    1 / HEAVY_GROUPS of all rows, of which there can't be more than HEAVY_GROUPS, are sent to every
    task, and their rows go on by ``spread``.  ``groups`` is used three times, so it should be stored.
    """
    total = groups.agg(F.sum(n_rows)).first()[0] or 0
    least = max(HEAVY_ROWS, total // HEAVY_GROUPS)
    found = F.struct(*(F.col(c) for c in groups.columns if c != key))
    heavy = groups.filter(F.col(n_rows) > least).select(F.col(key).alias("_heavy_key"), found.alias("_heavy"))
    light = groups.filter(F.col(n_rows) <= least).select(F.col(key).cast("string").alias("_at"), found.alias("_light"))
    away = F.concat(F.lit("row "), F.coalesce(F.col(spread).cast("string"), F.lit("")))
    at = F.when(F.col("_heavy").isNull(), F.col(key).cast("string")).otherwise(away)
    joined = (
        rows.join(F.broadcast(heavy), F.col(key) == F.col("_heavy_key"), "left").withColumn("_at", at)
        .join(light, "_at", "left").withColumn("_found", F.coalesce("_heavy", "_light"))
    )
    return joined.select(*rows.columns, "_found.*")
