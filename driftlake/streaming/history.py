"""Every change of every key as a table that finds one key's history without reading the rest.

The raw log is decoded once: key, attributes, ``op``, ``version`` and position are columns.  A
micro-batch is laid out by key and event order over as many files as it needs, so a key that holds
most of the log is spread over several of them and a rare one is in one.  Files carry a bloom filter
of each key column and small row groups.  Looking up a key then costs, for each file, a look at its
footer, and the row groups that may have the key: those whose range of keys includes it, less those
whose bloom filter rules it out.

:func:`fold_history` brings batches together, so there is one ordered run of files instead of many.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftlake.operators.envelope import DELETE_OP
from driftlake.operators.latest import event_order
from driftlake.operators.routing import own_changes
from driftlake.spec import TableSpec
from driftlake.streaming.bronze import triggered
from driftlake.streaming.folded import fold, read_counting, record_batch

# Bytes of a row group, and rows a page of its column indexes speaks for.
GROUP_BYTES = 16 << 20
PAGE_ROWS = 800


def _order(rows: DataFrame, spec: TableSpec) -> list[Column]:
    return [c.asc_nulls_first() for c in event_order(spec, rows.columns)]


def _columns(changes: DataFrame, spec: TableSpec) -> DataFrame:
    if "offset" not in changes.columns:
        changes = changes.withColumn("offset", F.lit(None).cast("bigint"))
    return changes.select(*spec.row_columns, "op", "version", "lsn", "offset")


def write_history(changes: DataFrame, spec: TableSpec, folder: str, group_bytes: int = GROUP_BYTES) -> None:
    """Write decoded changes by key and event order, with bloom filters on the key."""
    rows = _columns(changes, spec)
    by = [*(F.col(k) for k in spec.keys), *_order(rows, spec)]
    writer = (
        rows.repartitionByRange(*by).sortWithinPartitions(*by)
        .write.mode("overwrite").option("compression", "zstd")
        .option("parquet.block.size", group_bytes)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
    )
    for key in spec.keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(folder)


def start_history(
    bronze: DataFrame, spec: TableSpec, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the history of a captured table under ``path`` up to date from a stream of raw rows."""

    def write(batch: DataFrame, folder: str) -> None:
        write_history(own_changes(batch, spec), spec, folder)

    writer = bronze.writeStream.foreachBatch(lambda batch, n: record_batch(batch, n, path, write))
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def fold_history(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Lay out all batches as one; changes delivered several times stay once."""
    columns = [*spec.row_columns, "op", "version", "lsn", "offset"]
    fold(spark, path, lambda rows: rows.dropDuplicates(columns), lambda rows, folder: write_history(rows, spec, folder))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All changes of all keys, in no order."""
    return read_counting(spark, path)


def key_history(spark: SparkSession, path: str, spec: TableSpec, key: dict[str, Any]) -> DataFrame:
    """The changes of one key, each once, with its place ``nth`` in event order and whether the row
    exists after it.

    The key's values stand in the plan as literals of the columns' own types, so the filter gets to
    the files.
    """
    if set(key) != set(spec.keys):
        raise ValueError(f"a key of {spec.name} has {spec.keys}")
    rows = read_history(spark, path)
    mine = rows.filter(reduce(and_, [F.col(k) == F.lit(key[k]).cast(t) for k, t in spec.key.items()]))
    mine = mine.dropDuplicates()
    nth = F.row_number().over(Window.partitionBy(*spec.keys).orderBy(*_order(rows, spec)))
    return mine.withColumn("nth", nth).withColumn("exists_after", F.col("op") != DELETE_OP)
