"""Newest change per key of a stream, kept in Structured Streaming's own state.

What a micro-batch touched is written to a folder of its own (see ``folded``).  Which row of a key
is newest is decided by event order, so it does not matter which query wrote it, or when.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from driftlake.operators.latest import latest_per_key, latest_per_key_agg
from driftlake.spec import TableSpec
from driftlake.streaming.bronze import triggered
from driftlake.streaming.folded import counting, fold, read_counting, record_batch


def write_rows(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)


def start_latest(
    changes: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    every: str | None = None,
    fold_beyond: int | None = 64,
) -> StreamingQuery:
    """Write, per micro-batch, the keys it touched with their newest change.

    State is one row per key, spread over the shuffle partitions.  It may outgrow executor memory
    if the session keeps it on disk, as those of :func:`driftlake.session.build_session` do.
    Once more than ``fold_beyond`` folders count they are folded into one, so what
    :func:`read_latest` reads stays within that many folders and about twice the keys.  The fold
    is part of the batch: one that fails stops the query, and the batch's repetition folds again.
    Of several queries on one path only one should fold; give the others None.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        record_batch(batch, batch_id, path, write_rows, stateful=True)
        if fold_beyond and len(counting(batch.sparkSession, path)[0]) > fold_beyond:
            fold_latest(batch.sparkSession, path, spec)

    writer = (
        latest_per_key_agg(changes, spec)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(record)
    )
    return triggered(writer, every).start()


def read_latest(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The newest written row of every key, in event order."""
    return latest_per_key(read_counting(spark, path), spec)


def fold_latest(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Bring the written batches together in one folder; see :func:`driftlake.streaming.folded.fold`."""
    fold(spark, path, lambda rows: latest_per_key(rows, spec), write_rows)
