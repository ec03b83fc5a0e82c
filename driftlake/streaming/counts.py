"""Rows kept and dropped by a running stream, written down batch by batch.

A query's progress only remembers its last batches, so the counts are stored with what each batch
wrote: ``rows/<query>-<batch>/`` and, last, ``counts/<query>-<batch>.json``.  A repeated batch
overwrites both; a batch counts once its counts are there.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from driftlake.operators.envelope import decode, valid_changes
from driftlake.operators.routing import own_rows
from driftlake.sources import files
from driftlake.sources.tables import typed_rows
from driftlake.spec import TableSpec
from driftlake.streaming.bronze import batch_name, triggered, with_retries

COUNTS = "batch STRING, decoded BIGINT, applied BIGINT, rejected BIGINT"


def start_counted(
    bronze: DataFrame, spec: TableSpec, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write the valid changes of a table, and per batch how many rows were kept and dropped."""

    def write(batch: DataFrame, name: str) -> None:
        seen = Observation()
        kept = valid_changes(decode(own_rows(batch, spec), spec), spec, observe_as=seen)
        kept.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/rows/{name}")
        counts = json.dumps({"batch": name, **seen.get})
        files.write_text(batch.sparkSession, f"{path}/counts/{name}.json", counts)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            with_retries(lambda: write(batch, batch_name(batch, batch_id)))

    writer = bronze.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts of every finished batch."""
    if not files.exists(spark, f"{path}/counts"):
        return typed_rows(spark, [], COUNTS)
    return spark.read.schema(COUNTS).json(f"{path}/counts")
