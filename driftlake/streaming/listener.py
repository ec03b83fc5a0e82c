"""Counts of streams whose sink writes by itself, taken from what each batch reports.

File and table sinks run no user code, so a batch's counts are observed (``observe_as`` of
``valid_changes``, or :func:`observed`) and reach the driver with the query's progress.  A listener
stores them, a small file per batch named by query and batch, so they outlast the few progress
entries a query remembers.  A repeated batch overwrites its file.

Progress is reported after a batch is committed.  A driver lost in between leaves a batch
uncounted; :func:`uncounted` finds such batches by the query's own log.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from driftlake.sources import files
from driftlake.sources.tables import typed_rows

COUNTS = "query STRING, batch BIGINT, input_rows BIGINT, counts MAP<STRING, BIGINT>"


def observed(rows: DataFrame, name: str) -> DataFrame:
    """Raw rows, counted under ``name`` as they pass."""
    wrapped = F.col("payload").startswith('{"value": ')
    return rows.observe(
        name, F.count(F.lit(1)).alias("records"), F.count_if(wrapped).alias("wrapped"),
        F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("bytes"))


class CountsListener(StreamingQueryListener):
    """Stores the counts observed under ``name``, of whatever query reports them."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.ended: dict[str, threading.Event] = {}
        self.failures: list[BaseException] = []

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is None:
            return
        line = {
            "query": str(progress.id), "batch": progress.batchId, "input_rows": progress.numInputRows,
            "counts": {k: int(v) for k, v in row.asDict().items() if v is not None},
        }
        try:
            target = f"{self.path}/{progress.id}-{progress.batchId:012d}.json"
            files.write_text(self.spark, target, json.dumps(line))
        except Exception as failure:  # Spark would only log it
            self.failures.append(failure)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait until everything an ended query reported is stored; raise what failed."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no end of query {query.runId} reported in {timeout} s")
        if self.failures:
            raise self.failures[0]


def store_counts(spark: SparkSession, path: str, name: str) -> CountsListener:
    """Add a listener that stores counts under ``path``; give it to ``removeListener`` when done."""
    listener = CountsListener(spark, path, name)
    spark.streams.addListener(listener)
    return listener


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """Counts of every reported batch."""
    if not files.exists(spark, path):
        return typed_rows(spark, [], COUNTS)
    return spark.read.schema(COUNTS).json(path)


def uncounted(spark: SparkSession, path: str, checkpoint: str) -> list[int]:
    """Batches a query has committed but whose counts are not there.

    Batches without input report no counts, and are left out where the query reports them at all.
    """
    fs, handle = files.open_path(spark, f"{checkpoint}/commits/*")
    names = [status.getPath().getName() for status in fs.globStatus(handle) or []]
    query = json.loads(files.read_lines(spark, f"{checkpoint}/metadata")[0])["id"]
    there = {r["batch"] for r in read_stored(spark, path).filter(F.col("query") == query).select("batch").collect()}
    return sorted({int(n) for n in names if n.isdigit()} - there)
