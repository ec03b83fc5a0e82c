"""Streaming ingest: topics to an append-only raw table or a JSON archive."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from driftlake.functions.payload import normalize_value

# Bounded retry of one write, and the pause of an overloaded target.
WRITE_ATTEMPTS = 3
RETRY_PAUSE_SECONDS = 3.0
TIMEOUT_PAUSE_SECONDS = 30.0
# Timeouts in a row from which on the log calls them an error.
LASTING = 10

JAVA_TIMEOUTS = ("java.net.SocketTimeoutException", "java.util.concurrent.TimeoutException")
JAVA_CONNECTION_FAILURES = (
    "java.net.ConnectException",
    "java.net.NoRouteToHostException",
    "java.net.SocketException",
    "java.net.UnknownHostException",
)

LOG = logging.getLogger(__name__)
QUERY_ID = "sql.streaming.queryId"

Hook = Callable[[DataFrame], DataFrame]


class SinkWriteError(RuntimeError):
    """A batch could not be written; the query stops and its checkpoint replays the batch."""


def to_bronze(changes: DataFrame, normalize: bool = True, hook: Hook | None = None) -> DataFrame:
    """Topic rows to raw rows: one ``payload`` string plus where it came from.

    ``hook`` is a user function DataFrame -> DataFrame applied first.
    """
    if hook:
        changes = changes.transform(hook)
    return changes.select(
        normalize_value(F.col("value"), normalize).alias("payload"),
        "topic",
        "partition",
        "offset",
        F.current_timestamp().alias("ingest_ts"),
    )


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run ``every`` so often, or work off what is there and end."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_bronze(
    bronze: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
    every: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append the stream to a raw table, given by ``path`` or catalog name, parted by topic.

    ``fmt`` is any streaming sink the session has (parquet, delta, iceberg, ...).  The sink's
    own log makes every record count once, across restarts.  Without ``every`` the query
    works off what is there and ends.  Batch size is bounded at the source
    (``maxOffsetsPerTrigger``, ``maxBytesPerTrigger``, ``maxFilesPerTrigger``).
    """
    writer = (
        bronze.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .options(**{"compression": "zstd", **(options or {})})
        .partitionBy("topic")
        .outputMode("append")
    )
    writer = triggered(writer, every)
    return writer.toTable(table) if table else writer.start(path)


def start_print(changes: DataFrame, rows: int = 20, every: str | None = None) -> StreamingQuery:
    """Show the first rows of each micro-batch with their metadata, for debugging."""
    writer = changes.writeStream.format("console").option("numRows", rows).option("truncate", "false")
    return triggered(writer, every).start()


def start_archive(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    rows_per_file: int = 1_000_000,
) -> StreamingQuery:
    """Archive topic rows as gzip JSON lines under topic and partition folders, nulls kept.

    Gzip files are read whole by one task each, hence the bound on their rows.
    """
    writer = (
        changes.writeStream.format("json")
        .option("checkpointLocation", checkpoint)
        .option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("topic", "partition")
        .outputMode("append")
    )
    return triggered(writer, every).start(path)


def causes(failure: BaseException) -> list[object]:
    """The failure and what it was raised from, Python exceptions and Java throwables alike."""
    found, todo = [], [failure]
    while todo and len(found) < 100:
        one = todo.pop()
        if one is None or any(one is f for f in found):
            continue
        found.append(one)
        if isinstance(one, BaseException):
            java = getattr(one, "_origin", None) or getattr(one, "java_exception", None)
            todo += [one.__cause__, one.__context__, java]
        else:
            todo.append(one.getCause())
    return found


def _is_any(failure: BaseException, python: type, java: tuple[str, ...]) -> bool:
    """Whether a cause is of a class; its message does not matter."""
    return any(
        isinstance(c, python) if isinstance(c, BaseException) else c.getClass().getName() in java
        for c in causes(failure)
    )


def is_timeout(failure: BaseException) -> bool:
    return _is_any(failure, TimeoutError, JAVA_TIMEOUTS)


def is_connection_failure(failure: BaseException) -> bool:
    return _is_any(failure, ConnectionError, JAVA_CONNECTION_FAILURES)


def with_retries(
    write: Callable[[], None],
    attempts: int = WRITE_ATTEMPTS,
    pause: float = RETRY_PAUSE_SECONDS,
    timeout_pause: float = TIMEOUT_PAUSE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
    timeouts: int | None = None,
) -> None:
    """Run ``write`` with bounded retries.

    A connection failure is retried after ``pause``, ``attempts`` times in all.  A timeout
    means the target is overloaded: the batch waits ``timeout_pause`` and is tried again,
    and since the next micro-batch waits for this one, no more is read meanwhile.  That goes on
    for ever, as an error in the log from the LASTING-th time on, unless ``timeouts`` says after how
    many the write has failed.  Anything else is raised at once.
    """
    failed = waited = 0
    while True:
        try:
            write()
            return
        except Exception as failure:
            if is_timeout(failure):
                waited += 1
                if waited == timeouts:
                    raise SinkWriteError(f"write timed out {timeouts} times") from failure
                level = logging.ERROR if waited >= LASTING else logging.WARNING
                LOG.log(level, "write timed out %s times, next try in %s s: %r", waited, timeout_pause, failure)
                sleep(timeout_pause)
                continue
            if not is_connection_failure(failure):
                raise
            failed += 1
            if failed == attempts:
                raise SinkWriteError(f"write failed {attempts} times") from failure
            LOG.warning("no connection, next try in %s s: %r", pause, failure)
            sleep(pause)


def append_batch(
    batch: DataFrame,
    write: Callable[[DataFrame], None],
    attempts: int = WRITE_ATTEMPTS,
    pause: float = RETRY_PAUSE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> bool:
    """Write one micro-batch; an empty one writes nothing.  Returns whether it wrote."""
    if batch.isEmpty():
        return False
    with_retries(lambda: write(batch), attempts, pause, sleep=sleep)
    return True


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """A name that lasts: by the query's own id, which lives in its checkpoint, and the batch."""
    query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    return f"{query}-{batch_id:012d}"


def start_bronze_batches(
    bronze: DataFrame,
    write: Callable[[DataFrame], None],
    checkpoint: str,
    every: str | None = None,
    pause: float = RETRY_PAUSE_SECONDS,
) -> StreamingQuery:
    """Append micro-batches to any table format through ``write``.

    For table formats without their own streaming sink.  A write repeated after a lost
    acknowledgement appends twice (at least once); the merge jobs are not affected by that.
    """
    writer = bronze.writeStream.foreachBatch(lambda batch, _: append_batch(batch, write, pause=pause))
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()
