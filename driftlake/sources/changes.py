"""Change topics as DataFrames: a broker, or a folder of files with the same columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.sources import files

# What every topic reader yields, and what the raw table holds.
CONTRACT = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
RAW = "payload STRING, topic STRING, partition INT, offset BIGINT, ingest_ts TIMESTAMP"


def topic_schema() -> T.StructType:
    return T.StructType.fromDDL(CONTRACT)


def broker_options(
    topics: Iterable[str], streaming: bool, options: dict[str, str] | None = None
) -> dict[str, str]:
    """Reader options for a broker: all of the topics, from the earliest offset.

    ``options`` win, and may choose the topics by ``subscribePattern`` or ``assign`` instead.
    """
    chosen = {"startingOffsets": "earliest", **({} if streaming else {"endingOffsets": "latest"})}
    given = options or {}
    if not {"subscribe", "subscribePattern", "assign"} & set(given):
        chosen["subscribe"] = ",".join(topics)
    return {**chosen, **given}


def read_changes(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    topics: Iterable[str] | None = None,
    streaming: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Changes from the beginning of the topics, with the columns of ``CONTRACT``.

    ``fmt="kafka"`` subscribes to ``topics`` from the earliest offset; the query's checkpoint
    keeps the progress afterwards.  Any file format reads ``path`` instead.  With
    ``streaming=False`` the same topics are read once, up to their current end.
    """
    reader = spark.readStream if streaming else spark.read
    names = list(topics or [])
    if fmt == "kafka":
        loaded = reader.format("kafka").options(**broker_options(names, streaming, options)).load()
    else:
        loaded = (
            reader.format(fmt).schema(topic_schema()).options(**(options or {})).load(path)
        )
        if names:
            loaded = loaded.filter(F.col("topic").isin(*names))
    return loaded.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "timestamp",
    )


def raw_schema() -> T.StructType:
    return T.StructType.fromDDL(RAW)


def read_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    streaming: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The raw table written by the ingest stream, as a whole or as a stream of its own."""
    reader = spark.readStream if streaming else spark.read
    return reader.format(fmt).schema(raw_schema()).options(**(options or {})).load(path)


def replay_options(spark: SparkSession, path: str, batches: int) -> dict[str, str]:
    """Options that let a stream work through the files of ``path`` in about ``batches`` steps.

    The step grows with the data, so the number of micro-batches does not.
    """
    step = files.size_of(spark, path) // batches + 1
    return {"maxBytesPerTrigger": str(step)}


def table_topic(prefix: str, schema: str, table: str) -> str:
    """Topic name of a captured table."""
    return f"{prefix}.{schema}.{table}"
