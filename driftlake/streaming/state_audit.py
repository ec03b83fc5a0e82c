"""What a query's state holds against what its readers are served.

Spark's state reader gives the state of a stopped query as a table, one partition of it a task.
For the newest change per key that is the key, and the buffer of the aggregate.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.spec import TableSpec
from driftlake.streaming.latest import read_latest


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Stateful operators of a query: their names, stores, partitions and batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """State as the last finished batch left it: ``key``, ``value`` and ``partition_id``."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def latest_state(spark: SparkSession, checkpoint: str, spec: TableSpec) -> DataFrame:
    """The newest change of every key as the state of ``start_latest`` holds it.

    The aggregate's buffer has the change and its event order; the change is the part that has an
    operation.
    """
    state = read_state(spark, checkpoint)
    keys = [F.col(f"key.{f.name}").alias(k) for f, k in zip(state.schema["key"].dataType, spec.keys, strict=True)]
    changes = [
        f.name for f in state.schema["value"].dataType
        if isinstance(f.dataType, T.StructType) and "op" in f.dataType.names
    ]
    if not changes:
        raise ValueError(f"the state under {checkpoint} holds no change rows")
    return state.select(*keys, F.col(f"value.`{changes[0]}`.*"), "partition_id")


def audit_latest(spark: SparkSession, checkpoint: str, path: str, spec: TableSpec) -> DataFrame:
    """Keys whose state and served row are not the same change, and those that are.

    ``status``: ``same``, ``differs``, ``state only`` or ``served only``; one full outer join of two
    tables with one row per key.
    """
    state = latest_state(spark, checkpoint, spec)
    served = read_latest(spark, path, spec)
    compared = [c for c in served.columns if c not in spec.keys and c in state.columns]
    joined = state.withColumn("_s", F.lit(True)).alias("s").join(
        served.withColumn("_r", F.lit(True)).alias("r"), [F.col(f"s.`{k}`") == F.col(f"r.`{k}`") for k in spec.keys],
        "full_outer")
    same = reduce(and_, [F.col(f"s.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in compared])
    status = (
        F.when(F.col("_r").isNull(), "state only").when(F.col("_s").isNull(), "served only")
        .when(same, "same").otherwise("differs")
    )
    return joined.select(
        *[F.coalesce(f"s.`{k}`", f"r.`{k}`").alias(k) for k in spec.keys], status.alias("status"), "partition_id",
        F.col("s.op").alias("state_op"), F.col("r.op").alias("served_op"),
        F.col("s.version").alias("state_version"), F.col("r.version").alias("served_version"))
