"""Catalog tables and small typed inputs."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the catalog knows the table; reads no data and hides no connection error."""
    return spark.catalog.tableExists(name)


def typed_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A few literal rows under an explicit schema.

    Handed over as one Arrow table, they become a local relation whose size the optimizer
    knows, so that a join with them is broadcast instead of shuffling the other side.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema)


def preview(table: DataFrame, rows: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first rows; ordered it is a top-n, never a full sort or a full collect."""
    return (table.orderBy(*order_by) if order_by else table).limit(rows)


def click_event_schema() -> T.StructType:
    """Click events; the time carries no zone."""
    return T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("event_time", T.TimestampNTZType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("action", T.StringType()),
            T.StructField("page", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
