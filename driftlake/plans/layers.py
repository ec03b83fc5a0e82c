"""Namespaces, tables and promotion between layers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from driftlake.session import scratch_dir
from driftlake.sources.tables import table_exists


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a namespace unless it is there; harmless when two jobs do it at once."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{where}")


def new_namespace(spark: SparkSession, label: str) -> str:
    """A namespace of its own for the time of the session; returns its name."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    ensure_namespace(spark, name, scratch_dir(spark, name))
    return name


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    properties: dict[str, str] | None = None,
    bucket_by: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Load a table, creating it empty if need be.

    ``partition_by`` takes columns, or transforms such as ``days(processed_at)`` where the
    format has them.  A table bucketed on its key (``bucket_by``, ``buckets``) need not be moved
    between tasks when changes are merged into it; take its bytes / 256 MB or so.
    """
    if bool(bucket_by) != bool(buckets):
        raise ValueError("bucket_by and buckets belong together")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    if bucket_by:
        names = ", ".join(f"`{c}`" for c in bucket_by)
        parts += f" CLUSTERED BY ({names}) INTO {buckets} BUCKETS"
    extra = ", ".join(f"'{k}'='{v}'" for k, v in (properties or {}).items())
    options = f" TBLPROPERTIES ({extra})" if extra else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{parts}{options}")
    return spark.table(name)


def append(rows: DataFrame, table: str) -> None:
    """Append by column name; types must fit the table's."""
    spark = rows.sparkSession
    columns = spark.table(table).columns
    missing = set(columns) ^ set(rows.columns)
    if missing:
        raise ValueError(f"columns do not match {table}: {sorted(missing)}")
    rows.select(*columns).write.insertInto(table)


def seed_if_missing(
    spark: SparkSession, table: str, rows: Callable[[], DataFrame], fmt: str = "parquet"
) -> bool:
    """Create and fill a table that does not exist yet; returns whether it did."""
    if table_exists(spark, table):
        return False
    rows().write.format(fmt).saveAsTable(table)
    return True


def promote(
    rows: DataFrame, table: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Create a table from a query unless it exists (CREATE TABLE IF NOT EXISTS ... AS SELECT).

    With partition columns rows are gathered by them before the write; a large partition
    value is spread over several tasks and small ones share a task.
    """
    if table_exists(rows.sparkSession, table):
        return
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.format(fmt).mode("ignore").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_namespaces(spark: SparkSession, catalog: str = "spark_catalog") -> DataFrame:
    return spark.sql(f"SHOW NAMESPACES IN {catalog}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")
