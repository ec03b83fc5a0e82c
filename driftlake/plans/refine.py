"""Batch jobs from the raw log to a type 1 table.

``merge_changes`` and ``upsert_rows`` work on catalog tables: through ``MERGE INTO`` where the
format has row-level operations (``native=True``), else by writing the table's new content to a
new folder and pointing the catalog there.  ``refine`` keeps complete versions of a table under a
path.

The changes are computed once and stored in the shared folder first.  Their files tell how large
they are, and so whether they are sent to the target, and can be checked without another pass
over the log.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.operators.envelope import DELETE_OP
from driftlake.operators.latest import latest_per_key
from driftlake.operators.merge import STAMP, apply_scd1, check_unique, merge_into_table, upsert
from driftlake.operators.routing import own_changes
from driftlake.operators.sizes import broadcast_limit
from driftlake.session import scratch_dir
from driftlake.sources import files
from driftlake.sources.tables import typed_rows
from driftlake.spec import TableSpec

DAY = "processed_date"
# Table properties: the folder a table was replaced from last, and the one its folders are named after.
PREVIOUS = "driftlake.previous"
HOME = "driftlake.home"
# What a byte of a compressed file may take in memory.
EXPANSION = 5


def latest_changes(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """The newest valid change of every key in a raw log."""
    return latest_per_key(own_changes(bronze, spec), spec)


def live_rows(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows a table holds after its whole log: newest change per key, deletes gone."""
    latest = latest_changes(bronze, spec)
    return latest.filter(F.col("op") != DELETE_OP).select(*spec.row_columns)


def table_schema(spec: TableSpec) -> T.StructType:
    fields = [*spec.key.items(), *spec.columns.items(), (STAMP, "timestamp")]
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))


def stored_source(rows: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """``rows`` computed once and stored, and whether they may be sent to every task."""
    spark = rows.sparkSession
    folder = f"{scratch_dir(spark, label)}/rows"
    rows.write.option("compression", "zstd").parquet(folder)
    small = EXPANSION * files.size_of(spark, folder) <= broadcast_limit(spark)
    return spark.read.schema(rows.schema).parquet(folder), small


def read_current(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The newest complete version of a table under ``path``; empty if there is none."""
    versions = files.finished_children(spark, path)
    schema = table_schema(spec)
    if not versions:
        return typed_rows(spark, [], schema)
    return spark.read.schema(schema).parquet(f"{path}/{versions[-1]}")


def next_version(spark: SparkSession, path: str) -> int:
    """Number of the version after the newest one; take it before reading that one."""
    versions = files.finished_children(spark, path)
    return int(versions[-1]) + 1 if versions else 0


def write_version(rows: DataFrame, path: str, number: int | None = None, keep: int | None = None) -> str:
    """Write a version of a table, one folder per processing day; returns its folder.

    A version is seen once it is complete, so readers and a failed job never meet halfway.  It is
    an error if somebody else has completed the same ``number`` meanwhile: ``rows`` are then built
    on a version that is no longer the newest.  Rebalancing splits a day that holds most rows and
    packs small days together.  With ``keep``, that many newest versions stay, the others go.
    """
    spark = rows.sparkSession
    number = next_version(spark, path) if number is None else number
    folder, building = f"{path}/{number:012d}", f"{path}/_building-{uuid.uuid4().hex}"
    if files.is_done(spark, folder):
        raise FileExistsError(f"{folder} was completed by another run")
    (
        rows.withColumn(DAY, F.to_date(STAMP))
        .hint("rebalance", DAY)
        .write.option("compression", "zstd")
        .partitionBy(DAY)
        .parquet(building)
    )
    files.mark_done(spark, building)
    if not files.move_new(spark, building, folder):
        files.remove(spark, building)
        raise FileExistsError(f"{folder} was completed by another run")
    if keep is not None:
        for name in files.finished_children(spark, path)[:-keep]:
            files.remove(spark, f"{path}/{name}")
    return folder


def refine(
    bronze: DataFrame,
    spec: TableSpec,
    path: str,
    as_of: Column | None = None,
    skip_unchanged: bool = False,
    keep: int | None = None,
) -> DataFrame:
    """Apply a raw log to the table under ``path`` and return the new version.

    Of two runs at a time one fails.  ``keep`` limits how many versions stay.
    """
    spark = bronze.sparkSession
    number = next_version(spark, path)
    target = read_current(spark, path, spec)
    changes, small = stored_source(latest_changes(bronze, spec), "changes")
    merged = apply_scd1(target, changes, spec, as_of, skip_unchanged, small)
    write_version(merged, path, number, keep)
    return read_current(spark, path, spec)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = {"Location", "Num Buckets", "Bucket Columns"}
    found = {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in names}
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {**found, **{r["key"]: r["value"] for r in properties}}


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    """One of a table's properties, or its ``Location``."""
    return _described(spark, table).get(name)


def _write_like(rows: DataFrame, folder: str, parts: list[str], about: dict[str, str]) -> None:
    """Write ``rows`` to a new folder with the layout of a catalog table."""
    writer = rows.hint("rebalance", *parts) if parts else rows
    writer = writer.write.format("parquet").option("compression", "zstd")
    if parts:
        writer = writer.partitionBy(*parts)
    buckets = int(about.get("Num Buckets") or 0)
    if not buckets:
        writer.save(folder)
        return
    name = f"driftlake_write_{uuid.uuid4().hex}"
    keys = [k.strip(" `") for k in about["Bucket Columns"].strip("[]").split(",")]
    writer.bucketBy(buckets, *keys).option("path", folder).saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def stage_rows(rows: DataFrame, table: str) -> str:
    """Write what shall be the table's whole content to a new folder; the table stays as it is."""
    spark = rows.sparkSession
    about = _described(spark, table)
    home = about.get(HOME, about["Location"])
    folder = f"{home.rstrip('/')}__{uuid.uuid4().hex}"
    _write_like(rows.select(*spark.table(table).columns), folder, _partition_columns(spark, table), about)
    return folder


def publish(spark: SparkSession, folder: str, table: str) -> None:
    """Point a table at a staged folder.  Nothing is written a second time.

    For a table without partitions this is one change in the catalog.  Partitions change one by
    one, each at once; a failure halfway is mended by calling this again with the same folder.
    The folder that was replaced stays for readers until the next time.
    """
    about = _described(spark, table)
    parts = _partition_columns(spark, table)
    before = about["Location"]
    if parts:
        path = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder")
        schema = spark.table(table).schema
        rows = spark.read.schema(schema).option("basePath", folder).parquet(folder)
        there = rows.select(*parts, path).distinct().collect()  # one row per partition
        wanted = {", ".join(f"`{p}`={_literal(r[p])}" for p in parts): r["_folder"] for r in there}
        known = spark.sql(f"SHOW PARTITIONS {table}").collect()
        for name in (r["partition"] for r in known):
            pairs = (x.partition("=") for x in name.split("/"))
            spec = ", ".join(
                f"`{k}`={_literal(None if v == '__HIVE_DEFAULT_PARTITION__' else unquote(v))}" for k, _, v in pairs)
            if spec not in wanted:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        for spec, location in wanted.items():
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{location}'")
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{location}'")
    if before != folder:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        home = about.get(HOME, before)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}'='{before}', '{HOME}'='{home}')")
        if about.get(PREVIOUS):
            files.remove(spark, about[PREVIOUS])
    spark.catalog.refreshTable(table)


def replace_rows(rows: DataFrame, table: str) -> None:
    """Make ``rows``, which may be computed from ``table``, the table's whole content."""
    publish(rows.sparkSession, stage_rows(rows, table), table)


def merge_changes(
    bronze: DataFrame,
    spec: TableSpec,
    table: str,
    as_of: Column | None = None,
    native: bool = False,
) -> None:
    """Apply the newest change per key of a raw log to a type 1 table."""
    spark = bronze.sparkSession
    changes = latest_changes(bronze, spec)
    if native:
        merge_into_table(changes, table, spec, as_of).merge()
        return
    target = spark.table(table)
    changes, small = stored_source(changes, "changes")
    merged = apply_scd1(target.drop(DAY), changes, spec, as_of, small=small)
    if DAY in target.columns:
        merged = merged.withColumn(DAY, F.to_date(STAMP))
    replace_rows(merged, table)


def upsert_rows(
    source: DataFrame, table: str, keys: list[str], native: bool = False, verify: bool = True
) -> None:
    """Overwrite the table's rows that ``source`` has, add the others, keep the rest.

    The source is stored first, and checked there that no key occurs in it twice.
    """
    spark = source.sparkSession
    source, small = stored_source(source, "source")
    if verify:
        check_unique(source, keys)
    if not native:
        replace_rows(upsert(spark.table(table), source, keys, small=small), table)
        return
    on = F.expr(" AND ".join(f"{table}.`{k}` = source.`{k}`" for k in keys))
    source.alias("source").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()
