"""Merges that rewrite only the parts of a catalog table that hold a changed key.

The table is partitioned by a hash of its key into a fixed number of parts.  The parts of a batch of
changes are known without looking at the table; only these are read, merged, written to a new
folder, and pointed to in the catalog.  All other parts keep their files.

Each part changes at once, the table part by part: a reader that plans in between sees some keys
before and some after the batch, never a key halfway.  A merge that broke off is mended by running
it again, since a type 1 merge of the same changes gives the same rows.  One merge may run at a
time.  Replaced folders stay for readers until :func:`drop_replaced`.

Choose the number of parts by the table's size (its bytes / 1 GB or so): a batch of n keys rewrites
about ``parts * (1 - (1 - 1/parts) ** n)`` of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.operators.merge import apply_scd1, check_unique, upsert
from driftlake.plans.layers import ensure_table
from driftlake.plans.refine import latest_changes, stored_source, table_property, table_schema
from driftlake.sources import files
from driftlake.spec import TableSpec

PART = "key_part"
# Table properties: number of parts, and the columns they are a hash of.
PARTS = "driftlake.parts"
KEYS = "driftlake.part_keys"
# Parts that are pointed to at the same time, each by a call to the catalog.
CALLS = 16


def key_part(keys: list[str], parts: int) -> Column:
    """Part of a row; the hash does not depend on the session or the key's place in the table."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


def ensure_parted(spark: SparkSession, table: str, schema: T.StructType, keys: list[str], parts: int) -> DataFrame:
    """Load a table parted by a hash of ``keys``, creating it empty if need be."""
    if parts < 1:
        raise ValueError("a table has one part at least")
    properties = {PARTS: str(parts), KEYS: ",".join(keys)}
    with_part = T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])
    return ensure_table(spark, table, with_part, partition_by=[PART], properties=properties)


def ensure_scd1(spark: SparkSession, table: str, spec: TableSpec, parts: int) -> DataFrame:
    """A type 1 table of a captured table's rows and processing stamp, parted by its key."""
    return ensure_parted(spark, table, table_schema(spec), spec.keys, parts)


def _layout(spark: SparkSession, table: str, keys: list[str]) -> int:
    """Number of parts of the table; an error if they are not a hash of these keys."""
    about = {name: table_property(spark, table, name) for name in (PARTS, KEYS)}
    if not about[PARTS]:
        raise ValueError(f"{table} has no parts; create it with ensure_parted")
    if about[KEYS] != ",".join(keys):
        raise ValueError(f"{table} is parted by {about[KEYS]}, not by {','.join(keys)}")
    return int(about[PARTS])


def _point(spark: SparkSession, table: str, folder: str, parts: Iterable[int]) -> None:
    """Make the table's parts those of a staged folder; one that has no rows left is empty there."""

    def one(part: int) -> None:
        location = f"{folder}/{PART}={part}"
        fs, handle = files.open_path(spark, location)
        fs.mkdirs(handle)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({PART}={part}) LOCATION '{location}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({PART}={part}) SET LOCATION '{location}'")

    with ThreadPoolExecutor(CALLS) as calls:
        for done in [calls.submit(one, part) for part in parts]:
            done.result()
    spark.catalog.refreshTable(table)


def _merge_parts(source: DataFrame, table: str, keys: list[str], merged) -> list[int]:
    """Rewrite the parts in which ``source`` has keys; returns them.

    ``merged(target, source, small)`` is the new content of the parts read.
    """
    spark = source.sparkSession
    parts = _layout(spark, table, keys)
    source, small = stored_source(source.withColumn(PART, key_part(keys, parts)), "touched")
    touched = sorted(r[PART] for r in source.select(PART).distinct().collect())  # at most ``parts``
    if not touched:
        return []
    columns = [c for c in spark.table(table).columns if c != PART]
    target = spark.table(table).filter(F.col(PART).isin(touched)).select(*columns)
    rows = merged(target, source.drop(PART), small).select(*columns)
    folder = f"{_home(spark, table)}__{uuid.uuid4().hex}"
    (
        rows.withColumn(PART, key_part(keys, parts)).hint("rebalance", PART)
        .write.option("compression", "zstd").partitionBy(PART).parquet(folder)
    )
    _point(spark, table, folder, touched)
    return touched


def merge_touched(
    bronze: DataFrame, spec: TableSpec, table: str, as_of: Column | None = None, skip_unchanged: bool = False
) -> list[int]:
    """Apply the newest change per key of a raw log; returns the parts that were rewritten."""

    def merged(target: DataFrame, changes: DataFrame, small: bool) -> DataFrame:
        return apply_scd1(target, changes, spec, as_of, skip_unchanged, small)

    return _merge_parts(latest_changes(bronze, spec), table, spec.keys, merged)


def upsert_touched(source: DataFrame, table: str, keys: list[str], verify: bool = True) -> list[int]:
    """Overwrite the table's rows that ``source`` has and add the others; returns the rewritten parts.

    Rows without a key match nothing and are added; all of them are in one part.
    """

    def merged(target: DataFrame, rows: DataFrame, small: bool) -> DataFrame:
        return upsert(target, check_unique(rows, keys) if verify else rows, keys, small=small)

    return _merge_parts(source, table, keys, merged)


def _home(spark: SparkSession, table: str) -> str:
    return table_property(spark, table, "Location").rstrip("/")


def part_folders(spark: SparkSession, table: str) -> dict[int, str]:
    """Where the catalog finds each part; one call a part."""

    def one(part: int) -> tuple[int, str]:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({PART}={part})").collect()
        places = [r["data_type"] for r in rows if r["col_name"] == "Location"]
        return part, places[0]  # the partition's own comes before the table's

    known = [int(r["partition"].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    with ThreadPoolExecutor(CALLS) as calls:
        return dict(calls.map(one, known))


def drop_replaced(spark: SparkSession, table: str, unused_for: float = 86_400) -> int:
    """Delete folders that no part points to any more; returns how many.

    Only those written more than ``unused_for`` seconds ago go, so queries planned before a merge
    may end.
    """
    fs, home = files.open_path(spark, _home(spark, table))

    def plain(path: str) -> str:
        return files.open_path(spark, path)[1].toUri().getPath()

    used = {plain(p) for p in part_folders(spark, table).values()}
    latest = spark._jvm.java.lang.System.currentTimeMillis() - unused_for * 1000
    staged = files.open_path(spark, f"{home.toString()}__*/{PART}=*")[1]
    gone = 0
    for status in fs.globStatus(staged) or []:
        path = status.getPath()
        if plain(path.toString()) not in used and status.getModificationTime() <= latest:
            gone += bool(fs.delete(path, True))
    return gone
