"""Queries over the given tables: type 1 merge, upsert and their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.operators.merge import STAMP, apply_scd1, repeated_keys, upsert
from driftlake.plans import feeds
from driftlake.plans.decode_queries import ORDER_ROWS
from driftlake.plans.feeds import ORDERS, table
from driftlake.plans.layers import ensure_table, new_namespace, seed_if_missing
from driftlake.plans.refine import (
    DAY,
    latest_changes,
    merge_changes,
    refine,
    table_schema,
    upsert_rows,
)
from driftlake.plans.touched import PART, ensure_scd1, key_part, merge_touched
from driftlake.session import scratch_dir

# Orders before this day make the target, the others are the changes to apply.
CUTOFF = "2001-01-01"
FIRST_RUN = "2001-01-01"
SECOND_RUN = "2001-08-02"
# Parts of the table that is merged part by part.
PARTS = 16


def _stamp(day: str):
    return F.lit(day).cast("timestamp")


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    day = F.lit(CUTOFF).cast("timestamp_ntz")
    before = orders.filter(F.col("o_orderdate") < day)
    since = orders.filter(F.col("o_orderdate") >= day)
    return tuple(feeds.as_raw(feeds.order_changes(part)).select("payload") for part in (before, since))


def _target(before: DataFrame) -> DataFrame:
    """The table as the first run left it."""
    changes = latest_changes(before, ORDERS)
    alive = changes.filter(F.col("op") != "d")
    return alive.select(*ORDERS.row_columns, _stamp(FIRST_RUN).alias(STAMP))


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DAY, F.to_date(STAMP).cast("string")).drop(STAMP)


def scd1(spark, sf_dir):
    """Every cell of matched/unmatched x upsert/delete/untouched occurs."""
    before, since = _split(spark, sf_dir)
    changes = latest_changes(since, ORDERS)
    return _with_day(apply_scd1(_target(before), changes, ORDERS, _stamp(SECOND_RUN)))


def scd1_rerun(spark, sf_dir):
    """Applying the same changes again only restamps the rows they touch."""
    before, since = _split(spark, sf_dir)
    changes = latest_changes(since, ORDERS)
    once = apply_scd1(_target(before), changes, ORDERS, _stamp(CUTOFF))
    return _with_day(apply_scd1(once, changes, ORDERS, _stamp(SECOND_RUN)))


def refine_two_runs(spark, sf_dir):
    """Two batch jobs on a stored table, one folder per processing day."""
    before, since = _split(spark, sf_dir)
    path = scratch_dir(spark, "scd1-table")
    refine(before, ORDERS, path, _stamp(FIRST_RUN))
    refine(since, ORDERS, path, _stamp(SECOND_RUN))
    # Read as its consumers do: the folder column comes back as a date.
    rows = spark.read.parquet(f"{path}/{1:012d}")
    return rows.withColumn(DAY, F.col(DAY).cast("string")).drop(STAMP)


def scd1_catalog_table(spark, sf_dir):
    """The same two runs on a catalog table parted by processing day."""
    before, since = _split(spark, sf_dir)
    name = f"{new_namespace(spark, 'scd1')}.orders"
    schema = table_schema(ORDERS).add(DAY, "date")
    ensure_table(spark, name, schema, partition_by=[DAY])
    merge_changes(before, ORDERS, name, _stamp(FIRST_RUN))
    merge_changes(since, ORDERS, name, _stamp(SECOND_RUN))
    return spark.table(name).withColumn(DAY, F.col(DAY).cast("string")).drop(STAMP)


def scd1_touched_parts(spark, sf_dir):
    """The same two runs on a table parted by its key; the second one in four merges, each of which
    rewrites a quarter of the parts and leaves the others alone."""
    before, _ = _split(spark, sf_dir)
    name = f"{new_namespace(spark, 'touched')}.orders"
    ensure_scd1(spark, name, ORDERS, PARTS)
    merge_touched(before, ORDERS, name, _stamp(FIRST_RUN))
    orders = table(spark, sf_dir, "orders")
    since = orders.filter(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    quarter = F.pmod(key_part(ORDERS.keys, PARTS), F.lit(4))
    for n in range(4):
        changes = feeds.as_raw(feeds.order_changes(since.filter(quarter == n))).select("payload")
        merge_touched(changes, ORDERS, name, _stamp(SECOND_RUN))
    return _with_day(spark.table(name).drop(PART))


def upsert_catalog_table(spark, sf_dir):
    """Raw typed table to refined table, twice; rows gone from the raw table stay."""
    customers = _customers(spark, sf_dir)
    bronze, silver = (f"{new_namespace(spark, layer)}.customers" for layer in ("bronze", "silver"))
    seed_if_missing(spark, bronze, lambda: customers)
    schema = customers.schema.add(DAY, "date")
    ensure_table(spark, silver, schema, partition_by=[DAY])
    raw = spark.table(bronze)
    upsert_rows(raw.withColumn(DAY, F.lit(FIRST_RUN).cast("date")), silver, ["c_custkey"])
    changed = raw.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    upsert_rows(changed.withColumn(DAY, F.lit(SECOND_RUN).cast("date")), silver, ["c_custkey"])
    return spark.table(silver).withColumn(DAY, F.col(DAY).cast("string"))


def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def upsert_sql_source(spark, sf_dir):
    """Source as a subquery with computed columns over a temp view."""
    customers = _customers(spark, sf_dir)
    target = customers.filter("c_mktsegment <> 'AUTOMOBILE'").withColumn(DAY, F.lit(FIRST_RUN))
    customers.createOrReplaceTempView("driftlake_customers")
    source = spark.sql(
        f"""SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal, c_mktsegment,
                   '{SECOND_RUN}' AS {DAY}
            FROM driftlake_customers WHERE c_mktsegment <> 'FURNITURE'"""
    )
    return upsert(target, source, ["c_custkey"])


def _rebalanced(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    customers = _customers(spark, sf_dir).withColumn(DAY, F.lit(FIRST_RUN))
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100)
    source = customers.withColumn("c_acctbal", F.coalesce(raised, "c_acctbal"))
    return customers, source.withColumn(DAY, F.lit(SECOND_RUN))


def upsert_skip_unchanged(spark, sf_dir):
    target, source = _rebalanced(spark, sf_dir)
    attributes = ["c_name", "c_acctbal", "c_mktsegment"]
    return upsert(target, source, ["c_custkey"], skip_unchanged=attributes)


def scd1_skip_unchanged(spark, sf_dir):
    """Deleting and overwriting as ever, but an equal row keeps its stamp."""
    before, since = _split(spark, sf_dir)
    target = _target(before)
    changes = latest_changes(since, ORDERS)
    once = apply_scd1(target, changes, ORDERS, _stamp(CUTOFF))
    again = apply_scd1(once, changes, ORDERS, _stamp(SECOND_RUN), skip_unchanged=True)
    return _with_day(again)


def upsert_null_keys(spark, sf_dir):
    """Rows without a key match nothing: the target's stay, the source's are added."""
    target, source = _rebalanced(spark, sf_dir)
    unkeyed = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey"))
    return upsert(
        target.withColumn("c_custkey", unkeyed),
        source.withColumn("c_custkey", unkeyed),
        ["c_custkey"],
    )


def repeated_source_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return repeated_keys(orders, ["o_custkey"]).select("o_custkey", F.col("count").alias("n"))


DAY_MS = f"epoch_us(TIMESTAMP '{CUTOFF}') // 1000"
ORDER_STATE = f"""
    WITH changes AS ({ORDER_ROWS}),
    old AS (SELECT * FROM (
        SELECT * FROM changes WHERE version < {DAY_MS}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC, lsn DESC) = 1)
        WHERE op <> 'd'),
    new AS (SELECT * FROM changes WHERE version >= {DAY_MS}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC, lsn DESC) = 1)
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, '{{touched}}' AS processed_date
    FROM new WHERE op <> 'd'
    UNION ALL
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, '{FIRST_RUN}'
    FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)"""

RAISED_BUILDING = f"""
    SELECT c_custkey, c_name, c_mktsegment,
           CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '{SECOND_RUN}' ELSE '{FIRST_RUN}' END
               AS processed_date
    FROM customer"""

QUERIES = {
    "m_scd1": (scd1, ORDER_STATE.format(touched=SECOND_RUN)),
    "m_rerun": (scd1_rerun, ORDER_STATE.format(touched=SECOND_RUN)),
    "m_refine_two_runs": (refine_two_runs, ORDER_STATE.format(touched=SECOND_RUN)),
    "m_scd1_table": (scd1_catalog_table, ORDER_STATE.format(touched=SECOND_RUN)),
    "m_scd1_touched": (scd1_touched_parts, ORDER_STATE.format(touched=SECOND_RUN)),
    "m_upsert_table": (upsert_catalog_table, RAISED_BUILDING),
    "m_scd1_skip_unchanged": (scd1_skip_unchanged, ORDER_STATE.format(touched=CUTOFF)),
    "m_upsert": (
        upsert_sql_source,
        f"""SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal, c_mktsegment,
               '{SECOND_RUN}' AS processed_date
        FROM customer WHERE c_mktsegment <> 'FURNITURE'
        UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment, '{FIRST_RUN}'
        FROM customer WHERE c_mktsegment = 'FURNITURE'""",
    ),
    "m_skip_unchanged": (upsert_skip_unchanged, RAISED_BUILDING),
    "m_null_keys": (
        upsert_null_keys,
        f"""SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS c_custkey,
               c_name, c_mktsegment,
               CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END
                   AS c_acctbal, '{SECOND_RUN}' AS processed_date
        FROM customer
        UNION ALL SELECT NULL, c_name, c_mktsegment, c_acctbal, '{FIRST_RUN}'
        FROM customer WHERE c_mktsegment = 'MACHINERY'""",
    ),
    "m_cardinality": (
        repeated_source_keys,
        "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1",
    ),
}
