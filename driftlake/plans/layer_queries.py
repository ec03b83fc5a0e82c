"""Queries over the given tables: namespaces, seeds, appends, promotion, previews."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.functions.casts import epoch_millis
from driftlake.plans.feeds import table
from driftlake.plans.layers import (
    append,
    ensure_table,
    list_tables,
    new_namespace,
    promote,
    seed_if_missing,
)
from driftlake.sources.tables import click_event_schema, preview, table_exists, typed_rows

SILVER = "id BIGINT, name STRING, balance DOUBLE, processed_at TIMESTAMP, processed_date DATE"


def scan(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")


def sorted_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").orderBy("c_custkey")


def first_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return preview(orders, 10, ["o_orderkey"])


def seeded_once(spark, sf_dir):
    """The second seed finds the table and changes nothing."""
    name = f"{new_namespace(spark, 'seed')}.customers"
    customers = table(spark, sf_dir, "customer")
    first = seed_if_missing(spark, name, lambda: customers)
    second = seed_if_missing(spark, name, lambda: table(spark, sf_dir, "supplier"))
    seeded = F.lit(first and not second and table_exists(spark, name))
    return spark.table(name).select("c_custkey", "c_acctbal", seeded.alias("seeded_once"))


def listing(spark, sf_dir):
    """Tables of a namespace after seeding it with whole given tables."""
    namespace = new_namespace(spark, "listing")
    for name in ("customer", "orders", "supplier"):
        seed_if_missing(spark, f"{namespace}.{name}", lambda n=name: table(spark, sf_dir, n))
    counts = [
        spark.table(f"{namespace}.{row.tableName}").agg(
            F.lit(row.tableName).alias("table_name"), F.count(F.lit(1)).alias("n")
        )
        for row in list_tables(spark, namespace).filter("NOT isTemporary").collect()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def typed_append(spark, sf_dir):
    """Click events appended to a table with a fixed schema, twice."""
    name = f"{new_namespace(spark, 'clicks')}.web_hits"
    ensure_table(spark, name, click_event_schema())
    events = table(spark, sf_dir, "events")
    clicks = events.select(
        F.col("user_id").cast("int").alias("id"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("u"), "event_id").alias("user_id"),
        F.col("event_type").alias("action"),
        F.when(F.col("event_type") != "purchase", F.col("props")).alias("page"),
        "value",
    )
    append(clicks.filter("action = 'purchase'"), name)
    append(clicks.filter("action <> 'purchase'"), name)
    return spark.table(name).withColumn("event_time", epoch_millis(F.col("event_time")))


def literal_rows(spark, sf_dir):
    """A literal table under a schema, joined with a large one; only the literals travel."""
    names = [("signup", "c"), ("view", "r"), ("click", "u"), ("purchase", "u"), ("error", "d")]
    operations = typed_rows(spark, names, "event_type STRING, op STRING")
    events = table(spark, sf_dir, "events")
    return events.join(operations, "event_type").groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def insert_selected(spark, sf_dir):
    """Append a query result and literal rows to a date-partitioned table."""
    name = f"{new_namespace(spark, 'silver')}.customers"
    ensure_table(spark, name, T.StructType.fromDDL(SILVER), partition_by=["processed_date"])
    day = F.lit("2024-01-01")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        day.cast("timestamp").alias("processed_at"),
        day.cast("date").alias("processed_date"),
    )
    append(customers, name)
    literal = typed_rows(spark, [(-1, "Seeded", 1.5)], "id BIGINT, name STRING, balance DOUBLE")
    append(
        literal.select("*", day.cast("timestamp").alias("processed_at"),
                       F.lit("2024-01-02").cast("date").alias("processed_date")),
        name,
    )
    spark.sql(
        f"INSERT INTO {name} VALUES (CAST('-2' AS BIGINT), 'Inserted', 2.5, "
        "TIMESTAMP '2024-01-01 00:00:00', DATE '2024-01-02')"
    )
    return spark.table(name).select(
        "id", "name", "balance", F.col("processed_date").cast("string").alias("processed_date")
    )


def promoted(spark, sf_dir):
    """Raw to refined to serving layer; repeating a step leaves the table as it is."""
    bronze, silver, gold = (new_namespace(spark, layer) for layer in ("bronze", "silver", "gold"))
    promote(table(spark, sf_dir, "orders"), f"{bronze}.orders")
    refined = spark.table(f"{bronze}.orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    promote(refined, f"{silver}.orders", partition_by=["order_year"])
    promote(refined.filter("order_year = 0"), f"{silver}.orders", partition_by=["order_year"])
    promote(spark.table(f"{silver}.orders"), f"{gold}.orders")
    return spark.table(f"{gold}.orders")


QUERIES = {
    "s_table_scan": (scan, "SELECT c_custkey, c_name, c_acctbal FROM customer"),
    "o_sorted": (sorted_rows, "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey"),
    "o_sorted_limit": (
        first_rows,
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    ),
    "c_seed_if_missing": (
        seeded_once,
        "SELECT c_custkey, c_acctbal, true AS seeded_once FROM customer",
    ),
    "c_listing": (
        listing,
        """SELECT 'customer' AS table_name, count(*) AS n FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'supplier', count(*) FROM supplier""",
    ),
    "k_typed_append": (
        typed_append,
        """SELECT CAST(user_id AS INTEGER) AS id, epoch_us(ts) // 1000 AS event_time,
               'u' || event_id AS user_id, event_type AS action,
               CASE WHEN event_type <> 'purchase' THEN props END AS page, value
        FROM events""",
    ),
    "s_literal_rows": (
        literal_rows,
        """SELECT op, count(*) AS n FROM events JOIN (VALUES ('signup', 'c'), ('view', 'r'),
               ('click', 'u'), ('purchase', 'u'), ('error', 'd')) o(event_type, op)
               USING (event_type) GROUP BY op""",
    ),
    "k_insert_values": (
        insert_selected,
        """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance,
               '2024-01-01' AS processed_date FROM customer
        UNION ALL SELECT -1, 'Seeded', 1.5, '2024-01-02'
        UNION ALL SELECT -2, 'Inserted', 2.5, '2024-01-02'""",
    ),
    "p_promote": (
        promoted,
        """SELECT o_orderkey, o_custkey, o_totalprice,
               CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""",
    ),
}
