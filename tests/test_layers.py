"""Namespaces, tables, promotion, sessions and the shared folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake import session
from driftlake.plans import (
    append,
    ensure_namespace,
    ensure_table,
    list_catalogs,
    list_namespaces,
    list_tables,
    merge_changes,
    promote,
    seed_if_missing,
    upsert_rows,
)
from driftlake.plans.layers import new_namespace
from driftlake.sources import click_event_schema, preview, table_exists, typed_rows
from driftlake.sources.changes import broker_options, table_topic
from driftlake.spec import TableSpec

SEED = [
    (11, "Ada", "Quist", "ada@example.org"),
    (12, "Bo", "Renner", "bo@example.org"),
    (13, "Cy", "Stone", None),
]
SEED_SCHEMA = "id BIGINT, first_name STRING, last_name STRING, email STRING"


def test_seed_list_and_preview(spark):
    ensure_namespace(spark, "bronze_inventory")
    ensure_namespace(spark, "bronze_inventory")
    name = "bronze_inventory.customers"
    assert not table_exists(spark, name)
    assert seed_if_missing(spark, name, lambda: typed_rows(spark, SEED, SEED_SCHEMA))
    assert not seed_if_missing(spark, name, lambda: pytest.fail("must not be built"))
    assert table_exists(spark, name)
    assert [r.tableName for r in list_tables(spark, "bronze_inventory").collect()] == ["customers"]
    assert "bronze_inventory" in {r.namespace for r in list_namespaces(spark).collect()}
    assert "spark_catalog" in {r.catalog for r in list_catalogs(spark).collect()}
    assert [tuple(r) for r in preview(spark.table(name), 2, ["id"]).collect()] == SEED[:2]
    assert preview(spark.table(name), 2).count() == 2


def test_ordered_preview_is_a_top_n(spark):
    plan = preview(spark.range(1000), 10, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_typed_rows_append(spark):
    ensure_namespace(spark, "stream_in")
    name = "stream_in.web_hits"
    assert ensure_table(spark, name, click_event_schema()).count() == 0
    rows = [
        (1, dt.datetime(2025, 5, 1, 8, 15, 0, 250), "u1", "click", "/start", 0.5),
        (2, dt.datetime(2025, 5, 1, 8, 16), "u2", "purchase", None, 12.0),
    ]
    clicks = typed_rows(spark, rows, click_event_schema())
    append(clicks, name)
    append(clicks.select(*reversed(clicks.columns)), name)  # by name, not by position
    assert sorted(map(tuple, spark.table(name).distinct().collect())) == rows
    assert ensure_table(spark, name, click_event_schema()).count() == 4
    assert spark.table(name).schema == click_event_schema()
    with pytest.raises(ValueError, match="page"):
        append(clicks.drop("page"), name)


def test_date_partitioned_table_and_properties(spark):
    ensure_namespace(spark, "silver_stream")
    schema = T.StructType.fromDDL("id BIGINT, processed_at TIMESTAMP, processed_date DATE")
    name = "silver_stream.customers"
    ensure_table(spark, name, schema, partition_by=["processed_date"], properties={"owner_team": "de"})
    day = F.to_date(F.lit("2024-01-05"))
    append(spark.range(3).select("id", day.cast("timestamp").alias("processed_at"), day.alias("processed_date")), name)
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["processed_date=2024-01-05"]
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["owner_team"] == "de"
    with pytest.raises(Exception, match="UNSUPPORTED|transform"):
        ensure_table(spark, "silver_stream.by_day", schema, partition_by=["days(processed_at)"])


def test_promote_is_create_if_not_exists(spark):
    for layer in ("l_bronze", "l_silver", "l_gold"):
        ensure_namespace(spark, layer)
    promote(spark.sql("SELECT * FROM VALUES (5L, 1.5D), (6L, 2.5D) AS t(id, amount)"), "l_bronze.events")
    promote(spark.table("l_bronze.events").select("id", "amount"), "l_silver.day_sums")
    promote(spark.table("l_bronze.events").limit(0), "l_silver.day_sums")
    promote(spark.table("l_silver.day_sums"), "l_gold.scores")
    assert sorted(map(tuple, spark.table("l_gold.scores").collect())) == [(5, 1.5), (6, 2.5)]


def test_partitioned_promote_writes_few_files(spark):
    ensure_namespace(spark, "l_parts")
    rows = spark.range(0, 4000, 1, 16).withColumn("part", F.col("id") % 4)
    promote(rows, "l_parts.t", partition_by=["part"])
    assert spark.table("l_parts.t").count() == 4000
    assert len(spark.table("l_parts.t").inputFiles()) < 16


def test_upsert_and_merge_on_catalog_tables(spark, settings):
    settings(spark__sql__sources__partitionOverwriteMode="dynamic")
    name = f"{new_namespace(spark, 'jobs')}.silver"
    schema = T.StructType.fromDDL(f"{SEED_SCHEMA}, processed_at TIMESTAMP, processed_date DATE")
    ensure_table(spark, name, schema, partition_by=["processed_date"])

    def stamped(rows, day):
        stamp = F.lit(day).cast("timestamp")
        seed = typed_rows(spark, rows, SEED_SCHEMA)
        return seed.withColumn("processed_at", stamp).withColumn("processed_date", F.to_date(stamp))

    upsert_rows(stamped(SEED, "2024-01-01"), name, ["id"])
    upsert_rows(stamped([(12, "G", "B", None), (14, "N", "N", "n")], "2024-01-02"), name, ["id"])
    upsert_rows(stamped([], "2024-01-03"), name, ["id"])

    def rows():
        table = spark.table(name)
        return sorted(map(tuple, table.selectExpr("id", "first_name", "email", "cast(processed_date AS STRING)").collect()))

    assert rows() == [
        (11, "Ada", "ada@example.org", "2024-01-01"), (12, "G", None, "2024-01-02"),
        (13, "Cy", None, "2024-01-01"), (14, "N", "n", "2024-01-02"),
    ]
    customers = TableSpec("c", {"id": "bigint"}, {c: "string" for c in ("first_name", "last_name", "email")})
    log = typed_rows(spark, [('{"before":{"id":11},"op":"d"}',), ('{"id":13,"first_name":"Ed"}',)], "payload STRING")
    merge_changes(log, customers, name, F.lit("2024-01-04").cast("timestamp"))
    assert rows() == [
        (12, "G", None, "2024-01-02"), (13, "Ed", None, "2024-01-04"), (14, "N", "n", "2024-01-02"),
    ]
    # The first test of a format with row-level operations is Spark's own; parquet has none.
    for native in (
        lambda: upsert_rows(stamped(SEED, "2024-01-01"), name, ["id"], native=True),
        lambda: merge_changes(log, customers, name, native=True),
    ):
        with pytest.raises(Exception, match="MERGE|merge"):
            native()


def test_layer_catalog_settings():
    settings = session.layer_catalogs(
        {"bronze": {"class": "x.Catalog", "type": "rest", "uri": "u"}, "silver": {"class": "x.Catalog"}}
    )
    assert settings == {
        "spark.sql.catalog.bronze": "x.Catalog",
        "spark.sql.catalog.bronze.type": "rest",
        "spark.sql.catalog.bronze.uri": "u",
        "spark.sql.catalog.silver": "x.Catalog",
    }


class Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, configured=None):
        self.conf = type("Conf", (), {"get": lambda _, name, default=None: configured or default})()
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: None})()


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(Session("yarn", "/some/shared/")) == "/some/shared"
    one, two = (session.work_dir(Session("yarn", "/some/shared/"), "x") for _ in range(2))
    assert one != two and one.startswith("/some/shared/driftlake/x-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("yarn"))


def test_literal_rows_have_a_known_size(spark):
    small = typed_rows(spark, [("a", 1)], "k STRING, n INT")
    big = spark.range(10**6).select(F.col("id").cast("string").alias("k"))
    plan = big.join(small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert typed_rows(spark, [], "k STRING, n INT").count() == 0


def test_broker_options():
    assert broker_options(["a", "b"], True) == {"startingOffsets": "earliest", "subscribe": "a,b"}
    bounded = broker_options([], False, {"subscribePattern": "shop[.].*", "maxOffsetsPerTrigger": "9"})
    assert bounded == {
        "startingOffsets": "earliest", "endingOffsets": "latest",
        "subscribePattern": "shop[.].*", "maxOffsetsPerTrigger": "9",
    }
    assert broker_options(["a"], True, {"startingOffsets": "latest"})["startingOffsets"] == "latest"


def test_topic_names():
    assert table_topic("shop", "inventory", "orders") == "shop.inventory.orders"
