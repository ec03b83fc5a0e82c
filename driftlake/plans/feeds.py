"""Change feeds derived from the given tables: whole tables re-told as change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.functions.casts import epoch_millis
from driftlake.functions.payload import pack_record
from driftlake.spec import TableSpec

EVENTS = TableSpec(
    "events",
    {"user_id": "bigint"},
    {"event_type": "string", "value": "double", "props": "string"},
    topic="shop.activity.events",
)
ORDERS = TableSpec(
    "orders",
    {"o_custkey": "bigint"},
    {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderpriority": "string"},
    topic="shop.sales.orders",
)
LINES = TableSpec(
    "lineitem",
    {"l_orderkey": "bigint", "l_linenumber": "int"},
    {"l_quantity": "double", "l_linestatus": "string"},
    topic="shop.sales.lineitem",
)
TURNS = TableSpec(
    "conversations",
    {"conv_id": "bigint", "turn": "bigint"},
    {"role": "string", "text": "string"},
    topic="shop.support.conversations",
)
CUSTOMERS = TableSpec(
    "customer",
    {"c_custkey": "bigint"},
    {"c_name": "string", "c_acctbal": "double"},
    topic="shop.sales.customer",
)


# Two captured tables whose records look alike and whose keys have the same name.
ACTIVITY = TableSpec("activity", {"id": "bigint"}, {"amount": "double"}, topic="shop.activity.amounts")
SALES = TableSpec("sales", {"id": "bigint"}, {"amount": "double"}, topic="shop.sales.amounts")

# Bytes of a row group of a topic's files.  Spark deals files out in pieces of 4 MB and more.
TOPIC_GROUP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def envelope(spec: TableSpec, op: Column, ts_ms: Column, lsn: Column) -> Column:
    """One change envelope from columns named as in the spec; a delete only has ``before``."""
    row = F.struct(*spec.row_columns)
    deleted = F.lower(op) == "d"
    return pack_record(
        F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
        F.struct(ts_ms.alias("ts_ms"), lsn.alias("lsn")).alias("source"),
    )


def mapped(column: str, codes: dict[str, str], otherwise: str) -> Column:
    """CASE over a column's values."""
    case = F
    for value, code in codes.items():
        case = case.when(F.col(column) == value, code)
    return case.otherwise(otherwise)


EVENT_OPS = {"signup": "c", "view": "r", "error": "d"}
ORDER_OPS = {"F": "d", "P": "c"}
LINE_OPS = {"R": "d", "N": "c"}


def event_op() -> Column:
    return mapped("event_type", EVENT_OPS, "u")


def event_changes(events: DataFrame) -> DataFrame:
    """events as topic rows: one change per event, keyed by user."""
    millis = epoch_millis(F.col("ts"))
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        envelope(EVENTS, event_op(), millis, F.col("event_id")).alias("value"),
        F.lit(EVENTS.topic).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis(millis).alias("timestamp"),
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """orders as topic rows: the newest order of a customer is the customer's state."""
    millis = epoch_millis(F.col("o_orderdate"))
    op = mapped("o_orderstatus", ORDER_OPS, "u")
    return orders.select(
        F.col("o_custkey").cast("string").alias("key"),
        envelope(ORDERS, op, millis, F.col("o_orderkey")).alias("value"),
        F.lit(ORDERS.topic).alias("topic"),
        F.pmod("o_custkey", F.lit(4)).cast("int").alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.timestamp_millis(millis).alias("timestamp"),
    )


def amount_changes(rows: DataFrame, spec: TableSpec, key: str, amount: str, op: Column, ms: Column, lsn: str) -> DataFrame:
    """Rows of any table as topic rows of ACTIVITY or SALES."""
    told = rows.select(
        F.col(key).alias("id"), F.col(amount).alias("amount"), op.alias("op"), ms.alias("ms"), F.col(lsn).alias("lsn"))
    return told.select(
        F.col("id").cast("string").alias("key"),
        envelope(spec, F.col("op"), F.col("ms"), F.col("lsn")).alias("value"),
        F.lit(spec.topic).alias("topic"),
        F.pmod("id", F.lit(4)).cast("int").alias("partition"),
        F.col("lsn").alias("offset"),
        F.timestamp_millis("ms").alias("timestamp"),
    )


def mixed_changes(events: DataFrame, orders: DataFrame) -> DataFrame:
    """events as ACTIVITY and orders as SALES, in one topic folder."""
    activity = amount_changes(
        events, ACTIVITY, "user_id", "value", event_op(), epoch_millis(F.col("ts")), "event_id")
    status = mapped("o_orderstatus", ORDER_OPS, "u")
    sales = amount_changes(
        orders, SALES, "o_custkey", "o_totalprice", status, epoch_millis(F.col("o_orderdate")), "o_orderkey")
    return activity.unionByName(sales)


def line_changes(lineitem: DataFrame) -> DataFrame:
    """lineitem as raw rows with a two-part key."""
    op = mapped("l_returnflag", LINE_OPS, "u")
    payload = envelope(LINES, op, epoch_millis(F.col("l_shipdate")), F.col("l_partkey"))
    return lineitem.select(payload.alias("payload"))


def turn_changes(conversations: DataFrame) -> DataFrame:
    """conversations as raw rows: every turn is written, assistant turns are edited
    afterwards, system turns are deleted afterwards."""
    later = F.when(F.col("role") == "assistant", "u").when(F.col("role") == "system", "d")
    steps = conversations.withColumn("op", F.explode(F.array(F.lit("c"), later)))
    edited = F.when(F.col("op") == "u", F.concat("text", F.lit(" [edited]"))).otherwise(
        F.col("text")
    )
    written = steps.filter(F.col("op").isNotNull()).withColumn("text", edited)
    version = F.when(F.col("op") == "c", 1).otherwise(2)
    return written.select(
        envelope(TURNS, F.col("op"), version, F.col("turn")).alias("payload")
    )


def customer_snapshot(customer: DataFrame) -> DataFrame:
    """customer as raw rows of an initial snapshot."""
    payload = envelope(CUSTOMERS, F.lit("r"), F.lit(0), F.lit(0))
    return customer.select(payload.alias("payload"))


def balance_changes(orders: DataFrame) -> DataFrame:
    """orders as topic rows that change customers: a new balance, or the customer goes."""
    millis = epoch_millis(F.col("o_orderdate"))
    rows = orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderpriority").alias("c_name"),
        F.col("o_totalprice").alias("c_acctbal"),
        mapped("o_orderstatus", {"F": "d"}, "u").alias("op"),
        millis.alias("ms"),
        "o_orderkey",
    )
    return rows.select(
        F.col("c_custkey").cast("string").alias("key"),
        envelope(CUSTOMERS, F.col("op"), F.col("ms"), F.col("o_orderkey")).alias("value"),
        F.lit(CUSTOMERS.topic).alias("topic"),
        F.pmod("c_custkey", F.lit(4)).cast("int").alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.timestamp_millis("ms").alias("timestamp"),
    )


def as_raw(changes: DataFrame) -> DataFrame:
    """Topic rows as raw rows whose values are known to be JSON objects."""
    return changes.select(F.col("value").alias("payload"), "topic", "partition", "offset")


def spread(rows: DataFrame, column: str) -> DataFrame:
    """The rows dealt over the tasks by a column of many values, in however few row groups they are stored."""
    return rows.repartition(column)


def write_topic(changes: DataFrame, path: str, waves: int = 8, mode: str = "append") -> str:
    """Store topic rows as files that arrive out of order.

    Each task spreads its rows over ``waves`` files by hash; no shuffle.  Row groups are small, so that
    many tasks can share the reading of a file.
    """
    wave = F.pmod(F.xxhash64("key", "offset"), F.lit(waves))
    rows = changes.withColumn("wave", wave).write.mode(mode).option("compression", "zstd")
    rows = rows.option("parquet.block.size", TOPIC_GROUP_BYTES)
    rows.partitionBy("wave").parquet(path)
    return path
