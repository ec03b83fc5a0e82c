"""Queries over the given tables: streams, raw layer, archive and incremental state.

Each callable streams a whole table through files in the shared folder and returns what a
reader finds there afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.operators.envelope import decode, valid_changes
from driftlake.operators.latest import latest_per_key
from driftlake.operators.routing import route
from driftlake.plans import feeds
from driftlake.plans.decode_queries import EVENT_ROWS, LATEST_EVENTS, LATEST_ORDERS
from driftlake.plans.feeds import CUSTOMERS, EVENTS, ORDERS, table
from driftlake.plans.refine import live_rows, refine
from driftlake.session import scratch_dir
from driftlake.sources.changes import read_changes, read_raw, replay_options
from driftlake.streaming.bronze import (
    start_archive,
    start_bronze,
    start_bronze_batches,
    to_bronze,
)
from driftlake.streaming.counts import read_counts, start_counted
from driftlake.streaming.latest import fold_latest, read_latest, start_latest
from driftlake.streaming.ledger import (
    apply_batch,
    compact,
    current_view,
    start_scd1,
    start_scd1_tables,
    wait_for_compactions,
)

BATCHES = 8


def _stream(spark, topic: str, batches: int = BATCHES) -> DataFrame:
    options = replay_options(spark, topic, batches)
    return read_changes(spark, "parquet", topic, options=options)


def _event_topic(spark, sf_dir, root: str) -> str:
    changes = feeds.event_changes(table(spark, sf_dir, "events"))
    return feeds.write_topic(changes, f"{root}/topic")


def bronze_roundtrip(spark, sf_dir):
    """Topic to raw table through the file sink, a user hook in between, and decoded back."""
    root = scratch_dir(spark, "bronze")
    topic = _event_topic(spark, sf_dir, root)
    bronze = to_bronze(_stream(spark, topic, 2), hook=lambda rows: rows.filter("key IS NOT NULL"))
    start_bronze(bronze, f"{root}/checkpoint", f"{root}/bronze").awaitTermination()
    raw = read_raw(spark, f"{root}/bronze").drop("ingest_ts")
    return valid_changes(decode(raw, EVENTS), EVENTS)


def topic_replay(spark, sf_dir):
    """Bounded read of a topic from its beginning."""
    root = scratch_dir(spark, "replay")
    topic = _event_topic(spark, sf_dir, root)
    rows = read_changes(spark, "parquet", topic, topics=[EVENTS.topic], streaming=False)
    return rows.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def archive_json(spark, sf_dir):
    root = scratch_dir(spark, "archive")
    topic = _event_topic(spark, sf_dir, root)
    query = start_archive(_stream(spark, topic, 2), f"{root}/archive", f"{root}/checkpoint")
    query.awaitTermination()
    back = read_changes(spark, "json", f"{root}/archive", streaming=False)
    raw = back.select("key", "topic", "partition", "offset", F.col("value").alias("payload"))
    return decode(raw, EVENTS).select("key", "topic", "partition", "offset", *EVENTS.row_columns, "op")


def duplicate_delivery(spark, sf_dir):
    """Every append is repeated, as after a lost acknowledgement; the result is not affected."""
    root = scratch_dir(spark, "duplicates")
    topic = _event_topic(spark, sf_dir, root)

    def append_twice(batch: DataFrame) -> None:
        for _ in range(2):
            batch.write.mode("append").parquet(f"{root}/bronze")

    bronze = to_bronze(_stream(spark, topic, 2))
    start_bronze_batches(bronze, append_twice, f"{root}/checkpoint").awaitTermination()
    return live_rows(spark.read.parquet(f"{root}/bronze").select("payload"), EVENTS)


def multi_table(spark, sf_dir):
    """Two captured tables in one stream and one raw table, told apart by topic."""
    root = scratch_dir(spark, "multi")
    topic = f"{root}/topic"
    feeds.write_topic(feeds.event_changes(table(spark, sf_dir, "events")), topic)
    feeds.write_topic(feeds.order_changes(table(spark, sf_dir, "orders")), topic)
    bronze = to_bronze(_stream(spark, topic, 2))
    start_bronze(bronze, f"{root}/checkpoint", f"{root}/bronze").awaitTermination()
    routed = route(read_raw(spark, f"{root}/bronze").drop("ingest_ts"), [EVENTS, ORDERS])
    events = latest_per_key(routed["events"], EVENTS).select(
        F.lit("events").alias("source"), F.col("user_id").alias("id"), "op", "version", "lsn",
        F.col("value").alias("amount"),
    )
    orders = latest_per_key(routed["orders"], ORDERS).select(
        F.lit("orders").alias("source"), F.col("o_custkey").alias("id"), "op", "version", "lsn",
        F.col("o_totalprice").alias("amount"),
    )
    return events.unionByName(orders)


def multi_table_state(spark, sf_dir):
    """Two captured tables kept up to date by one query."""
    root = scratch_dir(spark, "multi-state")
    topic = f"{root}/topic"
    feeds.write_topic(feeds.event_changes(table(spark, sf_dir, "events")), topic)
    feeds.write_topic(feeds.order_changes(table(spark, sf_dir, "orders")), topic)
    targets = [(EVENTS, f"{root}/events"), (ORDERS, f"{root}/orders")]
    bronze = to_bronze(_stream(spark, topic, 2))
    start_scd1_tables(bronze, targets, f"{root}/checkpoint").awaitTermination()
    events = current_view(spark, f"{root}/events", EVENTS).select(
        F.lit("events").alias("source"), F.col("user_id").alias("id"), F.col("value").alias("amount")
    )
    orders = current_view(spark, f"{root}/orders", ORDERS).select(
        F.lit("orders").alias("source"), F.col("o_custkey").alias("id"),
        F.col("o_totalprice").alias("amount"),
    )
    return events.unionByName(orders)


def bronze_to_state(spark, sf_dir):
    """Two streams in a row: topic to raw table, raw table to state."""
    root = scratch_dir(spark, "chain")
    feeds.write_topic(feeds.order_changes(table(spark, sf_dir, "orders")), f"{root}/topic")
    bronze = to_bronze(_stream(spark, f"{root}/topic", 2))
    start_bronze(bronze, f"{root}/ingest", f"{root}/bronze").awaitTermination()
    raw = read_raw(
        spark, f"{root}/bronze", streaming=True, options=replay_options(spark, f"{root}/bronze", 2)
    )
    start_scd1(raw, ORDERS, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return current_view(spark, f"{root}/state", ORDERS)


def incremental(spark, sf_dir):
    """Micro-batches out of order with clicks delivered twice, compacted on the way."""
    root = scratch_dir(spark, "ledger")
    changes = feeds.event_changes(table(spark, sf_dir, "events"))
    feeds.write_topic(changes, f"{root}/topic")
    again = feeds.event_changes(table(spark, sf_dir, "events").filter("event_type = 'click'"))
    topic = feeds.write_topic(again, f"{root}/topic")
    bronze = to_bronze(_stream(spark, topic))
    state, checkpoint = f"{root}/state", f"{root}/checkpoint"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    start_scd1(
        bronze, EVENTS, state, checkpoint, compact_every=5, buckets=buckets
    ).awaitTermination()
    wait_for_compactions()
    return current_view(spark, state, EVENTS)


def incremental_compacted(spark, sf_dir):
    """Newer half first, then a compaction, a restart on the older half, another compaction
    into the same buckets, and a last late batch."""
    root = scratch_dir(spark, "compacted")
    state, checkpoint = f"{root}/state", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    waves = [
        events.filter(F.col("ts") >= middle),
        events.filter((F.col("ts") < middle) & (F.col("event_type") != "view")),
        events.filter((F.col("ts") < middle) & (F.col("event_type") == "view")),
    ]
    for number, wave in enumerate(waves):
        topic = feeds.write_topic(feeds.event_changes(wave), f"{root}/topic", waves=2)
        bronze = to_bronze(_stream(spark, topic, 1))
        start_scd1(bronze, EVENTS, state, checkpoint).awaitTermination()
        if number < 2:
            compact(spark, state, EVENTS, buckets)
    return current_view(spark, state, EVENTS)


def batch_metrics(spark, sf_dir):
    """Kept and dropped rows as the running stream has written them down, over all its batches."""
    root = scratch_dir(spark, "metrics")
    topic = _event_topic(spark, sf_dir, root)
    shaped = to_bronze(_stream(spark, topic, 4)).select(
        F.when(F.col("payload").contains('"event_type":"click"'), F.lit("null"))
        .otherwise(F.col("payload"))
        .alias("payload")
    )
    start_counted(shaped, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    counts = read_counts(spark, f"{root}/out")
    return counts.agg(*(F.sum(c).alias(c) for c in ("decoded", "applied", "rejected")))


def snapshot_then_changes(spark, sf_dir):
    """An initial snapshot as one batch, then the change stream into the same state."""
    root = scratch_dir(spark, "snapshot")
    state = f"{root}/state"
    apply_batch(
        feeds.customer_snapshot(table(spark, sf_dir, "customer")), "snapshot", state, CUSTOMERS
    )
    changes = feeds.balance_changes(table(spark, sf_dir, "orders"))
    topic = feeds.write_topic(changes, f"{root}/topic")
    bronze = to_bronze(_stream(spark, topic, 2))
    start_scd1(bronze, CUSTOMERS, state, f"{root}/checkpoint").awaitTermination()
    return current_view(spark, state, CUSTOMERS)


def streaming_newest(spark, sf_dir):
    """Newest change per key held in Spark's own streaming state."""
    root = scratch_dir(spark, "stream-latest")
    topic = _event_topic(spark, sf_dir, root)
    raw = to_bronze(_stream(spark, topic, 2)).select("payload")
    changes = valid_changes(decode(raw, EVENTS), EVENTS)
    start_latest(changes, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return read_latest(spark, f"{root}/out", EVENTS)


def streaming_newest_restarted(spark, sf_dir):
    """The newer half first, then the older half under a new checkpoint, into the same folder."""
    root = scratch_dir(spark, "stream-again")
    events = table(spark, sf_dir, "events")
    newer = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for number, half in enumerate((events.filter(newer), events.filter(~newer))):
        topic = feeds.write_topic(feeds.event_changes(half), f"{root}/topic-{number}", waves=2)
        changes = valid_changes(decode(to_bronze(_stream(spark, topic, 2)).select("payload"), EVENTS), EVENTS)
        start_latest(changes, EVENTS, f"{root}/out", f"{root}/checkpoint-{number}").awaitTermination()
        fold_latest(spark, f"{root}/out", EVENTS)
    return read_latest(spark, f"{root}/out", EVENTS)


def mixed_topics(spark, sf_dir):
    """Two tables with the same key name in one raw table; a job and a stream for one of them."""
    root = scratch_dir(spark, "mixed")
    changes = feeds.mixed_changes(table(spark, sf_dir, "events"), table(spark, sf_dir, "orders"))
    topic = feeds.write_topic(changes, f"{root}/topic", waves=2)
    start_bronze(to_bronze(_stream(spark, topic, 2)), f"{root}/ingest", f"{root}/bronze").awaitTermination()
    batch = refine(read_raw(spark, f"{root}/bronze"), feeds.ACTIVITY, f"{root}/table")
    raw = read_raw(spark, f"{root}/bronze", streaming=True)
    start_scd1(raw, feeds.ACTIVITY, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    streamed = current_view(spark, f"{root}/state", feeds.ACTIVITY)
    return batch.select(F.lit("batch").alias("via"), "id", "amount").unionByName(
        streamed.select(F.lit("stream").alias("via"), "id", "amount"))


def _appended(spark, sf_dir, label: str, failures: int) -> DataFrame:
    """events through the batch sink: an empty batch first, and so many failing writes."""
    root = scratch_dir(spark, label)
    topic = f"{root}/topic"
    feeds.write_topic(feeds.order_changes(table(spark, sf_dir, "orders")), topic, waves=1)
    feeds.write_topic(feeds.event_changes(table(spark, sf_dir, "events")), topic, waves=2)
    changes = read_changes(spark, "parquet", topic, [EVENTS.topic], options=replay_options(spark, topic, 4))
    left = [failures]

    def append(batch: DataFrame) -> None:
        if left[0]:
            left[0] -= 1
            raise ConnectionError("the target is away")
        batch.write.mode("append").parquet(f"{root}/bronze")

    start_bronze_batches(to_bronze(changes), append, f"{root}/checkpoint", pause=0).awaitTermination()
    raw = spark.read.parquet(f"{root}/bronze").select("payload")
    return valid_changes(decode(raw, EVENTS), EVENTS)


def retried_writes(spark, sf_dir):
    """Two writes in a row fail; every event arrives once."""
    return _appended(spark, sf_dir, "retry", 2)


def empty_batch(spark, sf_dir):
    """A first batch without rows of the wanted topic writes nothing and stops nothing."""
    return _appended(spark, sf_dir, "empty", 0)


EVENT_CHANGES = f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn FROM ({EVENT_ROWS})"
EVENT_LIVE = f"SELECT user_id, event_type, value, props FROM ({LATEST_EVENTS}) WHERE op <> 'd'"

QUERIES = {
    "s_bronze_roundtrip": (
        bronze_roundtrip,
        f"""SELECT user_id, event_type, value, props, op, version, event_id AS lsn,
               '{EVENTS.topic}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
               event_id AS "offset" FROM ({EVENT_ROWS})""",
    ),
    "s_topic_replay": (
        topic_replay,
        f"""SELECT '{EVENTS.topic}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
               count(*) AS n, min(event_id) AS first_offset, max(event_id) AS last_offset
        FROM events GROUP BY 2""",
    ),
    "s_archive_json": (
        archive_json,
        f"""SELECT CAST(user_id AS VARCHAR) AS key, '{EVENTS.topic}' AS topic,
               CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
               user_id, event_type, value, props, op FROM ({EVENT_ROWS})""",
    ),
    "n_batch_metrics": (
        batch_metrics,
        """SELECT count(*) AS decoded, count(*) FILTER (event_type <> 'click') AS applied,
               count(*) FILTER (event_type = 'click') AS rejected FROM events""",
    ),
    "s_duplicate_delivery": (duplicate_delivery, EVENT_LIVE),
    "s_multi_table": (
        multi_table,
        f"""SELECT 'events' AS source, user_id AS id, op, version, event_id AS lsn,
               value AS amount FROM ({LATEST_EVENTS})
        UNION ALL SELECT 'orders', o_custkey, op, version, lsn, o_totalprice
        FROM ({LATEST_ORDERS})""",
    ),
    "s_multi_table_state": (
        multi_table_state,
        f"""SELECT 'events' AS source, user_id AS id, value AS amount
        FROM ({LATEST_EVENTS}) WHERE op <> 'd'
        UNION ALL SELECT 'orders', o_custkey, o_totalprice FROM ({LATEST_ORDERS}) WHERE op <> 'd'""",
    ),
    "s_bronze_to_state": (
        bronze_to_state,
        f"""SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority
        FROM ({LATEST_ORDERS}) WHERE op <> 'd'""",
    ),
    "s_scd1_incremental": (incremental, EVENT_LIVE),
    "s_scd1_compacted": (incremental_compacted, EVENT_LIVE),
    "s_snapshot_then_changes": (
        snapshot_then_changes,
        """WITH newest AS (
            SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
            QUALIFY row_number() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
        SELECT o_custkey AS c_custkey, o_orderpriority AS c_name, o_totalprice AS c_acctbal
        FROM newest WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT c_custkey, c_name, c_acctbal FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM newest)""",
    ),
    "k_retry": (retried_writes, EVENT_CHANGES),
    "k_empty_batch": (empty_batch, EVENT_CHANGES),
    "m_refine_mixed_topics": (
        mixed_topics,
        f"""SELECT 'batch' AS via, user_id AS id, value AS amount FROM ({LATEST_EVENTS}) WHERE op <> 'd'
        UNION ALL SELECT 'stream', user_id, value FROM ({LATEST_EVENTS}) WHERE op <> 'd'""",
    ),
    "l_latest_stream_restarted": (
        streaming_newest_restarted,
        f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn "
        f"FROM ({LATEST_EVENTS})",
    ),
    "l_latest_stream": (
        streaming_newest,
        f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn "
        f"FROM ({LATEST_EVENTS})",
    ),
}
