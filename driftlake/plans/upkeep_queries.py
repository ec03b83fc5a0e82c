"""Queries over the given tables: other forms of the raw layer, and what running streams hold.

Like the ingest queries they stream whole tables through the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.operators.access import load_rules
from driftlake.operators.envelope import decode, valid_changes
from driftlake.operators.variants import decode_variant, shredding, to_variant
from driftlake.operators.discover import drift_report, topic_shapes
from driftlake.operators.rule_table import decide
from driftlake.plans import feeds
from driftlake.plans.access_queries import LOG, RULES, access_log
from driftlake.plans.decode_queries import EVENT_ROWS
from driftlake.plans.feeds import EVENTS, ORDERS, table
from driftlake.plans.layers import new_namespace
from driftlake.plans.sql_functions import create_changes_function
from driftlake.session import scratch_dir
from driftlake.sources.changes import read_changes, replay_options
from driftlake.sources.tables import typed_rows
from driftlake.spec import TableSpec
from driftlake.streaming.bronze import start_bronze, to_bronze, triggered
from driftlake.streaming.expiring import start_latest_expiring
from driftlake.streaming.history import fold_history, key_history, read_history, start_history
from driftlake.streaming.latest import read_latest, start_latest
from driftlake.streaming.listener import read_stored, store_counts
from driftlake.streaming.once import POSITION, first_deliveries
from driftlake.streaming.state_audit import audit_latest


def _stream(spark, topic: str, batches: int) -> DataFrame:
    return read_changes(spark, "parquet", topic, options=replay_options(spark, topic, batches))


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    later = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    return feeds.spread(events.filter(~later), "event_id"), feeds.spread(events.filter(later), "event_id")


def variant_bronze(spark, sf_dir):
    """Topic to a raw layer of variants, decoded by paths."""
    root = scratch_dir(spark, "variant")
    feeds.write_topic(feeds.event_changes(table(spark, sf_dir, "events")), f"{root}/topic")
    bronze = to_variant(to_bronze(_stream(spark, f"{root}/topic", 2)))
    with shredding(spark):
        query = start_bronze(bronze, f"{root}/checkpoint", f"{root}/bronze")
    query.awaitTermination()
    raw = spark.read.schema(bronze.schema).parquet(f"{root}/bronze")
    changes = valid_changes(decode_variant(raw.select("record", "unread"), EVENTS), EVENTS)
    return changes.select(*EVENTS.row_columns, "op", "version", "lsn")


def busiest_key_history(spark, sf_dir):
    """The history of the user with the most events, out of the history of all users.

    The log comes in two runs, the second with part of the first delivered again, and is folded.
    """
    root = scratch_dir(spark, "history")
    earlier, later = _halves(spark, sf_dir)
    again = earlier.filter("event_type = 'click'")
    for rows in (earlier, later.unionByName(again)):
        feeds.write_topic(feeds.event_changes(rows), f"{root}/topic", waves=2)
        bronze = to_bronze(_stream(spark, f"{root}/topic", 2))
        start_history(bronze, EVENTS, f"{root}/history", f"{root}/checkpoint").awaitTermination()
    fold_history(spark, f"{root}/history", EVENTS)
    counts = read_history(spark, f"{root}/history").groupBy("user_id").count()
    busiest = counts.orderBy(F.desc("count"), "user_id").first()["user_id"]
    rows = key_history(spark, f"{root}/history", EVENTS, {"user_id": busiest})
    return rows.select("user_id", "nth", "op", "version", "lsn", "event_type", "value", "exists_after")


def stream_without_redeliveries(spark, sf_dir):
    """Part of the topic is delivered again within a run, another part after a restart."""
    root = scratch_dir(spark, "once")
    earlier, later = _halves(spark, sf_dir)
    runs = [
        earlier.unionByName(earlier.filter("event_type = 'click'")),
        later.unionByName(earlier.filter("event_type IN ('view', 'click')")),
    ]
    for rows in runs:
        feeds.write_topic(feeds.event_changes(rows), f"{root}/topic", waves=3)
        bronze = to_bronze(first_deliveries(_stream(spark, f"{root}/topic", 3)))
        start_bronze(bronze, f"{root}/checkpoint", f"{root}/bronze").awaitTermination()
    raw = spark.read.parquet(f"{root}/bronze")
    stored = raw.select("payload", *POSITION)
    return decode(stored, EVENTS).select("partition", "offset", *EVENTS.row_columns, "op", "version")


def state_against_served(spark, sf_dir):
    """Streaming state of all users after a restart, compared with what readers get."""
    root = scratch_dir(spark, "state-audit")
    for half in _halves(spark, sf_dir):
        feeds.write_topic(feeds.event_changes(half), f"{root}/topic", waves=2)
        raw = to_bronze(_stream(spark, f"{root}/topic", 2)).select("payload")
        changes = valid_changes(decode(raw, EVENTS), EVENTS)
        query = start_latest(changes, EVENTS, f"{root}/out", f"{root}/checkpoint", fold_beyond=2)
        query.awaitTermination()
    audit = audit_latest(spark, f"{root}/checkpoint", f"{root}/out", EVENTS)
    return audit.groupBy("status", "state_op").agg(
        F.count(F.lit(1)).alias("n"), F.min("user_id").alias("first_user"), F.max("state_version").alias("newest"))


def newest_with_expiring_deletes(spark, sf_dir):
    """Events in two runs, later ones last; the state lets go of deletes three days old."""
    root = scratch_dir(spark, "expiring")
    for half in _halves(spark, sf_dir):
        feeds.write_topic(feeds.event_changes(half), f"{root}/topic", waves=1)
        raw = to_bronze(_stream(spark, f"{root}/topic", 1)).select("payload")
        changes = valid_changes(decode(raw, EVENTS), EVENTS)
        query = start_latest_expiring(changes, EVENTS, f"{root}/out", f"{root}/checkpoint", "3 days")
        query.awaitTermination()
    return read_latest(spark, f"{root}/out", EVENTS).filter("op <> 'd'").select(*EVENTS.row_columns, "version", "lsn")


def listener_counts(spark, sf_dir):
    """Kept and dropped rows of a stream into a plain file sink, stored from its progress."""
    root = scratch_dir(spark, "listener")
    feeds.write_topic(feeds.event_changes(table(spark, sf_dir, "events")), f"{root}/topic")
    shaped = to_bronze(_stream(spark, f"{root}/topic", 6)).select(
        F.when(F.col("payload").contains('"event_type":"click"'), F.lit("null")).otherwise(F.col("payload")).alias("payload"))
    listener = store_counts(spark, f"{root}/counts", "changes")
    try:
        kept = valid_changes(decode(shaped, EVENTS), EVENTS, observe_as="changes")
        writer = kept.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        listener.wait_for(triggered(writer, None).start(f"{root}/out"))
    finally:
        spark.streams.removeListener(listener)
    counts = read_stored(spark, f"{root}/counts")
    stored = F.lit(spark.read.parquet(f"{root}/out").count()).alias("stored")
    return counts.agg(*(F.sum(F.col("counts")[n]).alias(n) for n in ("decoded", "applied", "rejected")), stored)


def rules_as_table(spark, sf_dir):
    """The fixed rules behind one rule for each third user of the log, by name and catalog."""
    log = access_log(spark, sf_dir).select("event_id", "user", "catalog")
    fixed = [
        (1_000_000_000 + i, r.user, r.catalog, r.allow) for i, r in enumerate(load_rules(RULES))]
    schema = "ord BIGINT, user_re STRING, catalog_re STRING, allow STRING"
    own = log.filter("event_id % 3 = 0").select("user", "catalog").dropDuplicates().select(
        F.substring_index("user", "_", -1).cast("bigint").alias("ord"), F.col("user").alias("user_re"),
        F.when(F.col("catalog") != "system", F.col("catalog")).alias("catalog_re"),
        F.concat(F.lit("own "), "catalog").alias("allow"))
    # Of a user's own rules the first by catalog counts, so that order is one of numbers.
    ranked = own.withColumn("ord", F.col("ord") * 100 + F.ascii("allow") + F.length("allow") + F.ascii(F.substring("allow", 5, 1)))
    return decide(log, ranked.unionByName(typed_rows(spark, fixed, schema))).select("event_id", "ord", "allow")


# What the drift report compares events with: a field less, one of another type, one too many.
DESCRIBED = TableSpec(
    "events", {"user_id": "int"}, {"event_type": "string", "value": "bigint", "nickname": "string"}, topic=EVENTS.topic)


def topic_schemas(spark, sf_dir):
    """Shapes of two topics, one of them described in another way, the other not at all."""
    events = feeds.as_raw(feeds.event_changes(table(spark, sf_dir, "events")))
    orders = feeds.as_raw(feeds.order_changes(table(spark, sf_dir, "orders")))
    broken = F.when(F.col("offset") % 10 == 3, F.lit("{broken")).otherwise(F.col("payload"))
    return drift_report(topic_shapes(events.unionByName(orders.withColumn("payload", broken))), [DESCRIBED])


def sql_functions(spark, sf_dir):
    """Envelopes decoded in SQL, by a table function of the catalog."""
    namespace = new_namespace(spark, "tools")
    name = create_changes_function(spark, namespace, EVENTS)
    raw = feeds.as_raw(feeds.event_changes(table(spark, sf_dir, "events"))).select("payload")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(namespace)
    try:
        return spark.sql(f"SELECT c.* FROM {{raw}}, LATERAL {name}(payload) AS c", raw=raw)
    finally:
        spark.catalog.setCurrentDatabase(before)


RULED = f"""
    WITH log AS ({LOG}),
    rules AS (
        SELECT DISTINCT split_part("user", '_', 2)::BIGINT * 100 + 111 + length(catalog) + 4 + ascii(catalog) AS ord,
               "user" AS user_re, CASE WHEN catalog <> 'system' THEN catalog END AS catalog_re, 'own ' || catalog AS allow
        FROM log WHERE event_id % 3 = 0
        UNION ALL SELECT 999999999 + ord, user_re, catalog_re, allow FROM (VALUES
            (1, 'de_.*', 'system', 'read-only'), (2, 'de_.*', 'bronze_de', 'all'),
            (3, 'de_.*', 'silver_de', 'all'), (4, 'ds_.*', 'system', 'read-only'),
            (5, 'ds_.*', 'silver_ds', 'all'), (6, '.*', '.*', 'none')) r(ord, user_re, catalog_re, allow)),
    pairs AS (SELECT DISTINCT "user", catalog FROM log),
    own AS (SELECT p."user", p.catalog, r.ord, r.allow FROM pairs p JOIN rules r
            ON r.ord < 999999999 AND r.user_re = p."user" AND (r.catalog_re IS NULL OR r.catalog_re = p.catalog)
        UNION ALL SELECT p."user", p.catalog, r.ord, r.allow FROM pairs p JOIN (SELECT * FROM rules WHERE ord >= 999999999) r
            ON regexp_full_match(p."user", r.user_re) AND regexp_full_match(p.catalog, r.catalog_re)),
    best AS (SELECT "user", catalog, min(ord) AS ord, arg_min(allow, ord) AS allow FROM own GROUP BY 1, 2)
    SELECT l.event_id, b.ord, b.allow FROM log l LEFT JOIN best b USING ("user", catalog)"""

QUERIES = {
    "l_latest_expiring": (
        newest_with_expiring_deletes,
        f"""SELECT user_id, event_type, value, props, version, event_id AS lsn FROM (SELECT * FROM ({EVENT_ROWS})
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY version DESC, event_id DESC) = 1)
        WHERE op <> 'd'""",
    ),
    "n_listener_counts": (
        listener_counts,
        """SELECT count(*)::BIGINT AS decoded, count(*) FILTER (event_type <> 'click')::BIGINT AS applied,
               count(*) FILTER (event_type = 'click')::BIGINT AS rejected,
               count(*) FILTER (event_type <> 'click')::BIGINT AS stored FROM events""",
    ),
    "g_rules_table": (rules_as_table, RULED),
    "s_topic_schema": (
        topic_schemas,
        f"""SELECT topic, records, unreadable, field, found, described, status FROM (
            SELECT '{EVENTS.topic}' AS topic, count(*) AS records, 0::BIGINT AS unreadable FROM events
            UNION ALL SELECT '{ORDERS.topic}', count(*), count(*) FILTER (o_orderkey % 10 = 3) FROM orders)
        JOIN (VALUES ('{EVENTS.topic}', 'event_type', 'string', 'string', 'same'),
            ('{EVENTS.topic}', 'nickname', NULL, 'string', 'gone'), ('{EVENTS.topic}', 'props', 'string', NULL, 'new'),
            ('{EVENTS.topic}', 'user_id', 'bigint', 'int', 'same'), ('{EVENTS.topic}', 'value', 'double', 'bigint', 'other type'),
            ('{ORDERS.topic}', 'o_custkey', 'bigint', NULL, 'undescribed'), ('{ORDERS.topic}', 'o_orderkey', 'bigint', NULL, 'undescribed'),
            ('{ORDERS.topic}', 'o_orderpriority', 'string', NULL, 'undescribed'),
            ('{ORDERS.topic}', 'o_totalprice', 'double', NULL, 'undescribed')) v(topic, field, found, described, status) USING (topic)""",
    ),
    "d_sql_functions": (
        sql_functions,
        f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn FROM ({EVENT_ROWS})",
    ),
    "d_variant_bronze": (
        variant_bronze,
        f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn FROM ({EVENT_ROWS})",
    ),
    "s_key_history": (
        busiest_key_history,
        f"""SELECT user_id, row_number() OVER (ORDER BY version, event_id) AS nth, op, version, event_id AS lsn,
               event_type, value, op <> 'd' AS exists_after
        FROM ({EVENT_ROWS})
        WHERE user_id = (SELECT user_id FROM events GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)""",
    ),
    "k_dedup_stream": (
        stream_without_redeliveries,
        f"""SELECT (user_id % 4)::INT AS partition, event_id AS "offset", user_id, event_type, value, props, op, version
        FROM ({EVENT_ROWS})""",
    ),
    "l_state_audit": (
        state_against_served,
        f"""SELECT 'same' AS status, op AS state_op, count(*) AS n, min(user_id) AS first_user, max(version) AS newest
        FROM (SELECT * FROM ({EVENT_ROWS})
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY version DESC, event_id DESC) = 1)
        GROUP BY op""",
    ),
}
