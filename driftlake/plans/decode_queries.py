"""Queries over the given tables: decoding, normalizing, newest change per key.

``QUERIES`` maps a name to (Spark callable, DuckDB SQL).  The SQL never sees JSON envelopes;
it computes the answer from the base columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.functions.casts import epoch_millis
from driftlake.functions.payload import normalize_value, pack_record
from driftlake.operators.envelope import decode, rejected_changes, valid_changes
from driftlake.operators.latest import latest_per_key, latest_per_key_agg
from driftlake.plans import feeds
from driftlake.plans.feeds import EVENTS, LINES, ORDERS, TURNS, table
from driftlake.plans.refine import latest_changes, live_rows
from driftlake.spec import TableSpec

EVENT_ROWS = """
    SELECT event_id, user_id, epoch_us(ts) // 1000 AS version,
           CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd'
                ELSE 'u' END AS op,
           CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
           CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type <> 'error' THEN props END AS props
    FROM events"""
LATEST_EVENTS = f"""
    SELECT * FROM ({EVENT_ROWS})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY version DESC, event_id DESC) = 1"""
ORDER_ROWS = """
    SELECT o_custkey, epoch_us(o_orderdate) // 1000 AS version, o_orderkey AS lsn,
           CASE o_orderstatus WHEN 'F' THEN 'd' WHEN 'P' THEN 'c' ELSE 'u' END AS op,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS o_orderkey,
           CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
    FROM orders"""
LATEST_ORDERS = f"""
    SELECT * FROM ({ORDER_ROWS})
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC, lsn DESC) = 1"""


def _event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.as_raw(feeds.event_changes(table(spark, sf_dir, "events"))).select("payload")


def _order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.as_raw(feeds.order_changes(table(spark, sf_dir, "orders"))).select("payload")


def decode_envelopes(spark, sf_dir):
    return valid_changes(decode(_event_payloads(spark, sf_dir), EVENTS), EVENTS)


def decode_flat(spark, sf_dir):
    """Records that are no envelopes: fields at the root, no operation, no version."""
    events = table(spark, sf_dir, "events")
    raw = events.select(pack_record(*EVENTS.row_columns).alias("payload"))
    return valid_changes(decode(raw, EVENTS), EVENTS)


def _mixed(spark, sf_dir) -> DataFrame:
    """By event type: tombstones, an unsupported operation, upper-case operations, no key or
    (every other signup) a record that breaks off."""
    events = table(spark, sf_dir, "events")
    millis = epoch_millis(F.col("ts"))
    lsn = F.col("event_id")

    def told(op: str):
        return feeds.envelope(EVENTS, F.lit(op), millis, lsn)

    no_key = pack_record(
        F.struct(F.lit(None).cast("string").alias("user_id"), "value").alias("after"),
        F.lit("c").alias("op"),
    )
    payload = (
        F.when(F.col("event_type") == "view", F.lit('{"value": null}'))
        .when(F.col("event_type") == "click", told("t"))
        .when(F.col("event_type") == "purchase", told("U"))
        .when(F.col("event_type") == "error", told("D"))
        .when(F.col("event_id") % 2 == 0, no_key)
        .otherwise(F.concat(F.lit('{"after": {"user_id": '), F.col("user_id").cast("string")))
    )
    return events.select(payload.alias("payload"))


def decode_filters(spark, sf_dir):
    return valid_changes(decode(_mixed(spark, sf_dir), EVENTS), EVENTS)


def decode_rejects(spark, sf_dir):
    decoded = decode(_mixed(spark, sf_dir), EVENTS, flag_unreadable=True)
    dropped = rejected_changes(decoded, EVENTS)
    return dropped.groupBy("reason", "op").agg(F.count(F.lit(1)).alias("n"))


def decode_lenient_numbers(spark, sf_dir):
    """Keys as quoted text, fractions, padded text, exponents and words."""
    key = F.col("user_id").cast("string")
    text = (
        F.when(F.col("event_type") == "view", F.concat(F.lit('"'), key, F.lit('"')))
        .when(F.col("event_type") == "click", F.concat(F.lit("-"), key, F.lit(".5")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('" '), key, F.lit(' "')))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('"'), key, F.lit('e1"')))
        .otherwise(F.concat(F.lit('"x'), key, F.lit('"')))
    )
    payload = F.concat(
        F.lit('{"after": {"user_id": '),
        text,
        F.lit('}, "op": "c", "ts_ms": "'),
        F.col("event_id").cast("string"),
        F.lit('.75"}'),
    )
    raw = table(spark, sf_dir, "events").select(payload.alias("payload"))
    spec = TableSpec("events", {"user_id": "bigint"})
    return valid_changes(decode(raw, spec), spec).select("user_id", "op", "version")


def decode_version_choice(spark, sf_dir):
    """Envelope time, commit time as the fallback; or commit time first."""
    missing = F.when(F.col("event_type") != "purchase", F.col("event_id"))
    payload = pack_record(
        F.struct("user_id").alias("after"),
        F.lit("c").alias("op"),
        missing.alias("ts_ms"),
        F.struct((F.col("event_id") + 1).alias("ts_ms")).alias("source"),
    )
    raw = table(spark, sf_dir, "events").select(payload.alias("payload"))
    spec = TableSpec("events", {"user_id": "bigint"})
    by_commit = TableSpec("events", {"user_id": "bigint"}, prefer_source_time=True)
    default = decode(raw, spec).select("user_id", "version", F.lit("envelope").alias("prefers"))
    commit = decode(raw, by_commit).select("user_id", "version", F.lit("source").alias("prefers"))
    return default.unionByName(commit)


def decode_composite_key(spark, sf_dir):
    turns = feeds.turn_changes(table(spark, sf_dir, "conversations"))
    return live_rows(turns, TURNS)


def _topic_values(spark, sf_dir) -> DataFrame:
    """By event type: an object, an array, a number, bare text, null; of the objects some break off
    (ids that end on 7) and some have more text behind them (on 8)."""
    props, last = F.col("props"), F.col("event_id") % 10
    value = (
        F.when(F.col("event_type") == "view", F.when(last == 7, F.regexp_replace(props, "[}]$", ""))
               .when(last == 8, F.concat(props, F.lit(" x"))).otherwise(props))
        .when(F.col("event_type") == "click", F.format_string("[%d]", "event_id"))
        .when(F.col("event_type") == "purchase", F.col("user_id").cast("string"))
        .when(F.col("event_type") == "signup", F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


def normalize_values(spark, sf_dir):
    values = _topic_values(spark, sf_dir)
    return values.select("event_id", normalize_value(F.col("value")).alias("payload"))


def normalize_verbatim(spark, sf_dir):
    values = _topic_values(spark, sf_dir)
    return values.select("event_id", normalize_value(F.col("value"), False).alias("payload"))


def pack_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    status = F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus")
    return orders.select(
        pack_record("o_orderkey", "o_custkey", status, "o_orderpriority").alias("payload")
    )


def newest_events(spark, sf_dir):
    return latest_changes(_event_payloads(spark, sf_dir), EVENTS)


def newest_events_agg(spark, sf_dir):
    return latest_per_key_agg(decode_envelopes(spark, sf_dir), EVENTS)


def newest_orders(spark, sf_dir):
    """Several orders of a customer share a date; the log position decides."""
    return latest_changes(_order_payloads(spark, sf_dir), ORDERS)


def newest_orders_agg(spark, sf_dir):
    orders = valid_changes(decode(_order_payloads(spark, sf_dir), ORDERS), ORDERS)
    return latest_per_key_agg(orders, ORDERS)


def line_history(spark, sf_dir):
    lines = feeds.line_changes(table(spark, sf_dir, "lineitem"))
    return latest_per_key(valid_changes(decode(lines, LINES), LINES), LINES)


def live_events(spark, sf_dir):
    """The flagship: current row per user after the whole log."""
    return live_rows(_event_payloads(spark, sf_dir), EVENTS)


BROKEN_OBJECT = "event_type = 'view' AND event_id % 10 IN (7, 8)"
VALUE_CASE = """CASE event_type
                WHEN 'view' THEN CASE event_id % 10
                     WHEN 7 THEN to_json(regexp_replace(props, '[}]$', ''))
                     WHEN 8 THEN to_json(props || ' x') ELSE props END
                WHEN 'click' THEN '[' || event_id || ']'
                WHEN 'purchase' THEN CAST(user_id AS VARCHAR)
                WHEN 'signup' THEN '"signup"' ELSE 'null' END"""

QUERIES = {
    "d_decode": (
        decode_envelopes,
        f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn "
        f"FROM ({EVENT_ROWS})",
    ),
    "d_flat_fallback": (
        decode_flat,
        "SELECT user_id, event_type, value, props, 'u' AS op, CAST(NULL AS BIGINT) AS version, "
        "CAST(NULL AS BIGINT) AS lsn FROM events",
    ),
    "d_filters": (
        decode_filters,
        """SELECT user_id,
               CASE WHEN event_type = 'purchase' THEN event_type END AS event_type,
               CASE WHEN event_type = 'purchase' THEN value END AS value,
               CASE WHEN event_type = 'purchase' THEN props END AS props,
               CASE event_type WHEN 'purchase' THEN 'u' ELSE 'd' END AS op,
               epoch_us(ts) // 1000 AS version, event_id AS lsn
        FROM events WHERE event_type IN ('purchase', 'error')""",
    ),
    "d_rejects": (
        decode_rejects,
        """SELECT CASE WHEN event_type = 'click' THEN 'unknown operation'
                    WHEN event_type = 'signup' AND event_id % 2 = 1 THEN 'unreadable'
                    ELSE 'no key' END AS reason,
               CASE WHEN event_type = 'click' THEN 't'
                    WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'c' ELSE 'u' END AS op,
               count(*) AS n
        FROM events WHERE event_type IN ('view', 'click', 'signup') GROUP BY 1, 2""",
    ),
    "d_lenient_numbers": (
        decode_lenient_numbers,
        """SELECT CASE event_type WHEN 'click' THEN -user_id ELSE user_id END AS user_id,
               'c' AS op, event_id AS version
        FROM events WHERE event_type IN ('view', 'click', 'signup')""",
    ),
    "d_version_choice": (
        decode_version_choice,
        """SELECT user_id, CASE WHEN event_type = 'purchase' THEN event_id + 1 ELSE event_id END
               AS version, 'envelope' AS prefers FROM events
        UNION ALL SELECT user_id, event_id + 1, 'source' FROM events""",
    ),
    "d_composite_key": (
        decode_composite_key,
        """SELECT conv_id, turn, role,
               CASE WHEN role = 'assistant' THEN text || ' [edited]' ELSE text END AS text
        FROM conversations WHERE role <> 'system'""",
    ),
    "n_normalize": (
        normalize_values,
        f"""SELECT event_id, CASE WHEN event_type = 'view' AND NOT ({BROKEN_OBJECT}) THEN props
               ELSE '{{"value": ' || {VALUE_CASE} || '}}' END AS payload FROM events""",
    ),
    "n_verbatim": (normalize_verbatim, f"SELECT event_id, {VALUE_CASE} AS payload FROM events"),
    "n_pack_record": (
        pack_records,
        """SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey ||
               ',"o_orderstatus":' || CASE WHEN o_orderstatus = 'F' THEN 'null'
                                           ELSE '"' || o_orderstatus || '"' END ||
               ',"o_orderpriority":"' || o_orderpriority || '"}' AS payload
        FROM orders""",
    ),
    "l_latest_window": (
        newest_events,
        f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn "
        f"FROM ({LATEST_EVENTS})",
    ),
    "l_latest_agg": (
        newest_events_agg,
        f"SELECT user_id, event_type, value, props, op, version, event_id AS lsn "
        f"FROM ({LATEST_EVENTS})",
    ),
    "l_ties": (newest_orders, LATEST_ORDERS),
    "l_ties_agg": (newest_orders_agg, LATEST_ORDERS),
    "l_line_history": (
        line_history,
        """SELECT * FROM (
            SELECT l_orderkey, l_linenumber,
                   CASE l_returnflag WHEN 'R' THEN 'd' WHEN 'N' THEN 'c' ELSE 'u' END AS op,
                   epoch_us(l_shipdate) // 1000 AS version, l_partkey AS lsn,
                   CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
                   CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS l_linestatus
            FROM lineitem)
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY version DESC, lsn DESC, op DESC, l_quantity DESC NULLS LAST,
                     l_linestatus DESC NULLS LAST) = 1""",
    ),
    "live_rows": (
        live_events,
        f"SELECT user_id, event_type, value, props FROM ({LATEST_EVENTS}) WHERE op <> 'd'",
    ),
}
