"""Decoding change envelopes and flat records into typed change rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.functions.casts import lenient_bigint, lenient_cast
from driftlake.functions.payload import NO_LIMITS, is_json, is_json_object
from driftlake.spec import TableSpec

# Operation codes of a change event.
UPSERT_OPS = ("c", "r", "u")
DELETE_OP = "d"
OPS = (*UPSERT_OPS, DELETE_OP)
DEFAULT_OP = "u"

ENVELOPE_FIELDS = ("before", "after", "op", "ts_ms", "source")

# Where from_json puts the text of a record it could not read as asked.
UNREAD = "_unread"

# Name of the flag that ``decode`` adds on request.
UNREADABLE = "_unreadable"

# Types a JSON number is read into directly, with the value its text would be cast to.
NUMBERS = {"int", "integer", "bigint", "long", "double"}


def envelope_schema(spec: TableSpec, numbers: bool) -> T.StructType:
    """The fields decoding looks at.

    With ``numbers``, numeric columns and clocks are read as numbers, which is quick but
    voids a field that holds anything else.  Without, every leaf is text and nothing that
    is JSON at all is lost.
    """
    typed = {
        spec.json_field(n): T.DataType.fromDDL(t) if numbers and t.lower() in NUMBERS else T.StringType()
        for n, t in {**spec.key, **spec.columns}.items()
    }
    clock = T.LongType() if numbers else T.StringType()
    keys = [T.StructField(n, typed[n]) for n in map(spec.json_field, spec.keys)]
    row = [T.StructField(n, t) for n, t in typed.items()]
    envelope = [
        T.StructField("before", T.StructType(keys)),
        T.StructField("after", T.StructType(row)),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", clock),
        T.StructField(
            "source", T.StructType([T.StructField("ts_ms", clock), T.StructField("lsn", clock)])
        ),
    ]
    flat = [f for f in row if f.name not in ENVELOPE_FIELDS]
    return T.StructType([*envelope, *flat, T.StructField(UNREAD, T.StringType())])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _readable(text: Column) -> Column:
    """Whether a record that was not read as asked is JSON at all.

    A path lookup settles almost all.  It does not read what is beyond the limits of a JSON parser;
    that is judged by whether something follows the record where a parser has to skip it.
    """
    return F.get_json_object(text, "$").isNotNull() | is_json_object(text) | is_json(text)


def _row(record: Column, spec: TableSpec, numbers: bool, readable: Column) -> Column:
    """Key, attributes, operation, clock, position and readability out of a parsed record."""

    def first(column: str, *parents: str) -> Column:
        name = spec.json_field(column)
        found = [record[p][name] for p in parents]
        if name not in ENVELOPE_FIELDS:
            found.append(record[name])
        return F.coalesce(*found)

    def value(column: str, data_type: str, *parents: str) -> Column:
        found = first(column, *parents)
        if not (numbers and data_type.lower() in NUMBERS):
            found = lenient_cast(found, data_type)
        return (found if numbers else F.when(readable, found)).alias(column)

    def whole(found: Column) -> Column:
        return found if numbers else lenient_bigint(found)

    times = [record["ts_ms"], record["source"]["ts_ms"]]
    return F.struct(
        *[value(n, t, "after", "before") for n, t in spec.key.items()],
        *[value(n, t, "after") for n, t in spec.columns.items()],
        F.lower(F.coalesce(record["op"], F.lit(DEFAULT_OP))).alias("op"),
        whole(F.coalesce(*(reversed(times) if spec.prefer_source_time else times))).alias("version"),
        whole(record["source"]["lsn"]).alias("lsn"),
        (~readable).alias(UNREADABLE),
    )


def decode(
    raw: DataFrame, spec: TableSpec, payload: str = "payload", flag_unreadable: bool = False
) -> DataFrame:
    """Payload text to key, attributes, ``op``, ``version`` and ``lsn``.

    Columns other than the payload (topic, partition, offset, ...) are carried along.
    Records are read with native numbers.  Those that do not fit (a quoted or fractional
    key, ``"source": "web"``, broken JSON) are read a second time as text and cast
    leniently; only they pay for that.  A record of broken JSON gets
    no key, although its first fields could be read.  Texts and numbers of any length and any
    depth of nesting are read, but Spark cannot write values nested more than 1,000 deep
    as text: a column that holds one is NULL.  ``flag_unreadable`` adds a column that tells
    records of broken JSON from those that have no key of their own.

    A record is read and taken apart in one ``inline``, which the optimizer does not look into: it
    would copy ``from_json`` into every column and filter that reads a field of it.
    """
    carried = [c for c in raw.columns if c != payload and c not in spec.row_columns]
    quick, text = envelope_schema(spec, True), T.StructType(envelope_schema(spec, False)[:-1])
    record = F.from_json(payload, quick, {"columnNameOfCorruptRecord": UNREAD, **NO_LIMITS})

    def again(unread: Column) -> Column:
        read = F.struct(F.from_json(unread, text, NO_LIMITS).alias("record"), _readable(unread).alias("is_json"))
        return _let(read, lambda r: _row(r["record"], spec, False, r["is_json"]))

    def taken_apart(found: Column) -> Column:
        fits = found[UNREAD].isNull()
        return F.when(fits, _row(found, spec, True, F.lit(True))).otherwise(again(found[UNREAD]))

    rows = raw.select(F.inline(F.transform(F.array(record), taken_apart)), *carried)
    return rows if flag_unreadable else rows.drop(UNREADABLE)


def _has_key(spec: TableSpec) -> Column:
    present = F.lit(True)
    for name in spec.keys:
        present = present & F.col(name).isNotNull()
    return present


def valid_changes(decoded: DataFrame, spec: TableSpec, observe_as: str | Observation | None = None) -> DataFrame:
    """Changes that can be applied: the key is known and the operation is c, r, u or d.

    Tombstones fall to the key test: with no ``op`` of their own they count as updates.
    With ``observe_as`` the counts of kept and dropped rows are reported as query metrics
    under that name, or to that observation, in the same pass.
    """
    keep = _has_key(spec) & F.col("op").isin(*OPS)
    if observe_as:
        decoded = decoded.observe(
            observe_as,
            F.count(F.lit(1)).alias("decoded"),
            F.count_if(keep).alias("applied"),
            F.count_if(~keep).alias("rejected"),
        )
    return decoded.filter(keep)


def rejected_changes(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows ``valid_changes`` drops, each with a ``reason``.

    Broken JSON has a reason of its own if ``decode`` was asked to flag it.
    """
    reason = F.when(~_has_key(spec), "no key").when(~F.col("op").isin(*OPS), "unknown operation")
    if UNREADABLE in decoded.columns:
        reason = F.when(F.col(UNREADABLE), "unreadable").otherwise(reason)
        decoded = decoded.withColumn("reason", reason).drop(UNREADABLE)
        return decoded.filter(F.col("reason").isNotNull())
    return decoded.withColumn("reason", reason).filter(F.col("reason").isNotNull())
