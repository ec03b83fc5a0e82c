"""The raw layer as VARIANT: JSON is parsed once when it comes in, later readers take paths out of it.

A raw row of this layer has ``record``, the parsed payload, or ``unread``, the payload's text where
it can't be held as a variant: broken JSON, a field name that comes twice, or more bytes than a
variant takes.  Nothing is lost, and what is unread is decoded from its text as ever.

Written under :func:`shredding`, a Parquet file stores the fields its first rows have in common as
columns of their own.  Reading a path then reads that column alone, without the rest of the record,
and a filter on it is answered from the file's statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.functions.casts import INTEGRAL, lenient_bigint, lenient_cast
from driftlake.operators.envelope import DEFAULT_OP, ENVELOPE_FIELDS, decode
from driftlake.spec import TableSpec

RECORD, UNREAD_TEXT = "record", "unread"
# Settings under which a variant's common fields become columns of a file.
SHREDDING = {
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
}


@contextmanager
def shredding(spark: SparkSession) -> Iterator[None]:
    """Variants written, and streams started, in this block are shredded."""
    before = {name: spark.conf.get(name) for name in SHREDDING}
    try:
        for name, value in SHREDDING.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def to_variant(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Raw rows with ``record`` and ``unread`` in place of the payload text."""
    record = F.try_parse_json(payload)
    # Parsed in a generator of its own, so the two columns don't parse it twice.
    parsed = F.inline(F.array(F.struct(record.alias(RECORD), F.col(payload).alias("_text"))))
    rows = raw.select(*[c for c in raw.columns if c != payload], parsed)
    return rows.withColumn(UNREAD_TEXT, F.when(F.col(RECORD).isNull(), F.col("_text"))).drop("_text")


def _quoted(name: str) -> str:
    quote = '"' if "'" in name else "'"
    return f"[{quote}{name}{quote}]"


def _at(data_type: str, *names: str) -> Column:
    return F.try_variant_get(RECORD, "$" + "".join(map(_quoted, names)), data_type)


def _whole(*names: str) -> Column:
    """A whole number as the text decoder reads it: no truth values, fractions cut off."""
    text = _at("string", *names)
    return F.when(text.isin("true", "false"), None).otherwise(
        F.coalesce(text.try_cast("bigint"), lenient_bigint(text)))


def _value(data_type: str, *names: str) -> Column:
    kind = data_type.lower()
    if kind == "string":
        return _at("string", *names)
    if kind in INTEGRAL:
        return _whole(*names).try_cast(kind)
    return lenient_cast(_at("string", *names), data_type)


def _paths(rows: DataFrame, spec: TableSpec, carried: list[str]) -> DataFrame:
    def first(column: str, data_type: str, *parents: str) -> Column:
        name = spec.json_field(column)
        found = [_value(data_type, p, name) for p in parents]
        if name not in ENVELOPE_FIELDS:
            found.append(_value(data_type, name))
        return F.coalesce(*found).alias(column)

    times = [_whole("ts_ms"), _whole("source", "ts_ms")]
    return rows.select(
        *[first(n, t, "after", "before") for n, t in spec.key.items()],
        *[first(n, t, "after") for n, t in spec.columns.items()],
        F.lower(F.coalesce(_at("string", "op"), F.lit(DEFAULT_OP))).alias("op"),
        F.coalesce(*(reversed(times) if spec.prefer_source_time else times)).alias("version"),
        _whole("source", "lsn").alias("lsn"),
        *[c for c in carried if c not in spec.row_columns],
    )


def decode_variant(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Variant rows to key, attributes, ``op``, ``version`` and ``lsn``, as ``decode`` does for text.

    Each column is one path into the record.  Rows that hold text are read by ``decode``; they are
    found by a filter that files without any answer from their statistics.  A variant holds numbers
    by value, so a number in a text column comes without needless zeros (``1.50`` is ``1.5``) or
    exponents, and a whole number written with an exponent is one.
    """
    carried = [c for c in raw.columns if c not in (RECORD, UNREAD_TEXT)]
    known = _paths(raw.filter(F.col(UNREAD_TEXT).isNull()), spec, carried)
    unread = raw.filter(F.col(UNREAD_TEXT).isNotNull()).select(*carried, UNREAD_TEXT)
    return known.unionByName(decode(unread, spec, UNREAD_TEXT))
