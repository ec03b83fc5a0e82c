"""The rules of this package as SQL functions in a catalog, for users who write SQL.

They are SQL text that Spark puts into the query and optimizes with it; no Python runs.  Scalar
functions are called by their qualified name.  Spark calls table functions by their bare name only,
so their namespace has to be the current one::

    USE tools;
    SELECT c.* FROM bronze, LATERAL customers_changes(payload) AS c
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from driftlake.functions.casts import DECIMAL_TEXT, INTEGRAL
from driftlake.operators.access import ALLOW_ALL, ALLOW_READ, READ_ACTION
from driftlake.operators.envelope import DEFAULT_OP, ENVELOPE_FIELDS, OPS, envelope_schema
from driftlake.plans.layers import ensure_namespace
from driftlake.spec import TableSpec

LENIENT_BIGINT, PERMITS = "lenient_bigint", "permits"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(value: str) -> str:
    return "`" + value.replace("`", "``") + "`"


def create_scalar_functions(spark: SparkSession, namespace: str) -> None:
    """``lenient_bigint(text)`` and ``permits(allow, action)``."""
    ensure_namespace(spark, namespace)
    # Groups by number (1, then a zero, then 2): SQL would replace ${name} by a setting.
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {namespace}.{LENIENT_BIGINT}(t STRING) RETURNS BIGINT "
        f"COMMENT 'Text to BIGINT: fractions are cut off, what is no plain number is NULL' "
        f"RETURN coalesce(try_cast(t AS BIGINT), "
        f"try_cast(regexp_replace(t, {_text(DECIMAL_TEXT)}, '$10$2') AS BIGINT))")
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {namespace}.{PERMITS}(allow STRING, action STRING) RETURNS BOOLEAN "
        f"COMMENT 'Whether a decision lets an action through; no decision denies' "
        f"RETURN coalesce(CASE allow WHEN '{ALLOW_ALL}' THEN TRUE WHEN '{ALLOW_READ}' THEN action = '{READ_ACTION}' END, FALSE)")


def _path(record: str, *names: str) -> str:
    return ".".join([record, *map(_name, names)])


def _cast(namespace: str, text: str, data_type: str) -> str:
    kind = data_type.lower()
    if kind == "string":
        return text
    if kind in INTEGRAL:
        return f"try_cast({namespace}.{LENIENT_BIGINT}({text}) AS {data_type})"
    return f"try_cast({text} AS {data_type})"


def create_changes_function(spark: SparkSession, namespace: str, spec: TableSpec) -> str:
    """A table function ``<table>_changes(payload)``; returns its bare name.

    It gives the valid change of a payload, or no row: key, attributes, ``op``, ``version`` and
    ``lsn`` as ``valid_changes(decode(...))`` does.  Every leaf is read as text and cast leniently;
    what a path lookup can't read at all gives no row.
    """
    if not re.fullmatch(r"\w+", spec.name):
        raise ValueError(f"{spec.name!r} can't be part of a function's name")
    create_scalar_functions(spark, namespace)
    if not all(re.fullmatch(r"\w+", f) for f in map(spec.json_field, spec.row_columns)):
        raise ValueError(f"{spec.name}: SQL functions need plain field names")
    leaves = envelope_schema(spec, False).fields[:-1]
    schema = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in leaves)

    def value(column: str, data_type: str, *parents: str) -> str:
        field = spec.json_field(column)
        found = [_path("r", p, field) for p in parents]
        if field not in ENVELOPE_FIELDS:
            found.append(_path("r", field))
        return _cast(namespace, f"coalesce({', '.join(found)})", data_type)

    times = [_path("r", "ts_ms"), _path("r", "source", "ts_ms")]
    if spec.prefer_source_time:
        times.reverse()
    columns = {
        **{n: (t, value(n, t, "after", "before")) for n, t in spec.key.items()},
        **{n: (t, value(n, t, "after")) for n, t in spec.columns.items()},
        "op": ("STRING", f"lower(coalesce(r.op, '{DEFAULT_OP}'))"),
        "version": ("BIGINT", f"{namespace}.{LENIENT_BIGINT}(coalesce({', '.join(times)}))"),
        "lsn": ("BIGINT", f"{namespace}.{LENIENT_BIGINT}({_path('r', 'source', 'lsn')})"),
    }
    returned = ", ".join(f"{_name(n)} {t}" for n, (t, _) in columns.items())
    chosen = ", ".join(f"{sql} AS {_name(n)}" for n, (_, sql) in columns.items())
    keyed = " AND ".join(f"{_name(k)} IS NOT NULL" for k in spec.keys)
    ops = ", ".join(f"'{op}'" for op in OPS)
    name = f"{spec.name}_changes"
    # The array keeps the parsed record in one place, as ``inline`` does in ``decode``.
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {namespace}.{name}(payload STRING) RETURNS TABLE ({returned}) "
        f"COMMENT 'The valid change of {spec.name} in a payload, or no row' RETURN "
        f"SELECT * FROM (SELECT {chosen} FROM (SELECT explode(array("
        f"CASE WHEN get_json_object(payload, '$') IS NOT NULL THEN from_json(payload, {_text(schema)}) END)) AS r)) "
        f"WHERE {keyed} AND op IN ({ops})")
    return name
