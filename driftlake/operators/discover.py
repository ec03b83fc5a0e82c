"""The shape of topics nobody has described yet: fields and types, and how they differ from a spec.

One aggregation over the raw log merges the types of all records of a topic, combined on the map
side, so its result is one row a topic however long the log is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.functions.casts import INTEGRAL
from driftlake.operators.routing import is_own
from driftlake.spec import RESERVED, TableSpec


def topic_shapes(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Per topic: ``records``, ``unreadable`` ones, ``enveloped`` ones, and the type of its ``row``.

    The row is what stands in ``after`` or else ``before``, or the record itself if it is no
    envelope.  Types are those that hold every value seen.
    """
    record = F.try_parse_json(payload)
    rows = raw.select("topic", F.inline(F.array(F.struct(record.alias("record"), F.col(payload).alias("text")))))
    sides = [F.try_variant_get("record", f"$.{side}", "variant") for side in ("after", "before")]
    enveloped = F.try_variant_get("record", "$.op", "string").isNotNull()
    row = F.when(enveloped, F.coalesce(*(F.when(~F.is_variant_null(s), s) for s in sides))).otherwise(F.col("record"))
    return rows.groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("record").isNull() & F.col("text").isNotNull()).alias("unreadable"),
        F.count_if(enveloped).alias("enveloped"),
        F.schema_of_variant_agg(row).alias("row"),
    )


def row_fields(shape: str) -> dict[str, str]:
    """Columns and SQL types of a merged row type; what is no object has no fields.

    Numbers that need no fraction become BIGINT, others DOUBLE unless too long for it; values that
    are null throughout or of mixed kinds are text, and so are nested ones.
    """
    if not shape or not shape.startswith("OBJECT<"):
        return {}
    parsed = T.DataType.fromDDL(shape.replace("OBJECT<", "STRUCT<"))
    return {f.name: _column_type(f.dataType) for f in parsed.fields}


def _column_type(found: T.DataType) -> str:
    if isinstance(found, T.DecimalType):
        if found.scale:
            return "double" if found.precision <= 15 else found.simpleString()
        return "bigint" if found.precision <= 18 else found.simpleString()
    if isinstance(found, (T.StructType, T.ArrayType, T.VariantType, T.NullType)):
        return "string"
    return found.simpleString()


def draft_spec(topic: str, shape: str, keys: list[str]) -> TableSpec:
    """A description of a captured table to start from; the key has to be named.

    Fields named like change metadata get ``row_`` in front of their column.
    """
    fields = row_fields(shape)
    if set(keys) - set(fields):
        raise ValueError(f"{topic} has no field {sorted(set(keys) - set(fields))}")
    named = {f: f"row_{f}" if f in RESERVED else f for f in fields}
    return TableSpec(
        topic.rpartition(".")[2],
        {named[k]: fields[k] for k in keys},
        {named[f]: t for f, t in fields.items() if f not in keys},
        topic=topic,
        fields={c: f for f, c in named.items() if c != f},
    )


def _fits(found: str, wanted: str) -> bool:
    """Whether a column of type ``wanted`` holds what was found without loss."""
    wanted = {"long": "bigint", "integer": "int"}.get(wanted.lower(), wanted.lower())
    if wanted == found or wanted == "string":
        return True
    return found == "bigint" and wanted in INTEGRAL | {"double"}


def spec_drift(spec: TableSpec, shape: str) -> list[tuple[str, str | None, str | None, str]]:
    """(field, type found, type described, status) of every field on either side.

    ``same``, ``new`` (not described), ``gone`` (in no record), or ``other type`` where the described
    type may lose values.
    """
    found = row_fields(shape)
    wanted = {spec.json_field(c): t for c, t in {**spec.key, **spec.columns}.items()}
    out = []
    for name in sorted({*found, *wanted}):
        have, want = found.get(name), wanted.get(name)
        status = "new" if want is None else "gone" if have is None else "same" if _fits(have, want) else "other type"
        out.append((name, have, want, status))
    return out


def drift_report(shapes: DataFrame, specs: list[TableSpec]) -> DataFrame:
    """One row per topic and field, of described topics and others (status ``undescribed``).

    ``shapes`` is what :func:`topic_shapes` gives; its rows, one a topic, are gathered here.
    """
    rows = []
    for shape in shapes.collect():
        spec = next((s for s in specs if is_own(shape["topic"], s)), None)
        fields = spec_drift(spec, shape["row"]) if spec else [
            (name, kind, None, "undescribed") for name, kind in sorted(row_fields(shape["row"]).items())]
        rows += [(shape["topic"], shape["records"], shape["unreadable"], *f) for f in fields]
    return shapes.sparkSession.createDataFrame(
        rows, "topic string, records long, unreadable long, field string, found string, described string, status string")
