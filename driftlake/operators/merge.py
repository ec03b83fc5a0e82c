"""Applying changes to a table: type 1 merge with deletes, and plain upsert.

Changes carry at most one row per key, so no key is hot in the joins here.  A target is not
shuffled when the changes are small or when it is bucketed on the key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.operators.envelope import DELETE_OP, OPS, UPSERT_OPS
from driftlake.operators.latest import event_order
from driftlake.spec import TIE_BREAKERS, TableSpec

STAMP = "processed_at"


class DuplicateKeyError(ValueError):
    """A merge source holds more than one row for a key."""


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def _keyed(keys: list[str], side: str | None = None) -> Column:
    prefix = f"{side}." if side else ""
    return _all([F.col(prefix + k).isNotNull() for k in keys])


def merge_source(latest: DataFrame, spec: TableSpec, as_of: Column | None = None) -> DataFrame:
    """Rows ready to merge: key, attributes, operation and the processing stamp."""
    stamp = F.current_timestamp() if as_of is None else as_of
    return latest.select(*spec.row_columns, "op", stamp.alias(STAMP))


def repeated_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and their row ``count``; combined before the shuffle."""
    return source.filter(_keyed(keys)).groupBy(*keys).count().filter("count > 1")


def check_unique(source: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``source`` if no key occurs twice, raise otherwise; one aggregation over keys."""
    sample = repeated_keys(source, keys).limit(5).collect()
    if sample:
        shown = ", ".join(str(tuple(r[k] for k in keys)) for r in sample)
        raise DuplicateKeyError(f"several source rows for key(s) {shown}")
    return source


def _on(keys: list[str]) -> list[Column]:
    return [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]


def _outcome(
    joined: DataFrame,
    columns: list[str],
    keys: list[str],
    updated: list[str],
    skip_unchanged: list[str] | None,
) -> DataFrame:
    """Target rows ``t`` joined with source rows ``s`` to the rows that remain."""
    hit = F.col("s._hit").isNotNull()
    write = hit
    if skip_unchanged:
        same = _all([F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in skip_unchanged])
        write = hit & ~(F.col("t._row").isNotNull() & same)
    out = []
    for name in columns:
        if name in keys:
            out.append(F.coalesce(f"t.{name}", f"s.{name}").alias(name))
        elif name in updated:
            out.append(F.when(write, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
        else:
            out.append(F.col(f"t.{name}").alias(name))
    return joined.filter(~F.coalesce("s._delete", F.lit(False))).select(*out)


def _merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    updated: list[str],
    skip_unchanged: list[str] | None,
    unkeyed: bool,
    small: bool,
) -> DataFrame:
    """Merge ``source`` (keys, ``updated`` and ``_delete``) into ``target``.

    Source and target meet in one full outer join on the key, so both are computed once.  A
    ``small`` source goes to the target instead: the target is read in place and its key column
    once more, to find the source rows that matched nothing.  That uses the source three times,
    so it should be stored, and its size known (as the jobs in ``plans.refine`` do).  ``unkeyed`` says that many
    rows may lack a key; they match nothing and are kept out of that join, where they would
    all be in one task.  That reads both inputs again, with a filter that stored tables
    answer from their statistics.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    unknown = set(source.columns) - set(types) - {"_delete"}
    if unknown:
        raise ValueError(f"the target has no column {sorted(unknown)}")
    source = source.select(
        "_delete", *[F.col(c).cast(types[c]).alias(c) for c in source.columns if c in types]
    )
    marked = source.withColumn("_hit", F.lit(True))
    rows = target.withColumn("_row", F.lit(True))
    shape = (target.columns, keys, updated, skip_unchanged)
    if small:
        there = rows.alias("t").join(F.broadcast(marked).alias("s"), _on(keys), "left_outer")
        matched = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")
        new = marked.join(F.broadcast(matched.distinct()), keys, "left_anti")
        blank = target.limit(0).withColumn("_row", F.lit(True)).alias("t")
        added = new.alias("s").join(blank, _on(keys), "left_outer")
        return _outcome(there, *shape).unionByName(_outcome(added, *shape))
    if not unkeyed:
        everything = rows.alias("t").join(marked.alias("s"), _on(keys), "full_outer")
        return _outcome(everything, *shape)
    on_key = rows.filter(_keyed(keys)).alias("t").join(
        marked.filter(_keyed(keys)).alias("s"), _on(keys), "full_outer"
    )
    absent = [F.lit(None).cast(types[c]).alias(c) for c in target.columns if c not in source.columns]
    loose = source.filter(~_keyed(keys) & ~F.col("_delete")).select("*", *absent)
    return (
        _outcome(on_key, *shape)
        .unionByName(target.filter(~_keyed(keys)))
        .unionByName(loose.select(*target.columns))
    )


def apply_scd1(
    target: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    as_of: Column | None = None,
    skip_unchanged: bool = False,
    small: bool = False,
) -> DataFrame:
    """The target after merging the newest change of each key.

    Upserts overwrite every attribute, NULLs included; a delete removes the row, or does
    nothing where there is none; rows without a change stay.  ``changes`` needs one row per
    key (``latest_per_key``) and keys throughout (``valid_changes``).  Every change restamps
    its row unless ``skip_unchanged``.  ``small`` changes are sent to the target.
    """
    usable = changes.filter(F.col("op").isin(*OPS))
    source = merge_source(usable, spec, as_of).withColumn("_delete", F.col("op") == DELETE_OP)
    return _merge(
        target,
        source.drop("op"),
        spec.keys,
        [*spec.attributes, STAMP],
        spec.attributes if skip_unchanged else None,
        unkeyed=False,
        small=small,
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    skip_unchanged: list[str] | None = None,
    small: bool = False,
) -> DataFrame:
    """The target with matched rows overwritten and unmatched source rows added.

    Target rows the source lacks stay.  ``source`` carries the columns to write, computed
    ones included, with at most one row per key: see ``check_unique``, which is a job of its own
    and not started here.  A ``small`` source is sent to the target.
    """
    updated = [c for c in source.columns if c not in keys]
    return _merge(
        target,
        source.withColumn("_delete", F.lit(False)),
        keys,
        updated,
        skip_unchanged,
        unkeyed=True,
        small=small,
    )


def merge_into_table(
    changes: DataFrame,
    table: str,
    spec: TableSpec,
    as_of: Column | None = None,
    deletes: bool = True,
):
    """The same merge as a ``MERGE INTO``, for table formats with row-level operations.

    Returns the writer; call ``.merge()`` to run it.
    """
    on = _all([F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in spec.keys])
    written = {c: F.col(f"source.{c}") for c in [*spec.attributes, STAMP]}
    inserted = {k: F.col(f"source.{k}") for k in spec.keys} | written
    upserts = F.col("source.op").isin(*UPSERT_OPS)
    writer = merge_source(changes, spec, as_of).alias("source").mergeInto(table, on)
    if deletes:
        writer = writer.whenMatched(F.col("source.op") == DELETE_OP).delete()
    return writer.whenMatched(upserts).update(written).whenNotMatched(upserts).insert(inserted)


def ledger_columns(spec: TableSpec) -> list[str]:
    return [*spec.row_columns, "op", "version", *TIE_BREAKERS]


def ledger_wins(spec: TableSpec, source: str, table: str) -> Column:
    """Whether a source row is later than the table's, in full event order."""
    columns = ledger_columns(spec)
    order = [F.struct(*event_order(spec, columns, side)) for side in (source, table)]
    return order[0] > order[1]


def merge_ledger_into_table(changes: DataFrame, table: str, spec: TableSpec):
    """Order-safe variant of ``merge_into_table`` for repeated, late or replayed batches.

    The table also holds ``op``, ``version`` and all tie-breakers (:func:`ledger_columns`).
    Deletes are stored as rows and a change only wins over an older one, by the same order as
    everywhere else; readers filter ``op <> 'd'``.
    """
    columns = ledger_columns(spec)
    on = _all([F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in spec.keys])
    values = {c: F.col(f"source.{c}") for c in columns}
    later = ledger_wins(spec, "source", table)
    if "offset" not in changes.columns:
        changes = changes.withColumn("offset", F.lit(None).cast("bigint"))
    writer = changes.select(*columns).alias("source").mergeInto(table, on)
    updated = {c: v for c, v in values.items() if c not in spec.keys}
    return writer.whenMatched(later).update(updated).whenNotMatched().insert(values)
