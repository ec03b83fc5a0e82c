"""Incremental type 1 state for a change stream.

Per key only the greatest change in event order counts.  That is a maximum, so it may be
taken in any grouping and any number of times: duplicates, late events, replayed batches
and the number of batches do not change the result.  Deletes are kept as rows, otherwise a
late update would bring a deleted row back; the served view leaves them out.

Layout under ``path``::

    deltas/<query>-<batch>/     newest change per key within one micro-batch
    base/<n>/                   newest change per key over the deltas named in its _COVERED
                                file, hash-bucketed on the key
    building/<id>/              a base that isn't finished

A micro-batch costs work in proportion to its own rows, not to the state.  Reading joins
the bucketed base with the reduced deltas, so the base is not shuffled.  A base is moved to its
place once it is whole; a delta is visible once its own marker is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from driftlake.operators.envelope import DELETE_OP
from driftlake.operators.latest import event_order, latest_per_key, newer
from driftlake.operators.routing import is_own, own_changes
from driftlake.operators.sizes import broadcast_limit
from driftlake.sources import files
from driftlake.sources.tables import typed_rows
from driftlake.spec import TableSpec
from driftlake.streaming.bronze import batch_name, triggered, with_retries

COVERED = "_COVERED"
# Catalog entries that make Spark see a base's buckets; readers need the right to create them.
NAMESPACE = "driftlake_state"
# Tables of one micro-batch that are written at the same time.
WRITERS = 8
# What a byte of a compressed file may take in memory.
EXPANSION = 5

# Compactions that streams have started, by the paths they work on.
_compactions: dict[tuple[str, ...], Future] = {}
_aside = ThreadPoolExecutor(WRITERS, thread_name_prefix="driftlake-compact")


class CompactionConflictError(RuntimeError):
    """Another compaction has put a base on top of the one this was built on."""


def state_schema(spec: TableSpec) -> T.StructType:
    fields = [*spec.key.items(), *spec.columns.items(), ("op", "string")]
    fields += [("version", "bigint"), ("lsn", "bigint"), ("offset", "bigint")]
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))


def _state_rows(changes: DataFrame, spec: TableSpec) -> DataFrame:
    if "offset" not in changes.columns:
        changes = changes.withColumn("offset", F.lit(None).cast("bigint"))
    return changes.select(*state_schema(spec).fieldNames())


def apply_batch(bronze: DataFrame, batch_name: str, path: str, spec: TableSpec) -> None:
    """Record the newest change per key of one batch of raw rows.

    A batch that is already recorded is left alone, an interrupted one is written anew.
    """
    spark = bronze.sparkSession
    folder = f"{path}/deltas/{batch_name}"
    if files.is_done(spark, folder):
        return
    changes = _state_rows(own_changes(bronze, spec), spec)
    latest_per_key(changes, spec).write.mode("overwrite").option("compression", "zstd").parquet(
        folder
    )
    files.mark_done(spark, folder)


def _start(
    bronze: DataFrame,
    record: Callable[[DataFrame, str], None],
    targets: list[tuple[TableSpec, str]],
    checkpoint: str,
    every: str | None,
    compact_every: int | None,
    buckets: int | None,
) -> StreamingQuery:
    """Hand each micro-batch to ``record`` under its lasting name, and compact now and then."""
    if compact_every and not buckets:
        raise ValueError("compact_every needs the number of buckets")

    paths = tuple(path for _, path in targets)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _raise_failure(paths)
        name = batch_name(batch, batch_id)
        with_retries(lambda: record(batch, name))
        if compact_every and (batch_id + 1) % compact_every == 0:
            _compact_aside(batch.sparkSession, targets, paths, buckets)

    writer = bronze.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def _raise_failure(paths: tuple[str, ...]) -> None:
    """Raise what the last compaction of these paths has failed with, once."""
    last = _compactions.get(paths)
    if last is not None and last.done():
        del _compactions[paths]
        last.result()


def _compact_aside(
    spark: SparkSession, targets: list[tuple[TableSpec, str]], paths: tuple[str, ...], buckets: int
) -> None:
    """Compact in a thread of its own, unless the last one still runs."""
    _raise_failure(paths)
    if paths in _compactions:
        return

    def run() -> None:
        for spec, path in targets:
            compact(spark, path, spec, buckets)

    _compactions[paths] = _aside.submit(run)


def wait_for_compactions() -> None:
    """Wait until the compactions that streams have started are over; raise what one failed with."""
    started = list(_compactions.values())
    _compactions.clear()
    for failure in [one.exception() for one in started]:
        if failure is not None:
            raise failure


def start_scd1(
    bronze: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    every: str | None = None,
    compact_every: int | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Keep the state under ``path`` up to date from a stream of raw rows.

    Batches are named by the query's own id, which lives in the checkpoint: a restart
    finds its batches again, a new checkpoint cannot mistake them for its own.  Every
    ``compact_every`` batches the deltas are folded into the base, beside the running stream.  One
    that failed stops the query at its next batch; :func:`wait_for_compactions` waits for what is
    under way and raises what went wrong.  Raw rows of other topics are left out.
    """

    def record(batch: DataFrame, name: str) -> None:
        apply_batch(batch, name, path, spec)

    return _start(bronze, record, [(spec, path)], checkpoint, every, compact_every, buckets)


def start_scd1_tables(
    bronze: DataFrame,
    targets: list[tuple[TableSpec, str]],
    checkpoint: str,
    every: str | None = None,
    compact_every: int | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """The same for several tables out of one stream that carries all their topics.

    A micro-batch is read from its source once; one aggregation tells which topics it has, and
    their tables are written WRITERS at a time.
    """

    def record(batch: DataFrame, name: str) -> None:
        batch.persist()
        try:
            there = {r["topic"] for r in batch.select("topic").distinct().collect()}
            own = [(spec, path) for spec, path in targets if any(is_own(t, spec) for t in there)]
            with ThreadPoolExecutor(WRITERS) as writers:
                for done in [writers.submit(apply_batch, batch, name, path, spec) for spec, path in own]:
                    done.result()
        finally:
            batch.unpersist()

    return _start(bronze, record, targets, checkpoint, every, compact_every, buckets)


def _latest_base(spark: SparkSession, path: str) -> str | None:
    published = files.finished_children(spark, f"{path}/base", COVERED)
    return published[-1] if published else None


class _Base(NamedTuple):
    """What the marker file of a base says."""

    buckets: int
    table: str
    covered: set[str]


def _describe(spark: SparkSession, path: str, base: str) -> _Base:
    buckets, table, *names = files.read_lines(spark, f"{path}/base/{base}/{COVERED}")
    return _Base(int(buckets), table, set(names))


def _open_deltas(spark: SparkSession, path: str, base: str | None) -> list[str]:
    done = files.finished_children(spark, f"{path}/deltas")
    covered = _describe(spark, path, base).covered if base else set()
    return [name for name in done if name not in covered]


def _read_deltas(
    spark: SparkSession, path: str, names: list[str], spec: TableSpec, buckets: int | None = None
) -> DataFrame:
    """Newest row per key over some deltas, laid out like a base of ``buckets`` if given.

    Sharing the layout is what spares the base a shuffle: left to itself, Spark might move
    the base to the session's shuffle partitions.  A key has at most one row per delta, so
    nothing is lost by not reducing before this shuffle.
    """
    schema = state_schema(spec)
    if not names:
        return typed_rows(spark, [], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/deltas/{n}" for n in names])
    if buckets:
        rows = rows.repartition(buckets, *spec.keys)
    return latest_per_key(rows, spec)


def _weight(spark: SparkSession, path: str, names: list[str]) -> int:
    """About what the rows of some deltas take in memory, by the size of their files."""
    return EXPANSION * sum(files.size_of(spark, f"{path}/deltas/{n}") for n in names)


def _hashed_if_light(deltas: DataFrame, weight: int, buckets: int) -> DataFrame:
    """Deltas that fit in memory bucket by bucket are hashed, so the base is not sorted."""
    light = weight // buckets <= broadcast_limit(deltas.sparkSession)
    return deltas.hint("shuffle_hash") if light else deltas


def _quoted(names: list[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _read_base(spark: SparkSession, path: str, base: str, spec: TableSpec) -> DataFrame:
    """The base as a bucketed table, so that joins on the key need no shuffle of it.

    The catalog entry, under a name no other base ever has, only points at files that stay
    where they are.  It is in NAMESPACE, where readers need the right to create entries.
    """
    about = _describe(spark, path, base)
    table = f"{NAMESPACE}.{about.table}"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {NAMESPACE}")
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in state_schema(spec).fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({_quoted(spec.keys)}) INTO {about.buckets} BUCKETS LOCATION '{path}/base/{base}'"
    )
    return spark.table(table)


def _on(spec: TableSpec) -> Column:
    return reduce(and_, [F.col(f"b.{k}") == F.col(f"d.{k}") for k in spec.keys])


def _winners(joined: DataFrame, spec: TableSpec) -> DataFrame:
    """The winning side of a base (``b``) and delta (``d``) join, row by row."""
    names = state_schema(spec).fieldNames()
    key = spec.keys[0]
    later = newer(event_order(spec, names, "d"), event_order(spec, names, "b"))
    take = F.col(f"d.{key}").isNotNull() & (F.col(f"b.{key}").isNull() | later)
    decided = joined.withColumn("_take", take)
    return decided.select(
        *[F.when(F.col("_take"), F.col(f"d.{n}")).otherwise(F.col(f"b.{n}")).alias(n) for n in names]
    )


def current_state(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The newest change of every key seen so far, deletes included.

    Deltas small enough to broadcast go to the base, which is then read in place, and its
    keys once more to find the delta rows that are new.  Larger ones meet it bucket by bucket.
    """
    base = _latest_base(spark, path)
    names = _open_deltas(spark, path, base)
    if base is None:
        return _read_deltas(spark, path, names, spec)
    rows = _read_base(spark, path, base, spec)
    if not names:
        return rows
    deltas = _read_deltas(spark, path, names, spec)
    weight = _weight(spark, path, names)
    if weight <= broadcast_limit(spark):
        small = F.broadcast(deltas)
        known = rows.alias("b").join(small.alias("d"), _on(spec), "left_outer")
        seen = rows.select(*spec.keys).join(F.broadcast(deltas.select(*spec.keys)), spec.keys, "left_semi")
        fresh = deltas.join(F.broadcast(seen), spec.keys, "left_anti")
        return _winners(known, spec).unionByName(fresh)
    buckets = _describe(spark, path, base).buckets
    deltas = _hashed_if_light(_read_deltas(spark, path, names, spec, buckets), weight, buckets)
    return _winners(rows.alias("b").join(deltas.alias("d"), _on(spec), "full_outer"), spec)


def current_view(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The rows that exist now."""
    state = current_state(spark, path, spec)
    return state.filter(F.col("op") != DELETE_OP).select(*spec.row_columns)


def compact(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    buckets: int,
    forget_deletes_before: int | None = None,
) -> str | None:
    """Fold the open deltas into a new base; returns its name, or None if there are none.

    Known keys are rewritten bucket by bucket out of the previous base without moving it
    between tasks; keys new since then are appended to the same buckets.  The first base,
    and one with another bucket count, is shuffled once.  Of two compactions at a time the one
    that ends first counts, the other leaves nothing behind and raises.  What the previous base had made redundant is deleted afterwards, so readers may go on
    for as long as it takes to the next compaction.  Deletes with a version below ``forget_deletes_before`` are let go; an even older
    event arriving after that would count as new.
    """
    base = _latest_base(spark, path)
    names = _open_deltas(spark, path, base)
    if not names:
        return None
    covered = _describe(spark, path, base).covered if base else set()
    covered &= set(files.finished_children(spark, f"{path}/deltas"))
    number = f"{int(base) + 1:012d}" if base else f"{0:012d}"
    folder, building = f"{path}/base/{number}", f"{path}/building/{uuid.uuid4().hex}"
    if files.exists(spark, folder) and not files.exists(spark, f"{folder}/{COVERED}"):
        files.remove(spark, folder)  # of a run that wrote in place and broke off; never visible
    deltas = _read_deltas(spark, path, names, spec, buckets)
    if base is None:
        parts = [deltas]
    elif _describe(spark, path, base).buckets != buckets:
        parts = [current_state(spark, path, spec).repartition(buckets, *spec.keys)]
    else:
        old = _read_base(spark, path, base, spec)
        light = _hashed_if_light(deltas, _weight(spark, path, names), buckets).alias("d")
        known = old.alias("b").join(light, _on(spec), "left_outer")
        fresh = deltas.join(old.select(*spec.keys), spec.keys, "left_anti")
        parts = [_winners(known, spec), fresh]
    if forget_deletes_before is not None:
        old_delete = (F.col("op") == DELETE_OP) & (F.col("version") < forget_deletes_before)
        parts = [part.filter(~F.coalesce(old_delete, F.lit(False))) for part in parts]
    try:
        _write_buckets(parts, building, spec, buckets)
        name = f"driftlake_base_{uuid.uuid4().hex}"
        listing = "\n".join([str(buckets), name, *sorted(covered | set(names))])
        files.write_text(spark, f"{building}/{COVERED}", listing)
        if _latest_base(spark, path) != base or not files.move_new(spark, building, folder):
            raise CompactionConflictError(f"{path} was compacted by somebody else meanwhile")
    except BaseException:
        files.remove(spark, building)
        raise
    if base:
        _retire(spark, path, base)
    return number


def _write_buckets(parts: list[DataFrame], folder: str, spec: TableSpec, buckets: int) -> None:
    spark = parts[0].sparkSession
    table = f"driftlake_write_{uuid.uuid4().hex}"
    for part in parts:
        (
            part.write.mode("append")
            .format("parquet")
            .bucketBy(buckets, *spec.keys)
            .option("path", folder)
            .option("compression", "zstd")
            .saveAsTable(table)
        )
    spark.sql(f"DROP TABLE {table}")


def drop_superseded(spark: SparkSession, path: str) -> None:
    """Delete what the newest base has made redundant: older bases and covered deltas.

    Run it when no reader can still be on the older files.
    """
    base = _latest_base(spark, path)
    if base is not None:
        _retire(spark, path, base)


def _retire(spark: SparkSession, path: str, base: str) -> None:
    """Delete the bases before ``base`` and the deltas it covers."""
    for name in files.finished_children(spark, f"{path}/base", COVERED):
        if name < base:
            spark.sql(f"DROP TABLE IF EXISTS {NAMESPACE}.{_describe(spark, path, name).table}")
            files.remove(spark, f"{path}/base/{name}")
    for name in _describe(spark, path, base).covered:
        files.remove(spark, f"{path}/deltas/{name}")
