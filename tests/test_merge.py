"""Merging against a brute-force model, in both ways of joining."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.operators import (
    apply_scd1,
    check_unique,
    latest_per_key,
    latest_per_key_agg,
    merge_into_table,
    merge_ledger_into_table,
    merge_source,
    upsert,
)
from driftlake.operators.merge import DuplicateKeyError
from driftlake.plans.refine import latest_changes, read_current, refine
from driftlake.spec import TableSpec

SPEC = TableSpec("t", {"id": "bigint"}, {"v": "string"})
TARGET = "id BIGINT, v STRING, processed_at TIMESTAMP"
CHANGES = "id BIGINT, v STRING, op STRING, version BIGINT, lsn BIGINT"


def old():
    return F.lit("2024-01-01").cast("timestamp")


def new():
    return F.lit("2024-01-02").cast("timestamp")


both_ways = pytest.mark.parametrize("limit", ["10485760", "-1"])


def target_of(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, v STRING").withColumn("processed_at", old())


def changes_of(spark, rows):
    return spark.createDataFrame([(k, v, op, 1, 1) for k, v, op in rows], CHANGES)


def seen(df):
    days = df.withColumn("day", F.to_date("processed_at").cast("string"))
    return sorted((r.id is None, r.id or 0, r.v or "", r.day) for r in days.collect())


def rows(*items):
    return sorted((k is None, k or 0, v or "", day) for k, v, day in items)


@both_ways
def test_scd1_truth_table(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    target = target_of(spark, [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (None, "n")])
    changes = changes_of(
        spark,
        [(1, "A", "u"), (2, None, "d"), (3, None, "u"), (4, "D", "t"), (6, "f", "c"), (7, None, "d"), (8, "h", "r")],
    )
    got = seen(apply_scd1(target, changes, SPEC, new()))
    assert got == rows(
        (1, "A", "2024-01-02"), (3, None, "2024-01-02"), (4, "d", "2024-01-01"),
        (5, "e", "2024-01-01"), (6, "f", "2024-01-02"), (8, "h", "2024-01-02"), (None, "n", "2024-01-01"),
    )


@both_ways
def test_skip_unchanged_keeps_the_stamp(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    target = target_of(spark, [(1, "a"), (2, None), (3, "c")])
    changes = changes_of(spark, [(1, "a", "u"), (2, None, "u"), (3, "x", "u"), (4, "n", "c")])
    assert seen(apply_scd1(target, changes, SPEC, new(), skip_unchanged=True)) == rows(
        (1, "a", "2024-01-01"), (2, None, "2024-01-01"), (3, "x", "2024-01-02"), (4, "n", "2024-01-02")
    )
    assert seen(apply_scd1(target, changes, SPEC, new())) == rows(
        (1, "a", "2024-01-02"), (2, None, "2024-01-02"), (3, "x", "2024-01-02"), (4, "n", "2024-01-02")
    )


@both_ways
def test_upsert_keeps_unmatched_and_unkeyed_rows(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    target = target_of(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "id BIGINT, v STRING")
    assert seen(upsert(target, source.withColumn("processed_at", new()), ["id"])) == rows(
        (1, "a", "2024-01-01"), (2, "B", "2024-01-02"), (3, "C", "2024-01-02"),
        (None, "n", "2024-01-01"), (None, "N", "2024-01-02"),
    )


@both_ways
def test_columns_the_source_lacks_are_kept(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 30)], "id BIGINT, v STRING, extra INT")
    source = spark.createDataFrame([(1, "A"), (3, "C"), (None, "N")], "id BIGINT, v STRING")
    got = upsert(target, source, ["id"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "A", 10), (2, "b", 20), (3, "C", None), (None, "n", 30), (None, "N", None)], key=str
    )


@both_ways
def test_repeated_target_rows_are_all_updated(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    target = target_of(spark, [(1, "a"), (1, "b"), (2, "c"), (2, "d")])
    changes = changes_of(spark, [(1, "A", "u"), (2, None, "d")])
    assert seen(apply_scd1(target, changes, SPEC, new())) == rows(
        (1, "A", "2024-01-02"), (1, "A", "2024-01-02")
    )


@both_ways
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_merges_with_composite_keys(spark, settings, limit, seed):
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    rnd = random.Random(seed)
    spec = TableSpec("t", {"a": "bigint", "b": "string"}, {"v": "string"})
    keys = [(i, chr(97 + j)) for i in range(6) for j in range(4)]
    before = {k: f"old{i}" for i, k in enumerate(keys) if rnd.random() < 0.6}
    events = {k: (rnd.choice("crud"), rnd.choice(["x", None])) for k in keys if rnd.random() < 0.6}
    after = dict(before)
    for k, (op, v) in events.items():
        if op == "d":
            after.pop(k, None)
        else:
            after[k] = v
    target = spark.createDataFrame(
        [(*k, v) for k, v in before.items()], "a BIGINT, b STRING, v STRING"
    ).withColumn("processed_at", old())
    changes = spark.createDataFrame(
        [(*k, v, op) for k, (op, v) in events.items()], "a BIGINT, b STRING, v STRING, op STRING"
    )
    got = {(r.a, r.b): r.v for r in apply_scd1(target, changes, spec, new()).collect()}
    assert got == after


def test_duplicate_source_is_refused(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id BIGINT, v STRING")
    with pytest.raises(DuplicateKeyError, match="1"):
        check_unique(source, ["id"])
    assert upsert(source.limit(0), source, ["id"]).count() == 4
    assert check_unique(source.filter("id IS NULL OR v = 'a'"), ["id"]).count() == 3


@both_ways
def test_source_is_cast_to_the_target(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id BIGINT, v STRING")
    source = spark.createDataFrame([(2, 5), (3, 6), (None, 7)], "id INT, v INT")
    merged = upsert(target, source, ["id"])
    assert [f.dataType for f in merged.schema] == [f.dataType for f in target.schema]
    assert sorted(map(tuple, merged.collect()), key=str) == [(1, "a"), (2, "5"), (3, "6"), (None, "7")]
    with pytest.raises(ValueError, match="extra"):
        upsert(target, source.withColumn("extra", F.lit(1)), ["id"])


def test_bucketed_target_is_not_shuffled(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    target = target_of(spark, [(i, str(i)) for i in range(50)])
    target.write.mode("overwrite").bucketBy(8, "id").saveAsTable("bucketed_target")
    merged = apply_scd1(spark.table("bucketed_target"), changes_of(spark, [(1, "x", "u")]), SPEC, new())
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert merged.count() == 50


def test_large_changes_are_decoded_once(spark, settings):
    """A merge straight from a raw log must not parse the log again for its side branches."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    bronze = spark.createDataFrame([('{"id":1,"v":"a"}',)], "payload STRING")
    merged = apply_scd1(target_of(spark, [(1, "x")]), latest_changes(bronze, SPEC), SPEC, new())
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate inline") == 1  # read, and what did not fit again as text
    assert plan.count("Exchange hashpartitioning") == 2


def test_merge_into_is_handed_to_spark(spark):
    """Tables here have no row-level operations: Spark itself must be the one to refuse."""
    spark.sql("CREATE TABLE IF NOT EXISTS plain_target (id BIGINT, v STRING, processed_at TIMESTAMP) USING parquet")
    changes = changes_of(spark, [(1, "a", "u")])
    with pytest.raises(Exception, match="MERGE|merge"):
        merge_into_table(changes, "plain_target", SPEC, new()).merge()
    spark.sql("CREATE TABLE IF NOT EXISTS plain_ledger (id BIGINT, v STRING, op STRING, version BIGINT, lsn BIGINT, offset BIGINT) USING parquet")
    with pytest.raises(Exception, match="MERGE|merge"):
        merge_ledger_into_table(changes, "plain_ledger", SPEC).merge()


def test_merge_source_columns(spark):
    source = merge_source(changes_of(spark, [(1, "a", "u")]), SPEC)
    assert source.columns == ["id", "v", "op", "processed_at"]
    assert source.first().processed_at is not None


EVENTS = [
    (1, "a", "c", 10, 1), (1, "b", "u", 20, 2), (1, "c", "u", 20, 3),  # lsn decides
    (2, "x", "u", None, 9), (2, "y", "u", 5, 1),  # a missing version comes last
    (3, "q", "u", 7, None), (3, "p", "u", 7, None),  # content decides, by its hash
    (4, None, "d", 3, 1), (4, None, "d", 3, 1),  # a duplicate
]
NEWEST = {1: ("c", "u"), 2: ("y", "u"), 3: ("q", "u"), 4: (None, "d")}


@pytest.mark.parametrize("newest", [latest_per_key, latest_per_key_agg])
@pytest.mark.parametrize("seed", [1, 2])
def test_newest_change_is_total(spark, newest, seed):
    events = EVENTS * 2
    random.Random(seed).shuffle(events)
    got = newest(spark.createDataFrame(events, CHANGES).repartition(5), SPEC)
    assert got.columns == [f.name for f in T.StructType.fromDDL(CHANGES)]
    result = got.collect()
    assert {r.id: (r.v, r.op) for r in result if r.id != 3} == {k: v for k, v in NEWEST.items() if k != 3}
    # Either of the two may be kept, but always the same.
    kept = [r.v for r in result if r.id == 3]
    order = spark.createDataFrame([("q",), ("p",)], "v STRING").orderBy(F.xxhash64(F.lit("u"), "v").desc())
    assert kept == [order.first().v]
    assert len(result) == len(NEWEST)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
        F.lit("v").alias("v"), F.lit("u").alias("op"), F.col("id").alias("version"), F.lit(1).alias("lsn"),
    )
    newest = latest_per_key(hot, SPEC)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")
    assert newest.filter("id = 7").first().version == 99_999


def test_refine_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_current(spark, path, SPEC).count() == 0

    def bronze(*payloads):
        return spark.createDataFrame([(p,) for p in payloads], "payload STRING")

    refine(
        bronze('{"after":{"id":1,"v":"a"},"op":"c","ts_ms":1}', '{"after":{"id":2,"v":"b"},"op":"c","ts_ms":1}', "null"),
        SPEC, path, old(),
    )
    out = refine(bronze('{"before":{"id":1},"op":"d","ts_ms":2}', '{"id":3,"v":"flat"}'), SPEC, path, new())
    assert seen(out) == rows((2, "b", "2024-01-01"), (3, "flat", "2024-01-02"))
    # An unfinished version is not visible.
    (tmp_path / "table" / "000000000002").mkdir()
    assert seen(read_current(spark, path, SPEC)) == seen(out)
