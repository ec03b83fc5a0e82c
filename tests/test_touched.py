"""Merges by part: only parts with a changed key are read, written and pointed to."""

import random

import pytest
from pyspark.sql import functions as F

from driftlake import TableSpec
from driftlake.operators.merge import STAMP, apply_scd1
from driftlake.plans import touched as tp
from driftlake.plans.layers import ensure_table, new_namespace
from driftlake.plans.refine import latest_changes, table_schema

SPEC = TableSpec("customers", {"id": "bigint"}, {"name": "string"}, topic="shop.inventory.customers")


def stamped():
    return F.lit("2024-01-01").cast("timestamp")


def raw(spark, rows):
    """(id, name or None for a delete, version) as raw rows."""
    lines = []
    for key, name, version in rows:
        row = f'{{"id": {key}, "name": "{name}"}}'
        sides = f'"before": {row}, "after": null, "op": "d"' if name is None else f'"after": {row}, "op": "u"'
        lines.append((f'{{{sides}, "ts_ms": {version}}}', SPEC.topic))
    return spark.createDataFrame(lines, "payload string, topic string")


def files_by_part(spark, name):
    rows = spark.table(name).select(tp.PART, F.col("_metadata.file_path").alias("f")).distinct().collect()
    out = {}
    for r in rows:
        out.setdefault(r[tp.PART], set()).add(r.f)
    return out


def content(df):
    return sorted((r.id, r.name) for r in df.select("id", "name").collect())


@pytest.fixture
def table(spark):
    name = f"{new_namespace(spark, 'touched')}.customers"
    tp.ensure_scd1(spark, name, SPEC, 8)
    return name


def test_untouched_files_stay(spark, table):
    first = tp.merge_touched(raw(spark, [(i, f"n{i}", 1) for i in range(200)]), SPEC, table, stamped())
    assert first == list(range(8))
    before = files_by_part(spark, table)
    changes = [(3, "new", 2), (5, None, 2), (1000, "added", 2), (2000, None, 2)]
    part_of = {r.id: r.p for r in spark.createDataFrame([(c[0],) for c in changes], "id long").select(
        "id", tp.key_part(["id"], 8).alias("p")).collect()}
    again = tp.merge_touched(raw(spark, changes), SPEC, table, stamped())
    assert again == sorted(set(part_of.values())) and len(again) < 8
    after = files_by_part(spark, table)
    for part in range(8):
        assert (before[part] == after[part]) == (part not in again)
    want = {i: f"n{i}" for i in range(200)} | {3: "new", 1000: "added"}
    del want[5]
    assert content(spark.table(table)) == sorted(want.items())


def test_running_it_again_mends_a_broken_merge(spark, table, monkeypatch):
    tp.merge_touched(raw(spark, [(i, "a", 1) for i in range(50)]), SPEC, table, stamped())
    changes = raw(spark, [(i, "b" if i % 3 else None, 2) for i in range(60)])
    whole = tp._point

    def halfway(spark, name, folder, parts):
        whole(spark, name, folder, parts[:3])
        raise RuntimeError("lost")

    monkeypatch.setattr(tp, "_point", halfway)
    with pytest.raises(RuntimeError):
        tp.merge_touched(changes, SPEC, table, stamped())
    monkeypatch.setattr(tp, "_point", whole)
    tp.merge_touched(changes, SPEC, table, stamped())
    assert content(spark.table(table)) == [(i, "b") for i in range(60) if i % 3]


def test_random_merges_equal_the_whole_table_merge(spark, table):
    rng = random.Random(4)
    target = spark.createDataFrame([], table_schema(SPEC))
    for version in range(1, 5):
        picked = rng.sample(range(40), rng.randint(0, 12))
        rows = [(k, rng.choice(["x", "y", None]), version) for k in picked]
        rows += rows[:3]  # delivered twice
        changes = raw(spark, rows)
        target = spark.createDataFrame(
            apply_scd1(target, latest_changes(changes, SPEC), SPEC, stamped()).collect(), table_schema(SPEC))
        tp.merge_touched(changes, SPEC, table, stamped())
        assert content(spark.table(table)) == content(target)


def test_part_without_rows_and_no_changes(spark, table):
    assert tp.merge_touched(raw(spark, [(1, "a", 1)]), SPEC, table, stamped()) != []
    tp.merge_touched(raw(spark, [(1, None, 2)]), SPEC, table, stamped())
    assert content(spark.table(table)) == []
    assert tp.merge_touched(raw(spark, []), SPEC, table, stamped()) == []
    tp.merge_touched(raw(spark, [(1, "back", 3)]), SPEC, table, stamped())
    assert content(spark.table(table)) == [(1, "back")]


def test_only_touched_parts_are_scanned(spark, table):
    tp.merge_touched(raw(spark, [(i, "a", 1) for i in range(100)]), SPEC, table, stamped())
    rows = spark.table(table).filter(F.col(tp.PART).isin([2, 5]))
    rows.collect()
    scans = rows._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.apply(0).metrics().apply("numPartitions").value() == 2


def test_replaced_folders_go_after_a_while(spark, table):
    for version in range(1, 4):
        tp.merge_touched(raw(spark, [(i, f"v{version}", version) for i in range(30)]), SPEC, table, stamped())
    kept = content(spark.table(table))
    assert tp.drop_replaced(spark, table) == 0
    assert tp.drop_replaced(spark, table, unused_for=0) == 16
    assert content(spark.table(table)) == kept == [(i, "v3") for i in range(30)]


def test_skip_unchanged_and_upsert(spark, table):
    tp.merge_touched(raw(spark, [(1, "a", 1), (2, "b", 1)]), SPEC, table, stamped())
    later = F.lit("2024-02-02").cast("timestamp")
    tp.merge_touched(raw(spark, [(1, "a", 2), (2, "c", 2)]), SPEC, table, later, skip_unchanged=True)
    stamps = {r.id: str(r[STAMP])[:10] for r in spark.table(table).collect()}
    assert stamps == {1: "2024-01-01", 2: "2024-02-02"}
    source = spark.table(table).filter("id = 1").drop(tp.PART).withColumn("name", F.lit("up"))
    assert len(tp.upsert_touched(source, table, ["id"])) == 1
    assert content(spark.table(table)) == [(1, "up"), (2, "c")]
    with pytest.raises(ValueError, match="key"):
        tp.upsert_touched(source.unionByName(source), table, ["id"])


def test_other_layouts_are_refused(spark, table):
    other = f"{table.split('.')[0]}.plain"
    ensure_table(spark, other, table_schema(SPEC))
    with pytest.raises(ValueError, match="no parts"):
        tp.merge_touched(raw(spark, [(1, "a", 1)]), SPEC, other)
    with pytest.raises(ValueError, match="parted by id"):
        tp.upsert_touched(spark.createDataFrame([("a",)], "name string"), table, ["name"])
