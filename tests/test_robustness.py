"""Topics that share a raw layer, markers, versions, publishing, upkeep of stored states."""

import json

import pytest
from pyspark.sql import functions as F

from driftlake import TableSpec
from driftlake.operators import apply_scd1, decode, own_rows, rejected_changes, upsert
from driftlake.operators.merge import ledger_columns, ledger_wins
from driftlake.plans import ensure_table, merge_changes, refine, upsert_rows
from driftlake.plans.refine import latest_changes, live_rows, publish, stage_rows, table_schema, write_version
from driftlake.sources import files
from driftlake.sources.changes import read_changes
from driftlake.streaming import (
    apply_batch,
    compact,
    current_state,
    current_view,
    fold_latest,
    read_counts,
    read_latest,
    start_counted,
    start_latest,
    start_scd1,
    start_scd1_tables,
    to_bronze,
)

A = TableSpec("a", {"id": "bigint"}, {"v": "string"}, topic="p.s.a")
B = TableSpec("b", {"id": "bigint"}, {"v": "string"}, topic="p.s.b")
MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def change(key, value, op="u", version=1, lsn=None):
    row = {"id": key, "v": value}
    return json.dumps({"before" if op == "d" else "after": row, "op": op, "ts_ms": version, "source": {"lsn": lsn}})


def topic_rows(spark, rows, topic="p.s.a", start=0):
    full = [(None, v, topic, 0, start + i, None) for i, v in enumerate(rows)]
    return spark.createDataFrame(full, "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP")


def mixed(spark):
    """Key 1 in both tables; the other table's change is the later one."""
    a = topic_rows(spark, [change(1, "mine", version=1), change(2, "two")])
    b = topic_rows(spark, [change(1, "other", version=9), change(3, "three")], "p.s.b")
    return a.unionByName(b)


def pairs(df):
    return {(r.id, r.v) for r in df.collect()}


def test_every_entry_point_keeps_to_its_topic(spark, tmp_path):
    root, raw = str(tmp_path), to_bronze(mixed(spark))
    mine = {(1, "mine"), (2, "two")}
    assert pairs(latest_changes(raw, A)) == mine
    assert pairs(live_rows(raw, A)) == mine
    assert pairs(refine(raw, A, f"{root}/table")) == mine
    ensure_table(spark, "mixed_topics", table_schema(A))
    merge_changes(raw, A, "mixed_topics")
    assert pairs(spark.table("mixed_topics")) == mine
    apply_batch(raw, "b0", f"{root}/state", A)
    assert pairs(current_view(spark, f"{root}/state", A)) == mine
    mixed(spark).write.parquet(f"{root}/topic")
    stream = to_bronze(read_changes(spark, "parquet", f"{root}/topic"))
    start_scd1(stream, A, f"{root}/one", f"{root}/c1").awaitTermination()
    assert pairs(current_view(spark, f"{root}/one", A)) == mine
    start_scd1_tables(stream, [(A, f"{root}/ta"), (B, f"{root}/tb")], f"{root}/c2").awaitTermination()
    assert pairs(current_view(spark, f"{root}/ta", A)) == mine
    assert pairs(current_view(spark, f"{root}/tb", B)) == {(1, "other"), (3, "three")}


def test_topics_of_specs_without_one(spark):
    rows = spark.createDataFrame([("p.s.a",), ("a",), ("p.s.aa",), ("b",)], "topic STRING").withColumn("payload", F.lit("{}"))
    spec = TableSpec("a", {"id": "bigint"})
    assert {r.topic for r in own_rows(rows, spec).collect()} == {"p.s.a", "a"}
    assert own_rows(rows.drop("topic"), spec).count() == 4


def test_unreadable_records_have_their_own_reason(spark):
    values = [change(1, "x"), '{"after": {"id": 1}, "op": ', "null", '{"after": {"id": 2}, "op": "t"}']
    raw = spark.createDataFrame([(v,) for v in values], "payload STRING")
    found = rejected_changes(decode(raw, A, flag_unreadable=True), A)
    assert sorted(r.reason for r in found.collect()) == ["no key", "unknown operation", "unreadable"]
    assert sorted(r.reason for r in rejected_changes(decode(raw, A), A).collect()) == ["no key", "no key", "unknown operation"]


def test_counts_do_not_depend_on_the_progress_kept(spark, settings, tmp_path):
    settings(spark__sql__streaming__numRecentProgressUpdates="3")
    root = str(tmp_path)
    for n in range(6):
        topic_rows(spark, [change(n, "x"), "null", change(n, "y", "t")], start=3 * n).coalesce(1).write.mode("append").parquet(f"{root}/topic")
    stream = to_bronze(read_changes(spark, "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1"}))
    query = start_counted(stream, A, f"{root}/out", f"{root}/c")
    query.awaitTermination()
    assert len(query.recentProgress) <= 3
    counts = read_counts(spark, f"{root}/out")
    assert counts.count() == 6
    assert tuple(counts.agg(F.sum("decoded"), F.sum("applied"), F.sum("rejected")).first()) == (18, 6, 12)
    assert spark.read.parquet(f"{root}/out/rows/*").count() == 6
    assert read_counts(spark, f"{root}/nothing").count() == 0


def test_latest_of_a_new_checkpoint_does_not_hide_newer_rows(spark, tmp_path):
    root = str(tmp_path)

    def run(rows, name):
        rows.write.parquet(f"{root}/{name}")
        raw = to_bronze(read_changes(spark, "parquet", f"{root}/{name}", options={"maxFilesPerTrigger": "1"}))
        start_latest(decode(raw.select("payload"), A), A, f"{root}/out", f"{root}/c-{name}").awaitTermination()

    run(topic_rows(spark, [change(1, "old", version=v) for v in (1, 2)] + [change(2, "b", version=5)]).repartition(3), "one")
    run(topic_rows(spark, [change(1, "new", version=99)]), "two")
    run(topic_rows(spark, [change(2, "late", version=1)]), "three")
    want = {(1, "new"), (2, "b")}
    assert pairs(read_latest(spark, f"{root}/out", A)) == want
    for _ in range(2):
        fold_latest(spark, f"{root}/out", A)
        assert pairs(read_latest(spark, f"{root}/out", A)) == want
    left = files.finished_children(spark, f"{root}/out")
    assert len(left) == 1 and left[0].startswith("folded-")
    # A folder whose writing was cut off is not seen.
    spark.createDataFrame([(9, "half")], "id BIGINT, v STRING").write.parquet(f"{root}/out/half")
    assert pairs(read_latest(spark, f"{root}/out", A)) == want


def test_nothing_depends_on_sparks_success_marker(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set(MARKS, "false")
    try:
        path, raw = str(tmp_path), to_bronze(mixed(spark))
        apply_batch(raw, "b0", f"{path}/state", A)
        assert not (tmp_path / "state" / "deltas" / "b0" / "_SUCCESS").exists()
        assert current_view(spark, f"{path}/state", A).count() == 2
        compact(spark, f"{path}/state", A, 2)
        assert current_view(spark, f"{path}/state", A).count() == 2
        assert refine(raw, A, f"{path}/table").count() == 2
    finally:
        conf.unset(MARKS)


def test_two_runs_cannot_write_one_version(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, "a")], "id BIGINT, v STRING").withColumn("processed_at", F.current_timestamp())
    write_version(rows, path, 0)
    with pytest.raises(FileExistsError):
        write_version(rows, path, 0)
    assert files.finished_children(spark, path) == ["000000000000"]
    for n in (1, 2, 3):
        write_version(rows, path, n, keep=2)
    assert files.finished_children(spark, path) == ["000000000002", "000000000003"]
    assert [p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("_building")] == []


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["day"]}, {"bucket_by": ["id"], "buckets": 4}])
def test_a_crash_before_publishing_leaves_the_table(spark, layout):
    name = f"published_{len(layout)}_{'_'.join(layout) or 'plain'}"
    schema = spark.createDataFrame([], "id BIGINT, v STRING, day DATE").schema
    ensure_table(spark, name, schema, **layout)

    def rows(*items):
        return spark.createDataFrame([(i, v) for i, v, _ in items], "id BIGINT, v STRING").withColumn(
            "day", F.to_date(F.concat(F.lit("2024-01-0"), F.col("id").cast("string"))))

    publish(spark, stage_rows(rows((1, "a", 0), (2, "b", 0)), name), name)
    staged = stage_rows(rows((2, "c", 0), (3, "it's", 0)), name)
    assert pairs(spark.table(name)) == {(1, "a"), (2, "b")}  # the job died here
    for _ in range(2):  # finishing it may be repeated
        publish(spark, staged, name)
        assert pairs(spark.table(name)) == {(2, "c"), (3, "it's")}
    upsert_rows(spark.table(name).filter("id = 3").withColumn("v", F.lit("z")), name, ["id"])
    assert pairs(spark.table(name)) == {(2, "c"), (3, "z")}
    if "buckets" in layout:
        plan = spark.table(name).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_a_bucketed_target_is_not_shuffled(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    ensure_table(spark, "bucketed_target", table_schema(A), bucket_by=["id"], buckets=4)
    raw = to_bronze(mixed(spark))
    merge_changes(raw, A, "bucketed_target")
    changes = latest_changes(raw, A).repartition(4, "id")
    merged = apply_scd1(spark.table("bucketed_target"), changes, A)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    below = plan[plan.index("Bucketed: true") - 400 : plan.index("Bucketed: true")]
    assert "Exchange" not in below.split("FileScan")[0].split("SortMergeJoin")[-1].split(":-")[-1]
    with pytest.raises(ValueError, match="belong together"):
        ensure_table(spark, "x", table_schema(A), buckets=4)


def test_the_log_is_decoded_once(spark):
    """The operator joins in one pass over the log; its jobs store the changes before they use them."""
    raw, target = to_bronze(mixed(spark)), spark.createDataFrame([], table_schema(A))
    once = latest_changes(raw, A)._jdf.queryExecution().executedPlan().toString()
    merged = apply_scd1(target, latest_changes(raw, A), A)._jdf.queryExecution().executedPlan().toString()
    assert once.count("Generate inline") > 0
    assert merged.count("Generate inline") == once.count("Generate inline")


def test_upsert_starts_no_job(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b")], "id BIGINT, v STRING")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    upsert(source.limit(0), source, ["id"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_both_ways_of_keeping_state_agree_on_ties(spark, tmp_path):
    """Equal versions and no log position: the later offset wins in both."""
    first = to_bronze(topic_rows(spark, [change(1, "x", version=5)], start=7))
    second = to_bronze(topic_rows(spark, [change(1, "y", version=5)], start=3))
    path = str(tmp_path / "state")
    for name, part in (("b0", first), ("b1", second)):
        apply_batch(part, name, path, A)
    kept = current_state(spark, path, A).first().v
    one, two = (latest_changes(p, A).select(*ledger_columns(A)) for p in (first, second))
    joined = one.alias("t").join(two.alias("s"), F.col("t.id") == F.col("s.id"))
    wins = joined.select(ledger_wins(A, "s", "t")).first()[0]
    assert kept == ("y" if wins else "x") == "x"


def test_compaction_keeps_what_readers_may_be_on(spark, tmp_path):
    path = str(tmp_path / "state")
    for n in range(4):
        apply_batch(to_bronze(topic_rows(spark, [change(n, "v")], start=n)), f"b{n}", path, A)
        compact(spark, path, A, 2)
    # The newest base and the one before, and the deltas that only the newest covers.
    assert sorted(p.name for p in (tmp_path / "state" / "base").iterdir()) == ["000000000002", "000000000003"]
    assert sorted(p.name for p in (tmp_path / "state" / "deltas").iterdir()) == ["b3"]
    assert current_view(spark, path, A).count() == 4
