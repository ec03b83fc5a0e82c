"""Variant raw layer, key history, first deliveries, state audit and folding streams."""

import time

import pytest
from pyspark.sql import functions as F
from test_decode import CUSTOMERS as GOLDEN_SPEC
from test_decode import GOLDEN

from driftlake import TableSpec
from driftlake.operators import decode
from driftlake.operators.latest import latest_per_key
from driftlake.operators.variants import SHREDDING, decode_variant, shredding, to_variant
from driftlake.plans import feeds, upkeep_queries
from driftlake.sources import files
from driftlake.sources.changes import read_changes
from driftlake.streaming import read_latest, start_bronze, start_latest, to_bronze
from driftlake.streaming import history as hist
from driftlake.streaming.folded import counting
from driftlake.streaming.once import first_deliveries
from driftlake.streaming.state_audit import audit_latest, latest_state, state_operators

SPEC = TableSpec("people", {"id": "bigint"}, {"name": "string"}, topic="shop.people")
ODD = [
    '{"after":{"id":true},"op":"c"}', '{"after":{"id":12345678901234567890},"op":"c"}',
    '{"after":{"id":2,"first_name":"a","last_name":true,"email":{"a":[1,2]}},"op":"c"}',
    '{"after":{"id":2,"id":3},"op":"c"}', '{"after":{"id":-1.9},"ts_ms":"1","source":{"lsn":"5.7"}}',
    '{"id":4,"after":{"first_name":"x"}}', '{"after":[{"id":1}],"source":"web"}', '{"after":{"id":5}} x',
    '{"after":{"id":" 7 "},"op":"c","source":{"ts_ms":"4","lsn":9223372036854775807}}',
]


# -- variants ---------------------------------------------------------------------------------

@pytest.mark.parametrize("stored", [False, True])
def test_variants_decode_as_text_does(spark, tmp_path, stored):
    payloads = [p for p, _ in GOLDEN] + ODD
    raw = spark.createDataFrame(list(enumerate(payloads)), "n INT, payload STRING")
    rows = to_variant(raw)
    if stored:
        with shredding(spark):
            rows.write.parquet(f"{tmp_path}/raw")
        rows = spark.read.parquet(f"{tmp_path}/raw")
    got = {r.n: tuple(r) for r in decode_variant(rows, GOLDEN_SPEC).collect()}
    assert got == {r.n: tuple(r) for r in decode(raw, GOLDEN_SPEC).collect()}
    kept = {r.n: r.unread for r in rows.select("n", "unread").collect()}
    assert {payloads[n] for n, text in kept.items() if text is not None} == {
        p for p in payloads if p in ("{bad", "", '{"after":{"id":12},"op":"c","ts_ms":3', ODD[3])}


def test_field_names_with_dots_and_quotes(spark):
    spec = TableSpec("t", {"id": "bigint"}, {"a": "string", "b": "string"}, fields={"a": "x.y", "b": "it's"})
    raw = spark.createDataFrame([('{"after":{"id":1,"x.y":"p","it\'s":"q"},"op":"c"}',)], "payload string")
    row = decode_variant(to_variant(raw), spec).collect()[0]
    assert (row.id, row.a, row.b) == (1, "p", "q")


def test_only_the_paths_are_read(spark, tmp_path):
    lines = [(f'{{"after":{{"id":{i},"name":"n{i}"}},"op":"u","ts_ms":{i}}}',) for i in range(500)]
    with shredding(spark):
        to_variant(spark.createDataFrame(lines, "payload string")).write.parquet(f"{tmp_path}/raw")
    rows = decode_variant(spark.read.parquet(f"{tmp_path}/raw"), SPEC).select("op", "version")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "record:struct<0:string,1:string,2:string>" in plan  # op, both clocks; not the row
    assert "IsNotNull(unread)" in plan
    assert {r.op for r in rows.collect()} == {"u"}
    before = {name: spark.conf.get(name) for name in SHREDDING}
    with pytest.raises(RuntimeError), shredding(spark):
        raise RuntimeError
    assert {name: spark.conf.get(name) for name in SHREDDING} == before


# -- topics -----------------------------------------------------------------------------------

def topic(spark, path, rows):
    """(offset, id, name or None for a delete) as topic rows in one file."""
    lines = []
    for offset, key, name in rows:
        row = f'{{"id": {key}, "name": "{name}"}}'
        sides = f'"before": {row}, "op": "d"' if name is None else f'"after": {row}, "op": "u"'
        lines.append((str(key), f'{{{sides}, "ts_ms": {offset}}}', SPEC.topic, 0, offset))
    schema = "key string, value string, topic string, partition int, offset long"
    rows = spark.createDataFrame(lines, schema).withColumn("timestamp", F.timestamp_seconds(F.col("offset")))
    rows.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, files_a_batch=1):
    return read_changes(spark, "parquet", path, options={"maxFilesPerTrigger": str(files_a_batch)})


# -- history ----------------------------------------------------------------------------------

def scanned(rows):
    """Rows that left the files, after running the query (without adaptive execution)."""
    rows.collect()
    leaves = rows._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def change(spark, rows):
    schema = "id long, name string, op string, version long, lsn long, offset long"
    return spark.createDataFrame([(i, n, op, v, v, v) for i, n, op, v in rows], schema)


def test_a_key_is_found_without_reading_the_rest(spark, tmp_path, settings):
    settings(spark__sql__shuffle__partitions="4", spark__sql__adaptive__enabled="false")
    path = f"{tmp_path}/history"
    for batch in range(5):  # every batch spans all keys; odd ones come up in the first only
        step = 1 if batch == 0 else 2
        rows = change(spark, [(i, f"n{batch}", "u", batch) for i in range(0, 40_000, step)])
        hist.write_history(rows, SPEC, f"{path}/b{batch}", group_bytes=1 << 16)
        files.mark_done(spark, f"{path}/b{batch}")
    often, rare, absent = (hist.key_history(spark, path, SPEC, {"id": k}) for k in (20_000, 20_001, 50_000))
    assert [r.nth for r in often.orderBy("nth").collect()] == [1, 2, 3, 4, 5]
    everything = hist.read_history(spark, path).count()
    assert everything == 120_000
    read = [scanned(rows) for rows in (often, rare, absent)]
    assert 5 <= read[0] <= everything / 15
    assert 1 <= read[1] <= read[0] / 3  # bloom filters rule out the other batches
    assert read[2] == 0
    hist.fold_history(spark, path, SPEC)
    assert hist.read_history(spark, path).count() == everything
    folded = hist.key_history(spark, path, SPEC, {"id": 20_000})
    assert 5 <= scanned(folded) <= read[0]
    assert [r.version for r in folded.orderBy("nth").collect()] == list(range(5))


def test_history_of_a_hot_key_is_spread(spark, tmp_path, settings):
    settings(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = change(spark, [(1, f"n{v}", "u", v) for v in range(4000)] + [(i, "x", "c", 1) for i in range(2, 2000)])
    hist.write_history(rows, SPEC, f"{tmp_path}/h")
    counts = spark.read.parquet(f"{tmp_path}/h").groupBy(F.input_file_name()).count().collect()
    assert len(counts) == 8 and max(r["count"] for r in counts) < 1500


def test_history_of_one_key_with_deletes_and_repeats(spark, tmp_path):
    root = str(tmp_path)
    topic(spark, f"{root}/topic", [(1, 7, "a"), (2, 7, None), (3, 8, "z")])
    topic(spark, f"{root}/topic", [(4, 7, "b"), (2, 7, None)])
    query = hist.start_history(to_bronze(stream(spark, f"{root}/topic")), SPEC, f"{root}/h", f"{root}/c")
    query.awaitTermination()
    rows = hist.key_history(spark, f"{root}/h", SPEC, {"id": 7}).orderBy("nth").collect()
    assert [(r.nth, r.op, r.name, r.exists_after) for r in rows] == [
        (1, "u", "a", True), (2, "d", None, False), (3, "u", "b", True)]
    with pytest.raises(ValueError, match="has \\['id'\\]"):
        hist.key_history(spark, f"{root}/h", SPEC, {"name": "a"})


def test_a_topic_out_of_one_row_group_is_written_and_read_by_many_tasks(spark, tmp_path, settings):
    settings(spark__sql__shuffle__partitions="4", spark__sql__adaptive__coalescePartitions__enabled="false")
    events = spark.range(60_000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-02 00:00:00'").alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.concat(*[F.sha2(F.concat("id", F.lit(str(i))), 512) for i in range(3)]).alias("props"))
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    earlier, _ = upkeep_queries._halves(spark, str(tmp_path))
    feeds.write_topic(feeds.event_changes(earlier), f"{tmp_path}/topic", waves=1)
    assert len(spark.read.parquet(f"{tmp_path}/topic").inputFiles()) == 4
    whole = feeds.event_changes(spark.read.parquet(f"{tmp_path}/events.parquet")).coalesce(1)
    feeds.write_topic(whole, f"{tmp_path}/one", waves=1)
    assert len(spark.read.parquet(f"{tmp_path}/one").inputFiles()) == 1
    rows = spark.read.parquet(f"{tmp_path}/one").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == 60_000 and len(rows) > 1


# -- first deliveries -------------------------------------------------------------------------

def offsets(spark, path):
    return sorted(r.offset for r in spark.read.parquet(path).select("offset").collect())


def test_redelivery_over_a_restart_is_dropped_and_late_rows_are_kept(spark, tmp_path):
    root = str(tmp_path)
    waves = [[(50, 1, "a"), (51, 2, "b"), (50, 1, "a")], [(51, 2, "b"), (52, 3, "c")], [(1, 9, "late"), (52, 3, "c")]]
    for wave in waves:
        topic(spark, f"{root}/topic", wave)
        bronze = to_bronze(first_deliveries(stream(spark, f"{root}/topic"), "1 hour"))
        start_bronze(bronze, f"{root}/checkpoint", f"{root}/bronze").awaitTermination()
    assert offsets(spark, f"{root}/bronze") == [1, 50, 51, 52]


def test_state_shrinks_once_the_time_is_over(spark, tmp_path):
    root, held = str(tmp_path), []
    for start, n in ((0, 400), (1000, 5), (2000, 5)):
        topic(spark, f"{root}/topic", [(start + i, i, "a") for i in range(n)])
        bronze = to_bronze(first_deliveries(stream(spark, f"{root}/topic"), "1 second"))
        query = start_bronze(bronze, f"{root}/checkpoint", f"{root}/bronze")
        query.awaitTermination()
        held.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        time.sleep(2.5)
    assert held[0] == 400 and held[2] <= 10
    topic(spark, f"{root}/topic", [(0, 0, "a")])  # after its time: gets through, as stated
    bronze = to_bronze(first_deliveries(stream(spark, f"{root}/topic"), "1 second"))
    start_bronze(bronze, f"{root}/checkpoint", f"{root}/bronze").awaitTermination()
    assert offsets(spark, f"{root}/bronze").count(0) == 2


# -- state ------------------------------------------------------------------------------------

def served(spark, root, fold_beyond=64):
    changes = decode(to_bronze(stream(spark, f"{root}/topic")).select("payload"), SPEC)
    query = start_latest(changes, SPEC, f"{root}/out", f"{root}/checkpoint", fold_beyond=fold_beyond)
    query.awaitTermination()


def test_audit_tells_what_is_served_from_what_is_held(spark, tmp_path):
    root = str(tmp_path)
    topic(spark, f"{root}/topic", [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")])
    served(spark, root)
    assert {r.status for r in audit_latest(spark, f"{root}/checkpoint", f"{root}/out", SPEC).collect()} == {"same"}
    assert state_operators(spark, f"{root}/checkpoint").count() >= 1
    assert {(r.id, r.name) for r in latest_state(spark, f"{root}/checkpoint", SPEC).collect()} == {
        (1, "a"), (2, "b"), (3, "c")}
    # What is served is tampered with: a row less, one changed, one more.
    rows = read_latest(spark, f"{root}/out", SPEC)
    wrong = rows.filter("id <> 1").withColumn("name", F.when(F.col("id") == 2, F.lit("x")).otherwise(F.col("name")))
    extra = rows.filter("id = 3").withColumn("id", F.lit(4).cast("long"))
    wrong.unionByName(extra).write.parquet(f"{root}/other/batch")
    files.mark_done(spark, f"{root}/other/batch")
    found = {r.id: r.status for r in audit_latest(spark, f"{root}/checkpoint", f"{root}/other", SPEC).collect()}
    assert found == {1: "state only", 2: "differs", 3: "same", 4: "served only"}


def test_a_stream_folds_its_own_folders(spark, tmp_path):
    root = str(tmp_path)
    for n in range(9):
        topic(spark, f"{root}/topic", [(n * 10 + k, k, f"v{n}") for k in range(n, n + 4)])
    served(spark, root, fold_beyond=3)
    names, _ = counting(spark, f"{root}/out")
    assert len(names) <= 4
    got = {r.id: r.name for r in read_latest(spark, f"{root}/out", SPEC).collect()}
    assert got == {k: f"v{min(k, 8)}" for k in range(12)}
    topic(spark, f"{root}/topic", [(500, 0, "again")])
    served(spark, root, fold_beyond=3)
    assert {r.id: r.name for r in read_latest(spark, f"{root}/out", SPEC).collect()}[0] == "again"


def test_a_fold_that_fails_stops_the_stream_and_is_repeated(spark, tmp_path, monkeypatch):
    from driftlake.streaming import latest

    root = str(tmp_path)
    for n in range(4):
        topic(spark, f"{root}/topic", [(n, 1, f"v{n}")])

    def broken(*_):
        raise RuntimeError("no space")

    monkeypatch.setattr(latest, "fold_latest", broken)
    with pytest.raises(Exception, match="no space"):
        served(spark, root, fold_beyond=2)
    monkeypatch.undo()
    served(spark, root, fold_beyond=2)
    assert len(counting(spark, f"{root}/out")[0]) <= 3
    assert [r.name for r in read_latest(spark, f"{root}/out", SPEC).collect()] == ["v3"]
