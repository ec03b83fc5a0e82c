"""Streams: ingest rules, restart, and state that does not depend on how events arrive."""

import gzip
import json
import random

import pytest
from driftlake.operators import decode, valid_changes
from driftlake.sources import read_changes, replay_options, topic_schema
from driftlake.spec import TableSpec
from driftlake.streaming import (
    apply_batch,
    compact,
    current_state,
    current_view,
    start_archive,
    start_bronze,
    start_bronze_batches,
    start_print,
    start_scd1,
    start_scd1_tables,
    to_bronze,
    wait_for_compactions,
    with_retries,
)
from driftlake.streaming.bronze import SinkWriteError, append_batch
from driftlake.streaming.latest import read_latest, start_latest
from driftlake.streaming.ledger import drop_superseded

SPEC = TableSpec("t", {"id": "bigint"}, {"v": "string"}, topic="p.s.t")


def envelope(key, value, op, version, lsn):
    row = {"id": key, "v": value}
    return json.dumps(
        {
            "before": row if op == "d" else None,
            "after": None if op == "d" else row,
            "op": op,
            "ts_ms": version,
            "source": {"lsn": lsn},
        }
    )


def history(seed, n=300, keys=25):
    """Events with ties, deletes and re-inserts; key 0 holds a third of them."""
    rnd = random.Random(seed)
    out = []
    for lsn in range(n):
        key = 0 if rnd.random() < 0.33 else rnd.randrange(1, keys)
        out.append((key, f"v{lsn}", rnd.choice("crudu"), lsn // 4, lsn))
    return out


def expected(events):
    newest = {}
    for key, value, op, version, lsn in events:
        if key not in newest or (version, lsn) > newest[key][:2]:
            newest[key] = (version, lsn, op, value)
    return {k: v[3] for k, v in newest.items() if v[2] != "d"}


def topic_rows(spark, values, topic="p.s.t", start=0):
    rows = [(None, v, topic, 0, start + i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, topic_schema())


def feed(spark, path, values, topic="p.s.t", start=0):
    topic_rows(spark, values, topic, start).coalesce(1).write.mode("append").parquet(path)


def view(spark, path):
    return {r.id: r.v for r in current_view(spark, path, SPEC).collect()}


def bronze_of(spark, values):
    return to_bronze(topic_rows(spark, values))


def test_bronze_keeps_every_record(spark, tmp_path):
    root = str(tmp_path)
    values = ['{"a":1}', "12", None, "text"]
    feed(spark, f"{root}/topic", values)
    changes = read_changes(spark, "parquet", f"{root}/topic")
    start_bronze(to_bronze(changes), f"{root}/c", f"{root}/b").awaitTermination()
    # The restarted query finds nothing new and only takes what is added.
    start_bronze(to_bronze(changes), f"{root}/c", f"{root}/b").awaitTermination()
    feed(spark, f"{root}/topic", ["[1]"], start=4)
    start_bronze(to_bronze(changes), f"{root}/c", f"{root}/b").awaitTermination()
    rows = spark.read.parquet(f"{root}/b")
    assert sorted((r.offset, r.payload) for r in rows.collect()) == [
        (0, '{"a":1}'), (1, '{"value": 12}'), (2, '{"value": null}'), (3, '{"value": "text"}'), (4, '{"value": [1]}'),
    ]
    assert rows.filter("topic = 'p.s.t' AND ingest_ts IS NOT NULL").count() == 5


def test_archive_is_gzip_json_with_nulls(spark, tmp_path):
    root = str(tmp_path)
    feed(spark, f"{root}/topic", ['{"a":1}', None])
    changes = read_changes(spark, "parquet", f"{root}/topic")
    start_archive(changes, f"{root}/a", f"{root}/c").awaitTermination()
    (written,) = (tmp_path / "a").glob("topic=*/partition=*/*.json.gz")
    lines = [json.loads(x) for x in gzip.open(written, "rt")]
    assert [x["value"] for x in lines] == ['{"a":1}', None]
    assert "key" in lines[0]
    back = read_changes(spark, "json", f"{root}/a", streaming=False)
    assert {(r.value, r.topic, r.offset) for r in back.collect()} == {('{"a":1}', "p.s.t", 0), (None, "p.s.t", 1)}


def test_bounded_read_and_topic_choice(spark, tmp_path):
    path = str(tmp_path / "topic")
    feed(spark, path, ["1", "2"])
    feed(spark, path, ["3"], topic="p.s.other")
    assert read_changes(spark, "parquet", path, streaming=False).count() == 3
    assert read_changes(spark, "parquet", path, topics=["p.s.t"], streaming=False).count() == 2
    assert int(replay_options(spark, path, 4)["maxBytesPerTrigger"]) > 100


def test_broker_reader_is_spark_s_own(spark):
    """The connector is not on this class path; the call has to get as far as asking for it."""
    with pytest.raises(Exception, match="(?i)kafka"):
        read_changes(spark, "kafka", topics=["a", "b"], options={"kafka.bootstrap.servers": "none:1"})


def test_hook_and_batch_sink(spark, tmp_path):
    root = str(tmp_path)
    feed(spark, f"{root}/topic", ["1", "2", "3"])
    changes = read_changes(spark, "parquet", f"{root}/topic")
    bronze = to_bronze(changes, normalize=False, hook=lambda df: df.filter("value <> '2'"))
    sizes = []

    def write(batch):
        sizes.append(batch.count())
        batch.write.mode("append").parquet(f"{root}/b")

    start_bronze_batches(bronze, write, f"{root}/c").awaitTermination()
    assert sizes == [2]
    assert sorted(r.payload for r in spark.read.parquet(f"{root}/b").collect()) == ["1", "3"]


def test_empty_batch_writes_nothing(spark):
    calls = []
    assert not append_batch(spark.range(0), calls.append)
    assert append_batch(spark.range(1), calls.append)
    assert len(calls) == 1


def test_connection_failures_are_retried_three_times():
    waits, calls = [], []

    def fail():
        calls.append(1)
        raise ConnectionError("gone")

    with pytest.raises(SinkWriteError):
        with_retries(fail, sleep=waits.append)
    assert (len(calls), waits) == (3, [3.0, 3.0])


class JavaThrowable:
    """Stands for what a failed Spark call carries."""

    def __init__(self, name, cause=None):
        self.name, self.cause = name, cause

    def getClass(self):  # noqa: N802
        return self

    def getName(self):  # noqa: N802
        return self.name

    def getCause(self):  # noqa: N802
        return self.cause


def wrapped(name):
    failure = RuntimeError("job aborted")
    failure._origin = JavaThrowable("org.apache.spark.SparkException", JavaThrowable(name))
    return failure


def test_a_failure_that_only_mentions_a_timeout_is_raised():
    def write():
        raise RuntimeError("java.net.SocketTimeoutException: only a text")

    with pytest.raises(RuntimeError, match="only a text"):
        with_retries(write, sleep=lambda _: None)


def test_timeouts_hold_the_batch_back():
    waits, outcomes = [], [TimeoutError("busy"), wrapped("java.net.SocketTimeoutException"), None]

    def write():
        outcome = outcomes.pop(0)
        if outcome:
            raise outcome

    with_retries(write, sleep=waits.append)
    assert waits == [30.0, 30.0]


def test_java_connection_failure_and_other_errors():
    waits, outcomes = [], [wrapped("java.net.ConnectException"), None]

    def write():
        outcome = outcomes.pop(0)
        if outcome:
            raise outcome

    with_retries(write, sleep=waits.append)
    assert waits == [3.0]
    with pytest.raises(ValueError):
        with_retries(lambda: int("x"), sleep=waits.append)
    assert waits == [3.0]


@pytest.mark.parametrize("seed,batches,compactions", [(1, 1, ()), (2, 4, ()), (3, 6, (1, 3)), (4, 5, (0, 1, 2, 3, 4))])
def test_state_does_not_depend_on_arrival(spark, tmp_path, seed, batches, compactions):
    events = history(seed)
    arrival = events + random.Random(seed).sample(events, 60)
    random.Random(seed + 1).shuffle(arrival)
    path = str(tmp_path / "state")
    for n in range(batches):
        apply_batch(bronze_of(spark, [envelope(*e) for e in arrival[n::batches]]), f"b{n:04d}", path, SPEC)
        if n in compactions:
            compact(spark, path, SPEC, 4)
    assert view(spark, path) == expected(events)
    state = current_state(spark, path, SPEC)
    assert state.count() == len({e[0] for e in events})


def test_late_update_does_not_revive_a_deleted_row(spark, tmp_path):
    path = str(tmp_path / "state")
    apply_batch(bronze_of(spark, [envelope(1, "a", "c", 1, 1), envelope(1, "a", "d", 9, 9)]), "b0", path, SPEC)
    apply_batch(bronze_of(spark, [envelope(1, "late", "u", 5, 5), envelope(2, "b", "c", 1, 1)]), "b1", path, SPEC)
    assert view(spark, path) == {2: "b"}


def test_replay_and_unfinished_batches(spark, tmp_path):
    path = str(tmp_path / "state")
    one, two = [envelope(1, "a", "c", 1, 1)], [envelope(1, "b", "u", 2, 2), envelope(3, "c", "c", 2, 3)]
    apply_batch(bronze_of(spark, one), "b0", path, SPEC)
    apply_batch(bronze_of(spark, two), "b1", path, SPEC)
    # The job dies after the files of b1, before they are marked: invisible, then written again.
    (tmp_path / "state" / "deltas" / "b1" / "_COMPLETE").unlink()
    assert view(spark, path) == {1: "a"}
    apply_batch(bronze_of(spark, two), "b1", path, SPEC)
    assert view(spark, path) == {1: "b", 3: "c"}
    # A finished batch is not written twice.
    before = sorted(p.name for p in (tmp_path / "state" / "deltas" / "b1").iterdir())
    apply_batch(bronze_of(spark, two), "b1", path, SPEC)
    assert sorted(p.name for p in (tmp_path / "state" / "deltas" / "b1").iterdir()) == before


def test_compaction_steps(spark, tmp_path):
    path = str(tmp_path / "state")
    events = history(7)
    payloads = [envelope(*e) for e in events]
    apply_batch(bronze_of(spark, payloads[:100]), "b0", path, SPEC)
    assert compact(spark, path, SPEC, 4) == "000000000000"
    assert compact(spark, path, SPEC, 4) is None
    apply_batch(bronze_of(spark, payloads[100:200]), "b1", path, SPEC)
    assert compact(spark, path, SPEC, 4) == "000000000001"
    # An interrupted compaction leaves files without the marker; it is redone.
    apply_batch(bronze_of(spark, payloads[200:]), "b2", path, SPEC)
    (tmp_path / "state" / "base" / "000000000002").mkdir()
    (tmp_path / "state" / "base" / "000000000002" / "part-0.parquet").write_text("broken")
    assert view(spark, path) == expected(events)
    assert compact(spark, path, SPEC, 6) == "000000000002"
    assert view(spark, path) == expected(events)
    drop_superseded(spark, path)
    assert view(spark, path) == expected(events)
    assert [p.name for p in (tmp_path / "state" / "base").iterdir()] == ["000000000002"]
    assert list((tmp_path / "state" / "deltas").iterdir()) == []
    # Going on afterwards, with a replay of a batch whose files are gone.
    apply_batch(bronze_of(spark, payloads[200:]), "b2", path, SPEC)
    apply_batch(bronze_of(spark, [envelope(0, "end", "u", 10**6, 1)]), "b3", path, SPEC)
    assert view(spark, path) == {**expected(events), 0: "end"}
    assert compact(spark, path, SPEC, 6) == "000000000003"
    assert view(spark, path) == {**expected(events), 0: "end"}


def test_tables_of_one_stream(spark, tmp_path):
    root = str(tmp_path)
    other = TableSpec("o", {"id": "bigint"}, {"v": "string"}, topic="p.s.other", tie_breakers=("offset", "lsn"))
    feed(spark, f"{root}/topic", [envelope(1, "a", "c", 1, 1), envelope(2, "b", "c", 1, 2)])
    changes = read_changes(spark, "parquet", f"{root}/topic")
    targets = [(SPEC, f"{root}/t"), (other, f"{root}/o")]
    start_scd1_tables(to_bronze(changes), targets, f"{root}/c").awaitTermination()
    assert view(spark, f"{root}/t") == {1: "a", 2: "b"}
    assert not (tmp_path / "o").exists()
    assert current_view(spark, f"{root}/o", other).count() == 0
    feed(spark, f"{root}/topic", [envelope(1, "z", "c", 1, 1)], topic="p.s.other", start=9)
    start_scd1_tables(
        to_bronze(changes), targets, f"{root}/c", compact_every=2, buckets=2
    ).awaitTermination()
    wait_for_compactions()
    assert view(spark, f"{root}/t") == {1: "a", 2: "b"}
    assert [tuple(r) for r in current_view(spark, f"{root}/o", other).collect()] == [(1, "z")]
    assert (tmp_path / "o" / "base").exists() and (tmp_path / "t" / "base").exists()
    with pytest.raises(ValueError, match="tie"):
        TableSpec("x", {"id": "bigint"}, tie_breakers=("partition",))


def test_old_deletes_can_be_forgotten(spark, tmp_path):
    path = str(tmp_path / "state")
    events = [(1, "a", "d", 5, 1), (2, "b", "d", 50, 2), (3, "c", "c", 5, 3), (4, None, "d", None, 4)]
    apply_batch(bronze_of(spark, [envelope(*e) for e in events]), "b0", path, SPEC)
    compact(spark, path, SPEC, 4, forget_deletes_before=10)
    assert sorted(r.id for r in current_state(spark, path, SPEC).collect()) == [2, 3, 4]
    apply_batch(bronze_of(spark, [envelope(5, "e", "c", 60, 5)]), "b1", path, SPEC)
    compact(spark, path, SPEC, 4, forget_deletes_before=51)
    assert sorted(r.id for r in current_state(spark, path, SPEC).collect()) == [3, 4, 5]
    assert view(spark, path) == {3: "c", 5: "e"}


def test_a_state_may_start_over_in_the_same_place(spark, tmp_path):
    import shutil

    path = str(tmp_path / "state")
    for buckets, value in ((4, "first"), (3, "second")):
        apply_batch(bronze_of(spark, [envelope(k, value, "c", 1, 1) for k in range(20)]), "b0", path, SPEC)
        compact(spark, path, SPEC, buckets)
        assert view(spark, path) == {k: value for k in range(20)}
        shutil.rmtree(path)


def two_histories(spark, path):
    """A compacted first part and an open second one; returns what should be there."""
    later = [(k + 20, v, op, version + 1000, lsn + 1000) for k, v, op, version, lsn in history(2)]
    apply_batch(bronze_of(spark, [envelope(*e) for e in history(1)]), "b0", path, SPEC)
    compact(spark, path, SPEC, 8)
    apply_batch(bronze_of(spark, [envelope(*e) for e in later]), "b1", path, SPEC)
    return expected(history(1) + later)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Broadcast off: sorted. A limit between the deltas' size per bucket and in all: hashed.
@pytest.mark.parametrize("limit,join", [("-1", "SortMergeJoin"), ("2000", "ShuffledHashJoin")])
@pytest.mark.parametrize("partitions", ["3", "50"])
def test_base_is_read_without_shuffling_it(spark, settings, tmp_path, limit, join, partitions):
    settings(spark__sql__autoBroadcastJoinThreshold=limit, spark__sql__shuffle__partitions=partitions)
    path = str(tmp_path / "state")
    want = two_histories(spark, path)
    plan = plan_of(current_state(spark, path, SPEC))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(id" in plan and ", 8), REPARTITION_BY_NUM" in plan
    assert "Bucketed: true" in plan and join in plan
    assert view(spark, path) == want
    # Compaction keeps to the buckets: known keys in one file each, new keys in another.
    compact(spark, path, SPEC, 8)
    assert view(spark, path) == want
    written = list((tmp_path / "state" / "base" / "000000000001").glob("part-*"))
    assert len(written) <= 16


def test_small_deltas_are_sent_to_the_base(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="10485760")
    path = str(tmp_path / "state")
    want = two_histories(spark, path)
    state = current_state(spark, path, SPEC)
    assert plan_of(state).count("BroadcastHashJoin") >= 2
    assert view(spark, path) == want
    per_key = state.groupBy("id").count()
    assert per_key.filter("count > 1").count() == 0 and per_key.count() == state.count()
    compact(spark, path, SPEC, 8)
    assert view(spark, path) == want


def test_stream_restart_after_a_crash(spark, tmp_path, monkeypatch):
    """The third micro-batch fails after its state was written; the restarted query goes on."""
    import driftlake.streaming.ledger as ledger

    root = str(tmp_path)
    events = history(5)
    random.Random(1).shuffle(events)
    for n in range(5):
        feed(spark, f"{root}/topic", [envelope(*e) for e in events[n::5]], start=1000 * n)
    changes = read_changes(spark, "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1"})
    with pytest.raises(ValueError):
        start_scd1(to_bronze(changes), SPEC, f"{root}/s", f"{root}/c", compact_every=2)
    real, seen = ledger.apply_batch, []

    def crashing(batch, name, path, spec):
        real(batch, name, path, spec)
        seen.append(name)
        if len(seen) == 3:
            raise RuntimeError("lost")

    monkeypatch.setattr(ledger, "apply_batch", crashing)
    with pytest.raises(Exception, match="lost"):
        start_scd1(to_bronze(changes), SPEC, f"{root}/s", f"{root}/c").awaitTermination()
    start_scd1(
        to_bronze(changes), SPEC, f"{root}/s", f"{root}/c", compact_every=2, buckets=4
    ).awaitTermination()
    wait_for_compactions()
    assert "000000000000" in [p.name for p in (tmp_path / "s" / "base").iterdir()]
    assert seen[2] == seen[3] and len(set(seen)) == 5
    assert view(spark, f"{root}/s") == expected(events)
    # A new checkpoint reads everything again under other batch names.
    start_scd1(to_bronze(changes), SPEC, f"{root}/s", f"{root}/c2").awaitTermination()
    assert len(set(seen)) == 10
    assert view(spark, f"{root}/s") == expected(events)


def test_streaming_aggregate_matches(spark, tmp_path):
    root = str(tmp_path)
    events = history(9)
    random.Random(2).shuffle(events)
    for n in range(3):
        feed(spark, f"{root}/topic", [envelope(*e) for e in events[n::3]], start=1000 * n)
    changes = read_changes(spark, "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1"})
    decoded = valid_changes(decode(to_bronze(changes).select("payload"), SPEC), SPEC)
    start_latest(decoded, SPEC, f"{root}/out", f"{root}/c").awaitTermination()
    got = read_latest(spark, f"{root}/out", SPEC).filter("op <> 'd'")
    assert {r.id: r.v for r in got.collect()} == expected(events)


def test_composite_key_state(spark, tmp_path):
    spec = TableSpec("t", {"a": "bigint", "b": "string"}, {"v": "string"})
    path = str(tmp_path / "state")

    def raw(*rows):
        values = [json.dumps({"after": {"a": a, "b": b, "v": v}, "op": "u", "ts_ms": t}) for a, b, v, t in rows]
        return bronze_of(spark, values)

    apply_batch(raw((1, "x", "1", 1), (1, "y", "2", 1), (2, "x", "3", 1)), "b0", path, spec)
    compact(spark, path, spec, 3)
    apply_batch(raw((1, "y", "4", 2), (2, "y", "5", 1), (2, "x", "old", 0)), "b1", path, spec)
    want = {(1, "x", "1"), (1, "y", "4"), (2, "x", "3"), (2, "y", "5")}
    assert {tuple(r) for r in current_view(spark, path, spec).collect()} == want
    compact(spark, path, spec, 3)
    assert {tuple(r) for r in current_view(spark, path, spec).collect()} == want


def test_metrics_of_a_running_stream(spark, tmp_path):
    root = str(tmp_path)
    feed(spark, f"{root}/topic", [envelope(1, "a", "c", 1, 1), None, envelope(1, "a", "t", 1, 1)])
    changes = read_changes(spark, "parquet", f"{root}/topic")
    decoded = valid_changes(decode(to_bronze(changes), SPEC), SPEC, observe_as="decode")
    query = (
        decoded.writeStream.format("parquet").option("checkpointLocation", f"{root}/c")
        .trigger(availableNow=True).start(f"{root}/out")
    )
    query.awaitTermination()
    metrics = [p.observedMetrics["decode"] for p in query.recentProgress if p.observedMetrics]
    assert [(m.decoded, m.applied, m.rejected) for m in metrics] == [(3, 1, 2)]


def test_raw_table_by_name(spark, tmp_path):
    root = str(tmp_path)
    feed(spark, f"{root}/topic", ['{"a":1}', "2"])
    bronze = to_bronze(read_changes(spark, "parquet", f"{root}/topic"))
    start_bronze(bronze, f"{root}/c", table="raw_customers").awaitTermination()
    assert spark.table("raw_customers").select("payload").count() == 2


def test_printing_a_stream(spark, tmp_path):
    root = str(tmp_path)
    feed(spark, f"{root}/topic", ["shown"])
    query = start_print(read_changes(spark, "parquet", f"{root}/topic"))
    query.awaitTermination()
    assert query.recentProgress[0].numInputRows == 1
    assert "Console" in query.recentProgress[0].sink.description
