"""Compactions that fail are noticed, and of two at a time one is refused; timeouts that last."""

import logging

import pytest
from test_streaming import SPEC, envelope, feed, view

from driftlake.sources import files, read_changes
from driftlake.streaming import apply_batch, compact, ledger, start_scd1, to_bronze, wait_for_compactions
from driftlake.streaming.bronze import SinkWriteError, with_retries


def batches(spark, root, first, n):
    for i in range(first, first + n):
        feed(spark, f"{root}/topic", [envelope(k, f"v{i}", "u", i, i * 10 + k) for k in range(4)], start=i * 10)


def start(spark, root, compact_every=1):
    raw = to_bronze(read_changes(spark, "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1"}))
    return start_scd1(raw, SPEC, f"{root}/state", f"{root}/checkpoint", compact_every=compact_every, buckets=2)


def raw(spark, rows):
    return spark.createDataFrame([(envelope(*r),) for r in rows], "payload string")


def test_a_failed_compaction_stops_the_stream(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    batches(spark, root, 0, 4)
    whole = ledger.compact

    def broken(*_):
        raise OSError("no space left")

    monkeypatch.setattr(ledger, "compact", broken)
    monkeypatch.setattr(ledger._aside, "submit", lambda run: _ran(run))
    with pytest.raises(Exception, match="no space left"):
        start(spark, root).awaitTermination()
    monkeypatch.undo()
    ledger._compactions.clear()
    assert ledger.compact is whole
    start(spark, root).awaitTermination()
    wait_for_compactions()
    assert view(spark, f"{root}/state") == {k: "v3" for k in range(4)}


def _ran(run):
    """A future that is over already."""
    from concurrent.futures import Future

    done = Future()
    try:
        done.set_result(run())
    except Exception as failure:
        done.set_exception(failure)
    return done


def test_waiting_raises_what_the_last_compaction_failed_with(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    batches(spark, root, 0, 1)

    def broken(*_):
        raise OSError("no space left")

    monkeypatch.setattr(ledger, "compact", broken)
    start(spark, root).awaitTermination()
    with pytest.raises(OSError, match="no space left"):
        wait_for_compactions()
    wait_for_compactions()  # said once


def test_a_second_compaction_of_the_same_base_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    apply_batch(raw(spark, [(1, "a", "u", 1, 1), (2, "b", "u", 1, 2)]), "b0", root, SPEC)
    compact(spark, root, SPEC, 2)
    apply_batch(raw(spark, [(1, "c", "u", 2, 3)]), "b1", root, SPEC)
    write = ledger._write_buckets

    def meanwhile(*args):
        """Another compaction, of one more delta, ends before this one."""
        write(*args)
        monkeypatch.setattr(ledger, "_write_buckets", write)
        apply_batch(raw(spark, [(3, "d", "u", 3, 4)]), "b2", root, SPEC)
        assert compact(spark, root, SPEC, 2) == f"{1:012d}"

    monkeypatch.setattr(ledger, "_write_buckets", meanwhile)
    with pytest.raises(ledger.CompactionConflictError):
        compact(spark, root, SPEC, 2)
    assert view(spark, root) == {1: "c", 2: "b", 3: "d"}
    fs, handle = files.open_path(spark, f"{root}/building/*")
    assert len(fs.globStatus(handle)) == 0
    assert files.finished_children(spark, f"{root}/base", ledger.COVERED) == [f"{n:012d}" for n in range(2)]
    apply_batch(raw(spark, [(2, "x", "d", 9, 9)]), "b3", root, SPEC)
    assert compact(spark, root, SPEC, 2) == f"{2:012d}"
    assert view(spark, root) == {1: "c", 3: "d"}


def test_an_interrupted_compaction_is_never_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    apply_batch(raw(spark, [(1, "a", "u", 1, 1)]), "b0", root, SPEC)

    def lost(spark, source, target):
        raise ConnectionError("driver lost")

    monkeypatch.setattr(files, "move_new", lost)
    with pytest.raises(ConnectionError):
        compact(spark, root, SPEC, 2)
    monkeypatch.undo()
    assert view(spark, root) == {1: "a"}
    assert compact(spark, root, SPEC, 2) == f"{0:012d}"
    assert view(spark, root) == {1: "a"}


def test_lasting_timeouts(caplog):
    pauses, calls = [], []

    def write():
        calls.append(1)
        if len(calls) < 13:
            raise TimeoutError("slow")

    with caplog.at_level(logging.WARNING):
        with_retries(write, sleep=pauses.append)
    assert pauses == [30.0] * 12
    levels = [r.levelno for r in caplog.records if "timed out" in r.getMessage()]
    assert levels == [logging.WARNING] * 9 + [logging.ERROR] * 3

    def never():
        raise TimeoutError("slow")

    with pytest.raises(SinkWriteError, match="timed out 4 times"):
        with_retries(never, sleep=pauses.append, timeouts=4)
