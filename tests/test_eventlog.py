"""Logs stay small to read; batch ranges; stream versions by transaction."""

import os

import pytest
from pyspark.sql import functions as F

from tablewright.streaming import capture
from tablewright.streaming.eventlog import EventLog


def test_log_compaction_loses_and_repeats_nothing(spark, tmp):
    log = EventLog(spark, tmp + "/log", "n long, s string", every=5)
    for i in range(23):
        log.append([(i, None if i % 2 else "x")])
        assert len(log._state()[1]) < 5
    assert sorted(r.n for r in log.rows().collect()) == list(range(23))
    assert len([n for n in os.listdir(tmp + "/log") if n.startswith("checkpoint")]) == 1


def test_crash_before_the_held_files_are_dropped(spark, tmp, monkeypatch):
    log = EventLog(spark, tmp + "/log", "n long", every=3)
    log.append([(1,)])
    log.append([(2,)])

    class Lost:
        def __getattr__(self, name):
            if name == "delete":
                raise OSError("lost")
            return getattr(EventLog._fs(log), name)
    with monkeypatch.context() as m:
        m.setattr(log, "_fs", lambda: Lost())
        with pytest.raises(OSError):
            log.append([(3,)])
    assert sorted(r.n for r in log.rows().collect()) == [1, 2, 3]       # held by the checkpoint, still in the tail
    for i in (4, 5, 6):
        log.append([(i,)])
    assert sorted(r.n for r in log.rows().collect()) == [1, 2, 3, 4, 5, 6]


def test_unfinished_checkpoint_does_not_count(spark, tmp):
    log = EventLog(spark, tmp + "/log", "n long", every=100)
    log.append([(1,)])
    os.makedirs(tmp + "/log/checkpoint=1-x/rows")
    assert [r.n for r in log.rows().collect()] == [1]


def test_batch_log_after_very_many_runs(spark, tmp):
    """1,000 committed batches, two stream versions, some open: few files and rows are read."""
    stage = tmp + "/stage"
    ids = [*range(700), *range(capture.VERSION_STEP, capture.VERSION_STEP + 300)]
    for i in range(0, 1000, 20):
        capture._log(spark, stage, ids[i:i + 20], "staged", "committed")
    capture._log(spark, stage, [capture.VERSION_STEP + 300, capture.VERSION_STEP + 302], "staged")
    log = capture.batch_log(spark, stage)
    folder, tail, _ = log._state()
    assert folder and len(tail) < 40 and log.rows().count() < 40 * 40 + 5
    assert len(os.listdir(folder.replace("file:", "") + "/rows")) <= 5
    log.compact()
    assert log.rows().count() == 4                                       # two ranges, two open batches
    assert capture.committed_ranges(spark, stage) == [(0, 699), (capture.VERSION_STEP, capture.VERSION_STEP + 299)]
    assert capture.uncommitted_batches(spark, stage) == [capture.VERSION_STEP + 300, capture.VERSION_STEP + 302]
    capture.mark_committed(spark, stage, [capture.VERSION_STEP + 302])
    assert capture.uncommitted_batches(spark, stage) == [capture.VERSION_STEP + 300]
    assert len(capture.committed_batches(spark, stage)) == 1001


def test_capture_reads_no_list_of_batches(spark, tmp, monkeypatch):
    src, stage, ck = tmp + "/src", tmp + "/stage", tmp + "/ck/v1"
    spark.range(5).write.parquet(src + "/a")
    schema = spark.range(1).schema
    monkeypatch.setattr(capture, "committed_batches", lambda *a: pytest.fail("reads every batch id"))
    first = capture.capture_changes(spark, src + "/*", schema, stage, ck)
    capture.mark_committed(spark, stage, first)
    capture.purge_committed(spark, stage, first)
    capture.batch_log(spark, stage).compact()
    assert capture.capture_changes(spark, src + "/*", schema, stage, tmp + "/fresh/v1") == []   # replayed, known as done
    spark.range(5, 9).write.parquet(src + "/b")
    again = capture.capture_changes(spark, src + "/*", schema, stage, ck)
    assert capture.read_staged(spark, stage, schema, again).count() == 4


def test_replacement_is_one_per_transaction(spark, tmp):
    assert capture.replace_checkpoint(spark, "P", tmp, "tx1").endswith("/p/v2")
    assert capture.replace_checkpoint(spark, "p", tmp, "tx1").endswith("/p/v2")
    assert capture.replace_checkpoint(spark, "p", tmp, "tx2").endswith("/p/v3")
    assert capture.replace_checkpoint(spark, "p", tmp, "tx1").endswith("/p/v2")
    assert capture.checkpoint_location(spark, "p", tmp).endswith("/p/v3")
    capture.stream_versions(spark, "p", tmp).compact()
    assert capture.checkpoint_location(spark, "P", tmp).endswith("/p/v3")
    assert capture.checkpoint_location(spark, "q", tmp).endswith("/q/v1")


def test_run_history_is_compacted_and_read_from_a_run_id(spark, tmp):
    from tablewright.plans.runner import RunContext, Runner
    r = Runner(spark, None, {}, history=tmp + "/hist", work_root=tmp + "/work")
    for run in range(60):
        r.ctx = RunContext("P" if run % 2 else "q", run_id=run)
        r._history([(1, "STARTED", None, None, None, None, None), (2, "SUCCEEDED", run, 0, None, None, {"t": run})], None)
    for name in ("p", "q"):
        assert len(r._log(name)._state()[1]) < 40
    rows = {x.run_id: x for x in r.latest_runs().collect()}
    assert len(rows) == 60 and rows[7].status == "SUCCEEDED" and rows[7].target_rows == {"t": 7}
    assert sorted(x.run_id for x in r.latest_runs("P", since_run_id=55).collect()) == [55, 57, 59]
    assert r.latest_runs().where(F.col("process_name") == "p").count() == 30
