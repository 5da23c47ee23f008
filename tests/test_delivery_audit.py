import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import audit, delivery
from tablewright.sources.scan import replay
from tablewright.endpoints import rule_sender


def _requests(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    return df.select(F.sha2(F.col("k").cast("string"), 256).alias("request_id"), F.col("k").alias("key"),
                     F.to_json(F.struct(F.col("k").alias("id"))).alias("data"))


def test_classify(spark):
    df = spark.createDataFrame(
        [(200, "ok"), (202, "ok"), (429, "x"), (400, "Bad"), (400, "Attribute error"),
         (400, "Max Retry Error"), (500, "x"), (503, "x"), (999, "Protocol error"), (403, "x")],
        "s int, r string")
    got = [r.c for r in df.select(delivery.classify("s", "r").alias("c")).collect()]
    assert got == ["ok", "ok", "retry", "retry", "final", "final", "retry", "retry", "retry", "abort"]


def test_deliver_invariants(spark):
    keys = list(range(0, 400))
    attempts = delivery.deliver(_requests(spark, keys), rule_sender, max_retries=2).cache()
    final = delivery.final_outcome(attempts)
    out = delivery.outcome(attempts)
    assert final.count() == len(keys) == out.count()
    ok = final.where("ok").count()
    dead = delivery.dead_letters(final, 1)
    assert ok + dead.count() == len(keys)                       # ok + dead letters = total
    got = {r.request_id: (r.status_code, r.n_attempts) for r in out.collect()}
    fin = {r.request_id: (r.status_code, r.n_attempts) for r in final.collect()}
    assert got == fin                                           # max_by outcome = marked final
    by_key = {int(json.loads(r.data)["id"]): r.status_code for r in dead.collect()}
    assert by_key[100] == 500 and by_key[31] == 429 and by_key[97] == 999
    assert 150 not in by_key                                    # succeeded on attempt 2
    assert all(r.data is None for r in final.where("ok").collect())


def test_abort_is_a_row_and_nothing_is_sent_again(spark, tmp):
    def forbidden(req: pd.DataFrame, attempt: int) -> pd.DataFrame:
        with open(tmp + "/sent", "a") as f:
            f.write(f"{len(req)}\n")
        return pd.DataFrame({"status": [403] + [500] * (len(req) - 1), "reason": ["Forbidden"] * len(req),
                             "retry_after": [0] * len(req)})
    rows = delivery.deliver(_requests(spark, [1, 2, 3]).coalesce(1), forbidden)
    rows.write.parquet(tmp + "/attempts")
    got = spark.read.parquet(tmp + "/attempts")
    assert sorted(r.status for r in got.where("final").collect()) == [403, 500, 500]
    assert delivery.aborted(got) == 403 and delivery.aborted(got.where("status = 500")) is None
    assert open(tmp + "/sent").read() == "3\n"                  # one send, no retry of the task


def test_retry_schedule(spark):
    att = spark.createDataFrame(
        [("a", 1, 429, "r", 5, False), ("a", 2, 429, "r", 0, False), ("a", 3, 429, "r", 0, True),
         ("b", 1, 500, "r", 0, False), ("b", 6, 500, "r", 0, False)],
        "request_id string, attempt int, status int, reason string, retry_after int, final boolean")
    waits = {(r.request_id, r.attempt): r.wait_s for r in delivery.retry_schedule(att, 2, 60).collect()}
    assert waits == {("a", 1): 5.0, ("a", 2): 8.0, ("b", 1): 4.0, ("b", 6): 60.0}


def test_canary_split(spark):
    df = spark.createDataFrame([(5,), (3,), (9,)], "k int")
    canary, rest = delivery.canary_split(df, "k")
    assert [r.k for r in canary.collect()] == [3]
    assert sorted(r.k for r in rest.collect()) == [5, 9]


def test_replay_filters_run_and_codes(spark):
    dead = spark.createDataFrame(
        [("d", "t", 1, 500, "x", "r1", "{}"), ("d", "t", 1, 429, "x", "r2", "{}"),
         ("d", "t", 2, 500, "x", "r3", "{}")],
        "request_date string, request_ts string, run_id long, status_code int, failed_reason string, "
        "source_request_id string, data string")
    assert sorted(r.replayed_request_id for r in replay(dead, 1, 9).collect()) == ["r1", "r2"]
    again = replay(dead, 1, 9, [500]).collect()
    assert [r.replayed_request_id for r in again] == ["r1"] and again[0].request_id != "r1"
    doc = spark.createDataFrame([("d", "t", 1, 500, "x", "ab12", '{"a":1,"source_request_id":"ab12"}')],
                                dead.schema)
    r = replay(doc, 1, 9).first()
    assert json.loads(r.data) == {"a": 1, "source_request_id": r.request_id}


@pytest.mark.parametrize("total,failed,threshold,status", [
    (10, 5, None, "SUCCEEDED"), (0, 0, 90, "SUCCEEDED"), (10, 1, 90, "SUCCEEDED"),
    (10, 2, 90, "FAILED"), (10, 10, 1, "FAILED")])
def test_threshold(spark, total, failed, threshold, status):
    rows = [(i >= failed,) for i in range(total)]
    df = spark.createDataFrame(rows, "ok boolean") if rows else spark.createDataFrame([], "ok boolean")
    res = audit.run_counts(df, threshold).collect()
    if total == 0:
        assert res == [] or res[0].status == "SUCCEEDED"
    else:
        assert res[0].status == status
        assert res[0].failure_reason == (None if status == "SUCCEEDED" else audit.THRESHOLD_REASON)


def test_run_history_latest_and_rollup(spark):
    counts = spark.createDataFrame(
        [("P", 1, "SUCCEEDED", 10, 0, None), ("P", 2, "FAILED", 1, 9, "x"), ("Q", 3, "SUCCEEDED", 5, 0, None)],
        "p string, r long, status string, successful_record_count long, failed_record_count long, "
        "failure_reason string")
    ev = audit.run_events(counts, F.col("p"), F.col("r"), F.current_timestamp(), F.current_timestamp())
    started_only = ev.where("event_seq = 1 and run_id = 3")
    latest = audit.latest_runs(ev.where("run_id <> 3").unionByName(started_only))
    st = {(r.process_name, r.run_id): r.status for r in latest.collect()}
    assert st == {("p", 1): "SUCCEEDED", ("p", 2): "FAILED", ("q", 3): "STARTED"}
    roll = {r.process_name: (r.any_failed, r.n_runs, r.n_running) for r in audit.rollup_runs(latest).collect()}
    assert roll == {"p": (True, 2, 0), "q": (False, 1, 1)}


def test_observe_count(spark, tmp):
    df, obs = audit.observe_count(spark.range(123))
    df.write.parquet(tmp + "/o")
    assert obs.get["n"] == 123


def _bulk_sender(req: pd.DataFrame, attempt: int) -> pd.DataFrame:
    be = req["key"].str.split("-", expand=True).astype(int)
    status = ((be[0] + be[1]) % 5 == 0).map({True: 500, False: 202})
    return pd.DataFrame({"status": status.to_numpy(), "reason": ["x"] * len(req), "retry_after": [0] * len(req)})


def test_bulk_delivery_per_record(spark):
    keys = list(range(0, 1234))
    docs = _requests(spark, keys)
    bulk = delivery.bulk_requests(docs, "key", run_id=7, size=100, per_range=500)
    assert bulk.where(F.size("members") > 100).count() == 0
    final = delivery.final_outcome(delivery.deliver(bulk, _bulk_sender, max_retries=1, carry=("members",)))
    recs = delivery.per_record(final)
    assert recs.count() == len(keys) and recs.select("request_id").distinct().count() == len(keys)
    dead = delivery.dead_letters(recs, 7)
    ok = recs.where("ok").count()
    assert ok + dead.count() == len(keys) and dead.count() > 0
    # every dead letter holds exactly its own record's document
    ids = {json.loads(r.data)["id"] for r in dead.collect()}
    assert len(ids) == dead.count()
