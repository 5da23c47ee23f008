import json
import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.plans.compile import compile_pipelines
from tablewright.streaming.capture import committed_batches
from tablewright.plans.runner import Config, RunContext, Runner
from tablewright.endpoints import rule_sender

PROPS = {"PLAN_ID": "plan", "event_name": "evt", "fail_rec_table_name": "fails",
         "key_column": "event_id", "threshold_percentage": "99"}


def _events(spark, tmp):
    path = tmp + "/events"
    spark.range(0, 300).select(
        F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type")) \
        .coalesce(1).write.parquet(path + "/drop1")
    return path


def _config(spark, incremental=False):
    obj = spark.createDataFrame([
        ("Events_Feed", "d", "db", "sch", "events", "table", "db.sch.events_stream", None,
         {"engage": "endpoint", "copy": "table"}, incremental, None, "db.sch.events_stg")],
        schemas.OBJECT_ATTR)
    tgt = spark.createDataFrame([("events_feed", "engage", PROPS),
                                 ("events_feed", "copy", {"table": "tw_runner_copy", "mode": "overwrite"})],
                                schemas.TARGET_ATTR)
    col = spark.createDataFrame([
        ("events_feed", "engage", "event_id", None, "event_id", "app_event_attributes"),
        ("events_feed", "engage", "user_id", "cast(user_id as string)", "customerid", "user_identities"),
        ("events_feed", "engage", "event_type", None, "kind", "user_attributes"),
        ("events_feed", "copy", "event_id", None, "id", None),
        ("events_feed", "copy", "event_type", "upper(event_type)", "kind", None),
    ], schemas.COLUMN_ATTR)
    return Config(obj, tgt, col)


def test_run_restart_and_history(spark, tmp):
    path = _events(spark, tmp)
    cfg = _config(spark)
    pipe = json.loads(compile_pipelines(cfg.object_attr, cfg.target_attr, cfg.column_attr).first().pipeline_config)
    # the document compiled from configuration drives the run
    steps = [(s["step_id"], s["func"]) for s in pipe["data_flow"]]
    assert steps == [(100, "sql"), (200, "table_sink"), (300, "deliver")]  # targets in name order
    r = Runner(spark, cfg, {"events": path + "/*"}, sender=rule_sender, max_retries=2,
               history=tmp + "/hist", dead_letter_root=tmp + "/dead")
    state = r.run(pipe, RunContext("events_feed", run_id=1))
    # failures of the rule sender among 0..299: multiples of 100 (500), of 31 (429), of 97 (999)
    bad = {k for k in range(300) if (k % 50 == 0 and k % 100 != 50) or (k % 31 == 0) or (k % 97 == 0)}
    assert state["failed_record_count"] == len(bad)
    assert state["successful_record_count"] == 300 - len(bad)
    assert state["status"] == "FAILED"                   # below 99 %
    assert spark.table("tw_runner_copy").count() == 300
    dead = spark.read.parquet(tmp + "/dead/fails")
    assert dead.where("run_id = 1").count() == len(bad)

    # restart from the delivery step, resending only the 500s, endpoint recovered
    def recovered(req: pd.DataFrame, attempt: int) -> pd.DataFrame:
        return pd.DataFrame({"status": [202] * len(req), "reason": ["Accepted"] * len(req),
                             "retry_after": [0] * len(req)})
    r2 = Runner(spark, cfg, {"events": path + "/*"}, sender=recovered,
                history=tmp + "/hist", dead_letter_root=tmp + "/dead")
    st2 = r2.run(pipe, RunContext("events_feed", run_id=2, restart_run_id=1, restart_step_id=300,
                                  status_codes=[500]))
    n500 = len([k for k in bad if k % 50 == 0])
    assert st2["successful_record_count"] == n500 and st2["failed_record_count"] == 0
    assert spark.read.parquet(tmp + "/dead/fails").where("run_id = 2").count() == 0
    latest = {row.run_id: row.status for row in r2.latest_runs().collect()}
    assert latest == {1: "FAILED", 2: "SUCCEEDED"}


def test_incremental_run_skips_without_new_data(spark, tmp):
    path = _events(spark, tmp)
    cfg = _config(spark, incremental=True)
    cfg.object_attr = cfg.object_attr.withColumn("primary_table", F.lit("events"))
    cfg.target_attr = cfg.target_attr.where("target_name = 'copy'")
    cfg.object_attr = cfg.object_attr.withColumn(
        "target_name_list", F.create_map(F.lit("copy"), F.lit("table")))
    pipe = json.loads(compile_pipelines(cfg.object_attr, cfg.target_attr, cfg.column_attr).first().pipeline_config)
    assert [s["func"] for s in pipe["data_flow"]] == ["consume_stream", "sql", "table_sink", "drop_staging"]
    proc = "events_feed_inc_" + uuid.uuid4().hex[:8]
    cfg.object_attr = cfg.object_attr.withColumn("process_name", F.lit(proc))
    cfg.column_attr = cfg.column_attr.withColumn("process_name", F.lit(proc))
    r = Runner(spark, cfg, {"events": path + "/*"}, history=tmp + "/hist")
    r.run(pipe, RunContext(proc, run_id=1))
    assert spark.table("tw_runner_copy").count() == 300
    spark.range(300, 310).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
                                 F.lit("click").alias("event_type")).write.parquet(path + "/drop2")
    r.run(pipe, RunContext(proc, run_id=2))
    assert spark.table("tw_runner_copy").count() == 10    # only the new delta
    state = r.run(pipe, RunContext(proc, run_id=3))       # nothing new: steps skipped
    assert state["status"] == "SUCCEEDED" and state["successful_record_count"] == 0
    assert spark.table("tw_runner_copy").count() == 10


def test_bulk_mode_and_canary_abort(spark, tmp):
    path = _events(spark, tmp)
    cfg = _config(spark)
    cfg.target_attr = spark.createDataFrame(
        [("events_feed", "engage", {**PROPS, "bulk_size": "40"}),
         ("events_feed", "copy", {"table": "tw_runner_copy2", "mode": "overwrite"})], schemas.TARGET_ATTR)
    pipe = json.loads(compile_pipelines(cfg.object_attr, cfg.target_attr, cfg.column_attr).first().pipeline_config)

    def every_third_envelope(req: pd.DataFrame, attempt: int) -> pd.DataFrame:
        env = req["key"].str.split("-").str[1].astype(int)
        st = (env % 3 == 0).map({True: 500, False: 202}).to_numpy()
        return pd.DataFrame({"status": st, "reason": ["r"] * len(req), "retry_after": [0] * len(req)})

    r = Runner(spark, cfg, {"events": path + "/*"}, sender=every_third_envelope, max_retries=0,
               history=tmp + "/hist", dead_letter_root=tmp + "/dead", work_root=tmp + "/work")
    state = r.run(pipe, RunContext("events_feed", run_id=11))
    dead = spark.read.parquet(tmp + "/dead/fails").where("run_id = 11")
    assert state["successful_record_count"] + state["failed_record_count"] == 300
    assert dead.count() == state["failed_record_count"] > 0              # one dead letter per record
    assert dead.select("source_request_id").distinct().count() == dead.count()

    def rejected(req: pd.DataFrame, attempt: int) -> pd.DataFrame:
        return pd.DataFrame({"status": [401] * len(req), "reason": ["Unauthorized"] * len(req),
                             "retry_after": [0] * len(req)})
    cfg.target_attr = spark.createDataFrame([("events_feed", "engage", PROPS),
                                             ("events_feed", "copy", {"table": "tw_runner_copy2",
                                                                      "mode": "overwrite"})],
                                            schemas.TARGET_ATTR)
    r2 = Runner(spark, cfg, {"events": path + "/*"}, sender=rejected, history=tmp + "/hist",
                dead_letter_root=tmp + "/dead", work_root=tmp + "/work")
    with pytest.raises(Exception, match="401"):
        r2.run(pipe, RunContext("events_feed", run_id=12))
    latest = {row.run_id: row.status for row in r2.latest_runs().collect()}
    assert latest[12] == "FAILED"
    # the canary was rejected: its one attempt is all that was sent
    sent = spark.read.parquet(tmp + "/work/attempts/events_feed/12/engage")
    assert [r.status for r in sent.collect()] == [401]
    assert not os.path.exists(tmp + "/dead/fails/run_id=12")             # that send is not complete


def test_run_executed_twice_leaves_dead_letters_once(spark, tmp):
    cfg = _config(spark)
    pipe = json.loads(compile_pipelines(cfg.object_attr, cfg.target_attr, cfg.column_attr).first().pipeline_config)
    r = Runner(spark, cfg, {"events": _events(spark, tmp) + "/*"}, sender=rule_sender, max_retries=0,
               history=tmp + "/hist", dead_letter_root=tmp + "/dead", work_root=tmp + "/work")
    first = r.run(pipe, RunContext("events_feed", run_id=5))
    again = r.run(pipe, RunContext("events_feed", run_id=5))
    assert first["failed_record_count"] == again["failed_record_count"] > 0
    assert spark.read.parquet(tmp + "/dead/fails").where("run_id = 5").count() == first["failed_record_count"]


@pytest.mark.parametrize("fail_at", ["sql", "table_sink", "file_sink", "drop_staging"])
def test_restart_processes_the_failed_runs_delta(spark, tmp, fail_at):
    path, proc = _events(spark, tmp), "restart_" + uuid.uuid4().hex[:8]
    cfg = _config(spark, incremental=True)
    named = lambda df: df.withColumn("process_name", F.lit(proc))
    cfg.object_attr = named(cfg.object_attr).withColumn("primary_table", F.lit("events")).withColumn(
        "target_name_list", F.create_map(F.lit("copy"), F.lit("table"), F.lit("files"), F.lit("files")))
    cfg.target_attr = named(spark.createDataFrame(
        [("p", "copy", {"table": "tw_restart_copy", "mode": "overwrite"}),
         ("p", "files", {"target_location": tmp + "/out", "file_format_type": "csv", "partition_by": "kind, part",
                         "format_type_options": '{"sep": "|"}', "header": "false",
                         "copy_options": '{"overwrite": "true"}'})], schemas.TARGET_ATTR))
    cfg.column_attr = named(spark.createDataFrame(
        [("p", "copy", "event_id", None, "id", None), ("p", "files", "event_id", None, "id", None),
         ("p", "files", "event_type", None, "kind", None), ("p", "files", "user_id", "user_id % 2", "part", None)],
        schemas.COLUMN_ATTR))
    pipe = json.loads(compile_pipelines(cfg.object_attr, cfg.target_attr, cfg.column_attr).first().pipeline_config)
    r = Runner(spark, cfg, {"events": path + "/*"}, history=tmp + "/hist", work_root=tmp + "/work")
    r.run(pipe, RunContext(proc, run_id=1))
    spark.range(300, 310).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
                                 F.lit("click").alias("event_type")).write.parquet(path + "/drop2")
    whole = r.steps[fail_at]

    def broken(runner, args, step_id):
        raise RuntimeError("lost")
    r.steps[fail_at] = broken
    with pytest.raises(RuntimeError, match="lost"):
        r.run(pipe, RunContext(proc, run_id=2))
    r.steps[fail_at] = whole
    with pytest.raises(RuntimeError, match="not processed yet"):
        r.run(pipe, RunContext(proc, run_id=3))
    step = [s["step_id"] for s in pipe["data_flow"] if s["func"] == fail_at][0]
    r.run(pipe, RunContext(proc, run_id=4, restart_run_id=2, restart_step_id=step))
    assert sorted(x.id for x in spark.table("tw_restart_copy").collect()) == list(range(300, 310))
    out = spark.read.schema("id long").option("sep", "|").csv(tmp + "/out")
    assert sorted(x.id for x in out.collect()) == list(range(300, 310))
    assert sorted(os.listdir(tmp + "/out/kind=click")) == ["part=1"]
    state = r.run(pipe, RunContext(proc, run_id=5))                     # committed: nothing is left to do
    assert state["status"] == "SUCCEEDED" and spark.table("tw_restart_copy").count() == 10


def test_change_feed_stream_process(spark, tmp):
    src = tmp + "/accounts"
    spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, "c", 30.0)], "id long, name string, bal double") \
        .write.parquet(src)
    obj = spark.createDataFrame([
        ("acct_feed", "d", "db", "sch", "accounts", "table", "db.sch.acct_stream",
         {"append_only": "false", "key_columns": "id"}, {"copy": "table"}, True, None, "db.sch.acct_stg")],
        schemas.OBJECT_ATTR)
    tgt = spark.createDataFrame([("acct_feed", "copy", {"table": "tw_acct_changes", "mode": "overwrite"})],
                                schemas.TARGET_ATTR)
    col = spark.createDataFrame([("acct_feed", "copy", "id", None, "id", None),
                                 ("acct_feed", "copy", "bal", None, "bal", None),
                                 ("acct_feed", "copy", "action", None, "action", None),
                                 ("acct_feed", "copy", "is_update", None, "is_update", None)], schemas.COLUMN_ATTR)
    cfg = Config(obj, tgt, col)
    pipe = json.loads(compile_pipelines(obj, tgt, col).first().pipeline_config)
    r = Runner(spark, cfg, {"accounts": src}, history=tmp + "/hist", work_root=tmp + "/work")
    r.run(pipe, RunContext("acct_feed", run_id=1))
    assert sorted(x.action for x in spark.table("tw_acct_changes").collect()) == ["INSERT"] * 3
    # staged data of a committed batch is dropped; its commit row stays
    assert not os.path.exists(tmp + "/work/staging/acct_feed/batch_id=0")
    assert committed_batches(spark, tmp + "/work/staging/acct_feed") == [0]
    # the table changes: 1 deleted, 2 updated, 4 inserted, 3 unchanged
    spark.createDataFrame([(2, "b", 25.0), (3, "c", 30.0), (4, "d", 40.0)], "id long, name string, bal double") \
        .write.mode("overwrite").parquet(src)
    r.run(pipe, RunContext("acct_feed", run_id=2))
    got = sorted((x.id, x.action, x.is_update, x.bal) for x in spark.table("tw_acct_changes").collect())
    assert got == [(1, "DELETE", False, 10.0), (2, "DELETE", True, 20.0), (2, "INSERT", True, 25.0),
                   (4, "INSERT", False, 40.0)]
    state = r.run(pipe, RunContext("acct_feed", run_id=3))        # no change: nothing to do
    assert state["status"] == "SUCCEEDED"
    assert spark.table("tw_acct_changes").count() == 4
