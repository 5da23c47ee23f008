import json

from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.plans.runner import Config
from tablewright.streaming.deploy import current_pipelines, run_deploy_stream
from tests.test_compile import _config


def _deploy(spark, folder, rows):
    spark.createDataFrame(rows, "sequence_number long, process_name string, commit_message string") \
        .select("sequence_number", "process_name", F.lit(False).alias("replace_existing_stream"),
                "commit_message", F.lit("NEW").alias("status"), F.lit(None).cast("string").alias("log_message"),
                F.current_timestamp().cast("timestamp_ntz").alias("initiation_date_time"),
                F.lit(None).cast("timestamp_ntz").alias("completion_date_time")) \
        .coalesce(1).write.parquet(folder)


def test_deploy_stream_compiles_upserts_and_reports(spark, tmp):
    obj, tgt, col = _config(spark)
    cfg = Config(obj, tgt, col)
    src = tmp + "/deploy"
    _deploy(spark, src + "/d1", [(1, "PROC_A", "first"), (2, "proc_b", "dup"), (3, "ghost", "x")])
    out, status, ck = tmp + "/pipeline", tmp + "/status", tmp + "/ck"
    assert len(run_deploy_stream(spark, src + "/*", cfg, out, status, ck)) == 1
    p1 = {r.process_name: r for r in current_pipelines(spark, out).collect()}
    assert set(p1) == {"proc_a"}                                  # proc_b invalid, ghost unknown
    st = {r.process_name: (r.status, r.log_message) for r in spark.read.parquet(status).collect()}
    assert st["PROC_A"] == ("SUCCEEDED", None)
    assert st["proc_b"][0] == "FAILED" and "duplicate process" in st["proc_b"][1]
    assert st["ghost"] == ("FAILED", "process not found in object_attr")
    created = p1["proc_a"].create_date_time
    # redeploy: update keeps the creation columns, comment follows the commit
    _deploy(spark, src + "/d2", [(4, "proc_a", "second")])
    run_deploy_stream(spark, src + "/*", cfg, out, status, ck)
    p2 = {r.process_name: r for r in current_pipelines(spark, out).collect()}
    assert p2["proc_a"].comment_text == "second" and p2["proc_a"].create_date_time == created
    assert json.loads(p2["proc_a"].pipeline_config)["pipeline_name"] == "proc_a"
    assert run_deploy_stream(spark, src + "/*", cfg, out, status, ck) == []   # nothing new


def test_replace_existing_stream_opens_new_checkpoint(spark, tmp):
    from tablewright.streaming.capture import checkpoint_location
    from tablewright.streaming.deploy import replace_streams
    rows = spark.createDataFrame([(1, "Proc_R", True), (2, "proc_k", False)],
                                 "sequence_number long, process_name string, replace_existing_stream boolean")
    root = tmp + "/ckpts"
    assert checkpoint_location(spark, "proc_r", root=root).endswith("/v1")
    import os
    os.makedirs(root + "/proc_r/v1")
    os.makedirs(root + "/proc_k/v1")
    assert replace_streams(spark, rows, root) == ["proc_r"]
    assert checkpoint_location(spark, "proc_r", root=root).endswith("/v2")
    assert checkpoint_location(spark, "proc_k", root=root).endswith("/v1")   # kept its position


def test_deployed_pipeline_runs_by_name_as_of_deploy_time(spark, tmp):
    from tablewright.plans.runner import RunContext, Runner
    from tablewright.streaming.deploy import run_deployed
    path = tmp + "/t"
    # one key holds most rows, some have none, two rows are equal
    spark.range(0, 60).selectExpr("id", "if(id < 50, 1, null) as k", "'{\"a\": 1}' as js") \
        .unionByName(spark.sql("select 59L as id, cast(null as int) as k, '{\"a\": 1}' as js")).write.parquet(path)
    obj = spark.createDataFrame([("Proc_V", "d", "db", "sch", "v", "view", None, None,
                                  {"engage": "endpoint"}, False, None, None)], schemas.OBJECT_ATTR)
    tgt = spark.createDataFrame([("proc_v", "engage", {"plan_id": "p", "event_name": "e", "fail_rec_table_name": "f",
                                                       "key_column": "k", "json_columns": "js_user_attributes"})],
                                schemas.TARGET_ATTR)
    col = spark.createDataFrame([("proc_v", "engage", "id", None, "id", "user_identities"),
                                 ("proc_v", "engage", "k", None, "k", "user_attributes"),
                                 ("proc_v", "engage", "js", None, "js", "user_attributes")], schemas.COLUMN_ATTR)
    view = spark.createDataFrame([("V", "select * from s where id >= {{low}}", None, {"low": "0"})],
                                 schemas.QUERY_VIEW_CONFIG)
    order = spark.createDataFrame([("v", 1, None, "all_rows", "s", None)], schemas.QUERY_ORDER_CONFIG)
    tpl = spark.createDataFrame([("all_rows", "select id, k, js from t")], schemas.QUERY_TEMPLATE_CONFIG)
    _deploy(spark, tmp + "/deploy/d1", [(1, "PROC_V", "first")])
    run_deploy_stream(spark, tmp + "/deploy/*", Config(obj, tgt, col, view, order, tpl), tmp + "/pipeline",
                      tmp + "/status", tmp + "/ck")
    seen = tmp + "/work/attempts/proc_v/9/engage"

    def accept(requests, attempt):
        return requests.assign(status=[500 if '"id":59' in d else 202 for d in requests["data"]], reason="r",
                               retry_after=0)[["status", "reason", "retry_after"]]
    # after the deployment the tables lose their rows: nothing of them is read again
    none = lambda df: df.where("false")
    r = Runner(spark, Config(obj, none(tgt), none(col), none(view), none(order), none(tpl)), {"t": path}, sender=accept,
               max_retries=0, history=tmp + "/hist", dead_letter_root=tmp + "/dead", work_root=tmp + "/work")
    state = run_deployed(r, tmp + "/pipeline", RunContext("pRoC_v", run_id=9))
    assert state["successful_record_count"] + state["failed_record_count"] == 61
    assert state["failed_record_count"] == 2 == spark.read.parquet(tmp + "/dead/f").count()
    sent = spark.read.parquet(seen)
    assert sent.count() == 61 == sent.select("request_id").distinct().count()   # equal rows, too, have their own
    dead = json.loads(spark.read.parquet(tmp + "/dead/f").first().data)
    assert dead["user_attributes"]["js"] == {"a": 1} and dead["user_attributes"]["k"] is None


def _replacing(spark, rows):
    return spark.createDataFrame(rows, "sequence_number long, process_name string, commit_message string") \
        .select("sequence_number", "process_name", F.lit(True).alias("replace_existing_stream"),
                "commit_message", F.lit("NEW").alias("status"), F.lit(None).cast("string").alias("log_message"),
                F.current_timestamp().cast("timestamp_ntz").alias("initiation_date_time"),
                F.lit(None).cast("timestamp_ntz").alias("completion_date_time"))


def test_replayed_micro_batch_is_published_once(spark, tmp):
    from tablewright.streaming.capture import checkpoint_location
    from tablewright.streaming.deploy import newest_version, publish_deploys
    cfg, root, status, ckpts = Config(*_config(spark)), tmp + "/pipeline", tmp + "/status", tmp + "/ckpts"
    rows = _replacing(spark, [(1, "PROC_A", "first"), (2, "ghost", "x")])
    publish = lambda tx: publish_deploys(spark, rows, cfg, root, tx, status, ckpts)
    assert publish("s/0") == publish("s/0") == 1 == newest_version(spark, root)
    assert sorted(r.sequence_number for r in spark.read.parquet(status).collect()) == [1, 2]
    assert checkpoint_location(spark, "proc_a", root=ckpts).endswith("/v2")
    # another transaction with the same rows is another version
    assert publish("s/1") == 2 and checkpoint_location(spark, "proc_a", root=ckpts).endswith("/v3")
    # a replay of the older one changes neither
    assert publish("s/0") == 1 and newest_version(spark, root) == 2
    assert checkpoint_location(spark, "proc_a", root=ckpts).endswith("/v3")
    assert spark.read.parquet(status).count() == 4


def test_crash_before_and_after_the_log_row(spark, tmp, monkeypatch):
    import pytest

    from tablewright.streaming import deploy
    from tablewright.streaming.capture import checkpoint_location
    cfg, root, status, ckpts = Config(*_config(spark)), tmp + "/pipeline", tmp + "/status", tmp + "/ckpts"
    rows = _replacing(spark, [(1, "PROC_A", "first")])
    publish = lambda: deploy.publish_deploys(spark, rows, cfg, root, "s/0", status, ckpts)
    lost = lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
    with monkeypatch.context() as m:
        m.setattr(deploy.EventLog, "append", lost)
        with pytest.raises(OSError):
            publish()
    assert deploy.current_pipelines(spark, root).isEmpty() and deploy.newest_version(spark, root) == 0
    with monkeypatch.context() as m:
        m.setattr(deploy, "replace_checkpoint", lost)
        with pytest.raises(OSError):
            publish()
    assert deploy.newest_version(spark, root) == 1                       # published, its effects are open
    assert checkpoint_location(spark, "proc_a", root=ckpts).endswith("/v1")
    assert publish() == 1 and checkpoint_location(spark, "proc_a", root=ckpts).endswith("/v2")
    assert spark.read.parquet(status).count() == 1


def test_new_deploy_checkpoint_adds_to_the_newest_version(spark, tmp):
    obj, tgt, col = _config(spark)
    named = lambda df, p: df.where("lower(process_name) = 'proc_a'").withColumn("process_name", F.lit(p))
    every = lambda df: named(df, "proc_a").unionByName(named(df, "proc_x")).unionByName(named(df, "proc_d"))
    cfg = Config(every(obj), every(tgt), every(col))
    src, out, status = tmp + "/deploy", tmp + "/pipeline", tmp + "/status"
    for i, p in enumerate(("proc_a", "proc_d")):                         # versions 1 and 2
        _deploy(spark, f"{src}/d{i}", [(i, p, "x")])
        run_deploy_stream(spark, src + "/*", cfg, out, status, tmp + "/ck")
    _deploy(spark, tmp + "/other/d9", [(9, "proc_x", "x")])
    run_deploy_stream(spark, tmp + "/other/*", cfg, out, status, tmp + "/fresh")
    assert {r.process_name for r in current_pipelines(spark, out).collect()} == {"proc_a", "proc_x", "proc_d"}
