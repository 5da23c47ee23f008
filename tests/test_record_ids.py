"""Records are a multiset: every one is sent once, under an id of its own."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.operators import delivery
from tablewright.plans.compile import compile_pipelines
from tablewright.plans.runner import Config, RunContext, Runner

PROPS = {"PLAN_ID": "plan", "event_name": "evt", "fail_rec_table_name": "fails"}


def _process(spark, tmp, df, rules, props=PROPS, targets=None):
    df.write.mode("overwrite").parquet(tmp + "/src")
    targets = targets or {"engage": "endpoint"}
    obj = spark.createDataFrame([("feed", "d", "db", "sch", "src", "table", None, None, targets, False, None, None)],
                                schemas.OBJECT_ATTR)
    tgt = spark.createDataFrame([("feed", "engage", props)] + [
        ("feed", t, {"table": "tw_ids_copy", "mode": "overwrite", "path": tmp + "/copy"} if kind == "table" else
         {"target_location": tmp + "/files", "file_format_type": "parquet", "mode": "overwrite"})
        for t, kind in targets.items() if kind != "endpoint"], schemas.TARGET_ATTR)
    col = spark.createDataFrame([("feed", "engage", c, rule, c, cat) for c, rule, cat in rules] + [
        ("feed", t, rules[0][0], None, "copied", None) for t, kind in targets.items() if kind != "endpoint"], schemas.COLUMN_ATTR)
    cfg = Config(obj, tgt, col)
    pipe = json.loads(compile_pipelines(obj, tgt, col).first().pipeline_config)

    def accept(req, attempt):
        return pd.DataFrame({"status": [202] * len(req), "reason": ["ok"] * len(req), "retry_after": [0] * len(req)})
    r = Runner(spark, cfg, {"src": tmp + "/src"}, sender=accept, history=tmp + "/hist", dead_letter_root=tmp + "/dead",
               work_root=tmp + "/work")

    def run(run_id):
        state = r.run(pipe, RunContext("feed", run_id=run_id))
        sent = spark.read.parquet(f"{tmp}/work/attempts/feed/{run_id}/engage")
        return state, sorted(x.request_id for x in sent.collect())
    return r, run


@pytest.mark.parametrize("props", [PROPS, PROPS | {"bulk_size": "7"}, PROPS | {"key_column": "k"}])
def test_sent_is_read(spark, tmp, props):
    rows = [(1, "same")] * 100 + [(None, None)] * 30 + [(2, None)] + [(i, str(i)) for i in range(200)]
    _, run = _process(spark, tmp, spark.createDataFrame(rows, "k long, v string").repartition(3),
                      [("k", None, "user_attributes"), ("v", None, "app_event_attributes")], props)
    state, ids = run(1)
    assert state["successful_record_count"] == len(rows) and state["per_target"]["engage"]["rows"] == len(rows)
    assert len(set(ids)) == len(ids) == (len(rows) if "bulk_size" not in props else len(ids))
    assert run(1)[1] == ids                                             # a rerun repeats them
    assert not set(run(2)[1]) & set(ids)                                # another run has its own


def test_rules_that_change_are_evaluated_once(spark, tmp):
    _, run = _process(spark, tmp, spark.range(300).withColumnRenamed("id", "k"),
                      [("k", None, "user_attributes"), ("at", "cast(current_timestamp() as string)", "user_attributes"),
                       ("r", "rand()", "user_attributes"), ("none", "null", "user_attributes")])
    state, ids = run(1)
    assert state["status"] == "SUCCEEDED" and state["successful_record_count"] == 300 and len(set(ids)) == 300


def test_ids_of_equal_records(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("b", 2)] + [("c", 3)] * 2, "rid string, x int").repartition(4)
    got = delivery.numbered_repeats(df, "rid", delivery.repeated_records(df, "rid"))
    assert sorted((r.rid, r.x) for r in got.collect()) == [
        ("a", 1), ("a|2", 1), ("a|3", 1), ("a|4", 1), ("a|5", 1), ("b", 2), ("c", 3), ("c|2", 3)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_rows_of_every_target_are_in_the_history(spark, tmp):
    r, run = _process(spark, tmp, spark.range(123).withColumnRenamed("id", "k"), [("k", None, "user_attributes")],
                      targets={"engage": "endpoint", "copy": "table", "files": "files"})
    state, _ = run(1)
    assert {t: c["rows"] for t, c in state["per_target"].items()} == {"engage": 123, "copy": 123, "files": 123}
    assert state["successful_record_count"] == 123                       # only endpoints deliver records
    last = r.latest_runs().first()
    assert last.target_rows == {"engage": 123, "copy": 123, "files": 123} and last.status == "SUCCEEDED"


@pytest.mark.parametrize("per_range,ranges", [(1000, 4), (100, 32), (10**6, 1)])
def test_envelope_ranges_follow_the_input(spark, per_range, ranges):
    df = spark.range(0, 3000, 1, 3).withColumnRenamed("id", "k")
    env = delivery.envelopes(df, "k", size=50, per_range=per_range)
    per = env.groupBy("bucket", "envelope").count().collect()
    assert sum(r["count"] for r in per) == 3000 and max(r["count"] for r in per) <= 50
    sizes = {r.bucket: r["count"] for r in env.groupBy("bucket").count().collect()}
    assert len(sizes) == ranges and len(per) == sum(-(-n // 50) for n in sizes.values())


def test_a_new_record_moves_its_range_only(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    at = lambda d: {r.k: (r.bucket, r.envelope) for r in delivery.envelopes(d, "k", 50, 1000).collect()}
    before, after = at(df), at(df.union(spark.range(9001, 9002)))
    moved = {before[k][0] for k in before if before[k] != after[k]}
    assert moved <= {after[9001][0]}


def test_envelopes_of_repeated_and_null_keys(spark):
    rows = [(1, f"v{i}") for i in range(1000)] + [(None, f"n{i % 3}") for i in range(60)] + [(i, "u") for i in range(2, 300)]
    df = spark.createDataFrame(rows, "k long, v string").repartition(5)
    env = delivery.envelopes(df, "k", size=40, per_range=200)
    assert sorted((r.k or 0, r.v) for r in env.collect()) == sorted((k or 0, v) for k, v in rows)
    assert max(r["count"] for r in env.groupBy("bucket", "envelope").count().collect()) <= 40


def test_documents_are_not_sorted_by_a_window(spark):
    docs = spark.range(0, 500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("request_id"),
                                      F.lit("{}").alias("data"))
    plan = delivery.bulk_requests(docs, "k", 1, 50, 100)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not any("data#" in w for w in windows)


def test_canary_of_any_columns(spark):
    df = spark.sql("select * from values (2, map('a', 1)), (1, map('b', 2)), (1, map('b', 2)), (1, map('c', 3)) as t(k, m)")
    canary, rest = delivery.canary_split(df, "k")
    key = lambda r: (r.k, sorted(r.m.items()))
    assert canary.count() == 1 and canary.first().k == 1
    assert sorted(map(key, canary.unionByName(rest).collect())) == sorted(map(key, df.collect()))
