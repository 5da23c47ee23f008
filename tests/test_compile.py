import json

from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.plans.compile import (
    compile_pipelines, config_violations, duplicate_keys, lookup_config, property_violations,
    qualify_fail_table, remaining_steps,
)

PROPS = {"PLAN_ID": "p", "event_name": "e", "Fail_Rec_Table_Name": "fails"}


def _config(spark):
    obj = spark.createDataFrame([
        ("Proc_A", "d", "db", "sch", "orders_v", "view", "db.sch.s", None,
         {"engage": "endpoint", "wh": "table"}, True, "orders", "db.sch.stg"),
        ("proc_b", "d", "db", "sch", "events", "TABLE", None, None, {"arch": "table"}, False, None, None),
        ("proc_c", "d", "db", "sch", "x", "stage", "s", None, {}, True, None, "stg"),
        ("PROC_B", "dup", "db", "sch", "events", "table", None, None, {"arch": "table"}, False, None, None),
    ], schemas.OBJECT_ATTR)
    tgt = spark.createDataFrame([
        ("proc_a", "ENGAGE", PROPS), ("proc_a", "wh", None),
        ("proc_b", "arch", {"plan_id": "x"}),
    ], schemas.TARGET_ATTR)
    col = spark.createDataFrame([
        ("proc_a", "engage", "id", None, "$id", "user_identities"),
        ("proc_a", "engage", "n", "upper(n)", "name", "user_attributes"),
        ("proc_a", "wh", "id", None, "id", "user_identities"),
        ("proc_b", "arch", "event_id", None, "event_id", None),
        ("proc_c", "t", "a", None, "a", None),
    ], schemas.COLUMN_ATTR)
    return obj, tgt, col


def test_duplicate_keys_case_insensitive(spark):
    df = spark.createDataFrame([("A",), ("a",), ("b",)], "k string")
    assert [(r.k, r.n_rows) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]


def test_lookup_and_properties(spark):
    obj, tgt, col = _config(spark)
    lk = {(r.process, r.target): (r.kind, r.n_columns, r.missing_properties)
          for r in lookup_config(obj.where("process_name = 'Proc_A'"), tgt, col).collect()}
    assert lk == {("proc_a", "engage"): ("endpoint", 2, False), ("proc_a", "wh"): ("table", 1, True)}
    miss = {(r.process, r.target): sorted(r.missing_keys) for r in property_violations(tgt).collect()}
    assert miss == {("proc_a", "wh"): ["event_name", "fail_rec_table_name", "plan_id"],
                    ("proc_b", "arch"): ["event_name", "fail_rec_table_name"]}
    q = tgt.where("target_name = 'ENGAGE'").select(
        qualify_fail_table(F.col("target_properties"), F.lit("db"), F.lit("sch")).alias("p")).first().p
    assert q["Fail_Rec_Table_Name"] == "db.sch.fails" and q["PLAN_ID"] == "p"


def test_config_violations(spark):
    obj, tgt, col = _config(spark)
    got = {(r.process, r.target, r.rule) for r in config_violations(obj, tgt, col).collect()}
    assert ("proc_b", None, "duplicate process") in got
    assert ("proc_c", None, "object type is neither table nor view") in got
    assert ("proc_c", None, "stream name is not database.schema.name") in got
    assert ("proc_c", None, "staging table name is not database.schema.name") in got
    assert ("proc_c", None, "target list is empty") in got
    assert not any(p == "proc_a" for p, _, _ in got)


def test_compile_and_resume(spark):
    obj, tgt, col = _config(spark)
    pipes = compile_pipelines(obj.where("lower(process_name) = 'proc_a'"), tgt, col)
    row = pipes.first()
    steps = [(s.step_id, s.func) for s in row.steps]
    assert steps == [(100, "consume_stream"), (200, "create_view"), (300, "sql"),
                     (400, "deliver"), (500, "table_sink"), (600, "drop_staging")]
    doc = json.loads(row.pipeline_config)
    assert doc["pipeline_name"] == "proc_a" and len(doc["data_flow"]) == 6
    deliver_args = row.steps[3].args
    assert json.loads(deliver_args["select_exp"]) == ["cast(1 as integer) AS dummy_num_column",   # P4
                                                      "id AS `id_user_identities`",
                                                      "upper(n) AS `name_user_attributes`"]
    assert json.loads(deliver_args["column_mapping"]) == {"user_identities": {"id_user_identities": "$id"},
                                                          "user_attributes": {"name_user_attributes": "name"}}
    assert json.loads(row.steps[4].args["select_exp"]) == ["id AS `id`"]   # by kind, not by category
    props = json.loads(deliver_args["properties"])
    assert props["Fail_Rec_Table_Name"] == "db.sch.fails"          # qualified (N5)
    rest = [r.step_id for r in remaining_steps(pipes, 400).collect()]
    assert rest == [400, 500, 600]
    assert remaining_steps(pipes, None).count() == 6
