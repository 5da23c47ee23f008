"""Repeated and null keys, replaced streams, embedded parameters."""

import pytest

from tablewright.functions.params import bind_sql
from tablewright.operators.delivery import canary_split
from tablewright.sources.views import build_view
from tablewright.streaming.capture import capture_changes, checkpoint_location, mark_committed, read_staged, replace_checkpoint


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "a"), (1, "b")], [(None, "a"), (None, "a"), (2, "b")], [(3, "x")]])
def test_canary_takes_one_record(spark, rows):
    df = spark.createDataFrame(rows, "k long, v string")
    canary, rest = canary_split(df, "k")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert canary.count() == 1
    assert sorted(map(tuple, canary.unionByName(rest).collect()), key=key) == sorted(rows, key=key)


def test_replaced_stream_stages_every_waiting_row(spark, tmp):
    src, stage, root = tmp + "/src", tmp + "/stage", tmp + "/ck"
    spark.range(100).write.parquet(src + "/a")
    schema = spark.range(1).schema
    first = capture_changes(spark, src + "/*", schema, stage, checkpoint_location(spark, "p", root))
    mark_committed(spark, stage, first)
    replace_checkpoint(spark, "p", root)
    spark.range(100, 150).write.parquet(src + "/b")
    again = capture_changes(spark, src + "/*", schema, stage, checkpoint_location(spark, "p", root))
    assert read_staged(spark, stage, schema, again).count() == 150 and not set(first) & set(again)
    assert capture_changes(spark, src + "/*", schema, stage, checkpoint_location(spark, "p", root),
                           block_unfinished=False) == []


def test_start_point_needs_time_column(spark, tmp):
    with pytest.raises(ValueError, match="time column"):
        capture_changes(spark, tmp, spark.range(1).schema, tmp + "/s", tmp + "/c/v1", since="2024-01-01")


def test_parameter_inside_literal(spark):
    spark.createDataFrame([("abc",), ("xyz",)], "s string").createOrReplaceTempView("lits")
    assert [r.s for r in bind_sql(spark, "select s from lits where s like '%{{p}}%'", {"p": "b"}).collect()] == ["abc"]
    assert bind_sql(spark, "select 'it''s {{p}}' as t", {"p": 5}).first().t in ("it's 5", "its 5")


def test_template_with_two_parameter_sets(spark):
    spark.range(100).createOrReplaceTempView("nums")
    tpl = spark.createDataFrame([("cut", "select * from nums where id < {{n}}")], "query_template_name string, query_template string")
    order = spark.createDataFrame(
        [("v", 1, "select * from t{{cut}}", None, "a", {"n": "90"}), ("v", 2, "select * from t{{cut}}", None, "b", {"n": "10"})],
        "view_name string, execution_sequence int, query string, query_template_name string, temp_table string, parameters map<string,string>")
    view = spark.createDataFrame([("v", "select (select count(*) from a) as a, (select count(*) from b) as b", None, {"n": "0"})],
                                 "view_name string, query string, query_template_name string, parameters map<string,string>")
    assert tuple(build_view(spark, "v", view, order, tpl).first()) == (90, 10)
