import os

import pytest
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.functions.params import bind_sql, to_markers
from tablewright.operators.upsert import upsert
from tablewright.sources.changes import change_feed
from tablewright.sources.scan import select_source
from tablewright.sources.views import build_view, with_delta


def test_change_feed_roundtrip(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, None, 4.0)],
                                "k int, s string, v double")
    new = spark.createDataFrame([(2, "b", None), (3, "c", 3.5), (4, "d", 4.0), (5, "e", 5.0)],
                                "k int, s string, v double")
    feed = change_feed(old, new, ["k"])
    rows = sorted((r.k, r.action, r.is_update) for r in feed.collect())
    assert rows == [(1, "DELETE", False), (3, "DELETE", True), (3, "INSERT", True),
                    (4, "DELETE", True), (4, "INSERT", True), (5, "INSERT", False)]
    # snapshot + change feed = next snapshot
    deleted = feed.where("action = 'DELETE'").select("k")
    applied = (old.join(deleted, "k", "left_anti")
                  .unionByName(feed.where("action = 'INSERT'").select("k", "s", "v")))
    assert sorted(applied.collect()) == sorted(new.collect())


def test_change_feed_null_keys_and_keys_only(spark):
    old = spark.createDataFrame([(None, 1, "a"), (1, None, "b"), (None, None, "c")], "j int, k int, s string")
    new = spark.createDataFrame([(None, 1, "a"), (1, None, "B"), (None, None, None)], "j int, k int, s string")
    assert change_feed(old, old, ["j", "k"]).count() == 0
    got = {(r.j, r.k, r.action, r.s, r.is_update) for r in change_feed(old, new, ["j", "k"]).collect()}
    assert got == {(1, None, "DELETE", "b", True), (1, None, "INSERT", "B", True),
                   (None, None, "DELETE", "c", True), (None, None, "INSERT", None, True)}
    keys = change_feed(old.select("j", "k"), new.select("j", "k").where("j is null"), ["j", "k"])
    assert [tuple(r) for r in keys.collect()] == [(1, None, "DELETE", False)]
    merged = {(r.j, r.k): r.s for r in upsert(old, new, ["j", "k"]).collect()}
    assert merged == {(None, 1): "a", (1, None): "B", (None, None): None}


def test_snapshot_stream_loses_nothing_when_its_log_write_fails(spark, tmp, monkeypatch):
    from tablewright.streaming import capture
    src, stage, snaps = tmp + "/t", tmp + "/stage", tmp + "/snaps"
    spark.createDataFrame([(1, "a")], "k int, s string").write.parquet(src)
    first = capture.capture_snapshot_changes(spark, src, ["k"], stage, snaps)
    capture.mark_committed(spark, stage, first)
    spark.createDataFrame([(1, "b"), (2, "c")], "k int, s string").write.mode("overwrite").parquet(src)
    with monkeypatch.context() as m:
        m.setattr(capture.EventLog, "append", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            capture.capture_snapshot_changes(spark, src, ["k"], stage, snaps)
    again = capture.capture_snapshot_changes(spark, src, ["k"], stage, snaps)
    staged = spark.read.parquet(f"{stage}/batch_id={again[0]}")
    assert sorted((r.k, r.action) for r in staged.collect()) == [(1, "DELETE"), (1, "INSERT"), (2, "INSERT")]
    assert os.path.exists(f"{snaps}/version={first[0]}")             # versions are added, not rewritten


def test_upsert_keeps_create_columns(spark):
    old = spark.createDataFrame([(1, "a", "c1"), (2, "b", "c2")], "k int, v string, created string")
    new = spark.createDataFrame([(2, "B", "n2"), (3, "C", "n3")], "k int, v string, created string")
    got = {r.k: (r.v, r.created) for r in upsert(old, new, ["k"], ["created"]).collect()}
    assert got == {1: ("a", "c1"), 2: ("B", "c2"), 3: ("C", "n3")}


def test_params_bound_and_missing(spark):
    text, args = to_markers("select {{a}} as x, '{{b}}' as y", {"a": 1, "b": "two"})
    assert text == "select :a as x, :b as y" and args == {"a": 1, "b": "two"}
    assert bind_sql(spark, "select {{a}} + 1 as x", {"a": 41}).first().x == 42
    with pytest.raises(KeyError):
        bind_sql(spark, "select {{a}} as x", {})


def _cfg(spark):
    spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, v string").createOrReplaceTempView("base_t")
    views = spark.createDataFrame(
        [("v1", "select * from s2", "unused_tpl", None), ("V2", None, "tpl_all", None),
         ("v3", None, None, None)], schemas.QUERY_VIEW_CONFIG)
    order = spark.createDataFrame(
        [("v1", 2, "select id, v from s1 where id >= {{lo}}", None, "s2", {"lo": "2"}),
         ("v1", 1, None, "tpl_all", "s1", None)], schemas.QUERY_ORDER_CONFIG)
    tpl = spark.createDataFrame([("tpl_all", "select id, v from base_t")], schemas.QUERY_TEMPLATE_CONFIG)
    return views, order, tpl


def test_build_view_sequence_templates_precedence(spark):
    views, order, tpl = _cfg(spark)
    v1 = build_view(spark, "v1", views, order, tpl)
    assert sorted(r.id for r in v1.collect()) == [2, 3]            # inline query wins over template
    assert sorted(r.id for r in build_view(spark, "v1", views, order, tpl, {"lo": 3}).collect()) == [3]
    assert build_view(spark, "v2", views, None, tpl).count() == 3   # template fallback, any case
    with pytest.raises(ValueError, match="neither"):
        build_view(spark, "v3", views, None, tpl)
    with pytest.raises(ValueError):
        build_view(spark, "missing", views, None, tpl)


def test_unknown_template(spark):
    views = spark.createDataFrame([("vx", "select * from t{{nope}}", None, None)], schemas.QUERY_VIEW_CONFIG)
    tpl = spark.createDataFrame([], schemas.QUERY_TEMPLATE_CONFIG)
    with pytest.raises(ValueError, match="nope"):
        build_view(spark, "vx", views, None, tpl)


def test_with_delta_binds_name_in_child_only(spark, tmp):
    full = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    full.createOrReplaceTempView("prim")
    full.where("id = 3").write.parquet(tmp + "/delta")
    child = with_delta(spark, tmp + "/delta", "prim")
    assert child.sql("select count(*) c from prim").first().c == 1
    assert spark.sql("select count(*) c from prim").first().c == 3


def test_select_source(spark):
    spark.createDataFrame([(1,)], "id int").createOrReplaceTempView("obj_t")
    delta = spark.createDataFrame([(9,)], "id int")
    name, df = select_source(spark, {"object_name": "obj_t", "object_type": "TABLE",
                                     "incremental_capture_flag": True}, delta)
    assert name == "obj_t_df" and df.first().id == 9
    assert select_source(spark, {"object_name": "obj_t", "object_type": "view"})[1].first().id == 1
    with pytest.raises(ValueError):
        select_source(spark, {"object_name": "obj_t", "object_type": "stage"})


def test_child_session_keeps_settings(spark):
    from tablewright.sources.views import child_session
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert child_session(spark).conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_identifier_parameter(spark):
    spark.createDataFrame([(1,), (2,)], "id int").createOrReplaceTempView("ident_t")
    assert bind_sql(spark, "select count(*) c from IDENTIFIER({{t}})", {"t": "ident_t"}).first().c == 2


@pytest.mark.parametrize("query,params,rows", [
    ("select 1 where \"a\" = \"{{p}}\"", {"p": "a"}, 1),
    ("select 1 where 'a' = \"{{ p }}\"", {"p": "b"}, 0),
    ("select 1 where 'xay' like \"%{{p}}%\"", {"p": "a"}, 1),
    ("select 1 where 'start a' = 'start {{p}}'", {"p": "a"}, 1),
    ("select 1 where 'starta' = 'start{{p}}'", {"p": "a"}, 1),              # no template in a literal
    ("select 1 where 'it''s a' = 'it''s {{p}}'", {"p": "a"}, 1),
    ("select 1 where 'a\\'a' = 'a\\'{{p}}'", {"p": "a"}, 1),
    ("select 1 where 'a' rlike r'^{{p}}$'", {"p": "."}, 1),
    ("select 1 where '\\\\d' = r'\\{{p}}'", {"p": "d"}, 1),
    ("select 1 -- {{q}} 'not a literal\nwhere {{p}} = 1", {"p": 1}, 1),
    ("select 1 /* {{q}} /* ' */ \" */ where {{p}} = 2", {"p": 1}, 0),
    ("select `x` from (select '--' as `x`) where x <> '/*' and {{p}} = 1 -- end", {"p": 1}, 1),
    ("select /*+ coalesce(1) */ 1 where '{{p}}' = 5", {"p": 5}, 1),
])
def test_placeholders_in_every_place(spark, query, params, rows):
    assert bind_sql(spark, query, params).count() == rows
    assert "{{" not in to_markers(query, params)[0]


@pytest.mark.parametrize("query", ["select `{{p}}` from t", "select 1 as `a_{{p}}`", "select /*+ broadcast({{p}}) */ 1",
                                   "select 'open {{p}}", "select 1 /* open {{p}}", "select `open {{p}}", "select * from t{{p}}"])
def test_placeholders_that_cannot_be_bound_are_refused(query):
    with pytest.raises(ValueError):
        to_markers(query, {"p": "a"})


def test_template_references_are_plain_text_only():
    from tablewright.functions.params import placeholders, replace_template_refs, template_refs
    q = "select * from t{{ big }} where a = 't{{x}}' -- t{{no}}\n and b = \"t{{y}}\""
    assert template_refs(q) == ["big"] and placeholders(q) == ["x", "y"]
    assert replace_template_refs(q, {"big": "v"}).startswith("select * from v where a = 't{{x}}'")
