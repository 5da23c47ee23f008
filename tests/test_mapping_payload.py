import json

import pytest
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.operators import mapping
from tablewright.operators.payload import build_payload

ROWS = [
    ("P1", "T1", "a", None, "A_out", None),
    ("p1", "t1", "b", "upper(b)", "b_up", None),
    ("p1", "t1", "c", None, None, None),
    ("p2", "t1", "a", None, "other", None),
]

CAT_ROWS = [
    ("p", "mp", "id", "cast(id as string)", "CustomerID", "User_Identities"),
    ("p", "mp", "name", None, "$name", "USER_ATTRIBUTES"),
    ("p", "mp", "tags", None, "tags", "user_attributes"),
    ("p", "mp", "kind", None, "event_type", "app_event_attributes"),
    ("p", "mp", "name", "lower(name)", "$name", "app_event_attributes"),
    ("p", "mp", "score", None, "score", "app_event_attributes"),
    ("p", "mp", "x", None, None, "app_event_attributes"),
]


def test_mapping_plain(spark):
    cattr = spark.createDataFrame(ROWS, schemas.COLUMN_ATTR)
    df = spark.createDataFrame([(1, "x", 3)], "a int, b string, c int")
    out = mapping.map_columns(df, cattr, "p1", "T1")
    assert sorted(out.columns) == ["A_out", "b_up"]
    assert out.first().asDict() == {"A_out": 1, "b_up": "X"}


def test_mapping_errors(spark):
    cattr = spark.createDataFrame(ROWS, schemas.COLUMN_ATTR)
    df = spark.createDataFrame([(1, "x", 3)], "a int, b string, c int")
    with pytest.raises(ValueError, match="no column mapping"):
        mapping.map_columns(df, cattr, "nope", "t1")
    with pytest.raises(ValueError, match="category"):
        mapping.map_columns(df, cattr, "p1", "t1", categorised=True)


def test_categorised_aliases_and_category_map(spark):
    cattr = spark.createDataFrame(CAT_ROWS, schemas.COLUMN_ATTR)
    exprs = mapping.select_exprs(cattr, "p", "mp", categorised=True)
    assert exprs[0] == "cast(1 as integer) AS dummy_num_column"
    assert "lower(name) AS `name_app_event_attributes`" in exprs
    assert "name AS `name_user_attributes`" in exprs
    cmap = mapping.category_map_dict(cattr, "p", "mp")
    assert cmap["user_identities"] == {"CustomerID_user_identities": "CustomerID"}
    assert cmap["user_attributes"]["name_user_attributes"] == "$name"
    assert cmap["app_event_attributes"]["name_app_event_attributes"] == "$name"


def test_payload_document(spark):
    cattr = spark.createDataFrame(CAT_ROWS, schemas.COLUMN_ATTR)
    df = spark.createDataFrame(
        [(7, "Ann", ["a", "b"], "click", 1.5, None), (8, None, None, None, None, None)],
        "id long, name string, tags array<string>, kind string, score double, x string")
    proj = mapping.map_columns(df.withColumn("key", F.col("id")), cattr, "p", "mp", categorised=True)
    proj = proj.withColumn("key", F.col("CustomerID_user_identities").cast("long"))
    cmap = mapping.category_map_dict(cattr, "p", "mp")
    props = {"PLAN_ID": "plan", "event_name": "evt", "FAIL_REC_TABLE_NAME": "x"}
    docs = {r.key: json.loads(r.data) for r in build_payload(proj, cmap, props, "development", 1, "key").collect()}
    d = docs[7]
    assert d["user_identities"] == {"customerid": "7"}          # identity keys lower-cased
    assert d["user_attributes"] == {"$name": "Ann", "tags": ["a", "b"]}  # arrays nest as JSON
    ev = d["events"][0]
    assert ev["event_type"] == "click"                          # moved out of the data (N4)
    assert ev["data"] == {"event_name": "evt", "custom_event_type": "other", "$name": "ann", "score": 1.5}
    assert d["context"] == {"data_plan": {"plan_id": "plan"}}   # no version given (N3)
    # nulls stay as null; a missing event type gets the default
    assert docs[8]["user_attributes"] == {"$name": None, "tags": None}
    assert docs[8]["events"][0]["event_type"] == "custom_event"
    assert d["source_request_id"] != docs[8]["source_request_id"]


def test_payload_requires_plan_id(spark):
    df = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(ValueError, match="plan_id"):
        build_payload(df, {}, {"event_name": "e"}, "dev", 1, "k")


def test_columns_nest_by_their_type(spark):
    df = spark.sql("""select 1 as k, array(1, 2) as a, map('x', 1) as m, map(1, array(map(2, 'y'))) as im,
                      named_struct('s', map(3, null)) as st, parse_json('{"v": [1]}') as vo, parse_json('[1, "b"]') as va,
                      parse_json('7') as vs, '{"t": 1}' as t, cast(null as map<string,int>) as nm, interval '1' day as iv""")
    names = ["a", "m", "im", "st", "vo", "va", "vs", "t", "nm", "iv"]
    cmap = {"user_attributes": {n: n for n in names}, "app_event_attributes": {n: n for n in names}}
    doc = json.loads(build_payload(df, cmap, {"plan_id": "p", "event_name": "e"}, "dev", 1, "k").first().data)
    user, event = doc["user_attributes"], doc["events"][0]["data"]
    assert {n: user[n] for n in names[:-1]} == {
        "a": [1, 2], "m": {"x": 1}, "im": {"1": [{"2": "y"}]}, "st": {"s": {"3": None}}, "vo": {"v": [1]}, "va": [1, "b"],
        "vs": 7, "t": '{"t": 1}', "nm": None}
    assert "1" in user["iv"]
    # event attributes: maps nest, an array is its JSON text
    assert event["m"] == {"x": 1} and event["im"] == {"1": [{"2": "y"}]} and event["vo"] == {"v": [1]} and event["vs"] == 7
    assert json.loads(event["a"]) == [1, 2] and json.loads(event["va"]) == [1, "b"] and event["t"] == '{"t": 1}'
