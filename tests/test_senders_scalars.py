import json
import urllib.error

import pandas as pd
from pyspark.sql import functions as F

from tablewright.functions import scalars
from tablewright.operators import delivery
from tablewright.operators.payload import build_payload
from tablewright.operators.senders import json_post_sender


class _Resp:
    def __init__(self, status, reason, headers=None):
        self.status, self.reason, self.headers = status, reason, headers or {}

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


def test_json_post_sender_maps_responses():
    seen = []

    def opener(req, timeout):
        body = json.loads(req.data)
        seen.append((req.get_method(), req.headers.get("Content-type"), body["n"]))
        if body["n"] == 1:
            return _Resp(202, "Accepted")
        if body["n"] == 2:
            raise urllib.error.HTTPError(req.full_url, 429, "Too Many Requests", {"Retry-After": "7"}, None)
        raise urllib.error.URLError("connection refused")

    send = json_post_sender("http://endpoint.invalid/events", {"Authorization": "x"}, opener=opener)
    out = send(pd.DataFrame({"request_id": ["a", "b", "c"], "key": ["1", "2", "3"],
                             "data": [json.dumps({"n": i}) for i in (1, 2, 3)]}), 1)
    assert out["status"].tolist() == [202, 429, 999]
    assert out["retry_after"].tolist() == [0, 7, 0]
    assert seen[0] == ("POST", "application/json", 1)


def test_rate_limited_groups(spark):
    def sender(req, attempt):
        # report the group size the sender saw through the reason column
        return pd.DataFrame({"status": [202] * len(req), "reason": [str(len(req))] * len(req),
                             "retry_after": [0] * len(req)})
    reqs = spark.range(0, 25).select(F.col("id").cast("string").alias("request_id"),
                                     F.col("id").alias("key"), F.lit("{}").alias("data")).coalesce(1)
    out = delivery.deliver(reqs, sender, group_size=10).collect()
    assert len(out) == 25 and all(r.final and r.status == 202 for r in out)
    assert sorted(int(r.reason) for r in out) == [5] * 5 + [10] * 20


def test_json_text_columns_nest_as_values(spark):
    df = spark.createDataFrame([(1, '{"a": [1, 2]}'), (2, "not json"), (3, None)], "k long, j string")
    docs = build_payload(df, {"user_attributes": {"j": "blob"}}, {"plan_id": "p", "event_name": "e"},
                         "dev", 1, "k", json_columns=("j",))
    got = {r.k: json.loads(r.data)["user_attributes"]["blob"] for r in docs.collect()}
    assert got == {1: {"a": [1, 2]}, 2: None, 3: None}     # bad text becomes null, job continues


def test_scalars(spark):
    df = spark.createDataFrame([("db.sch.tab", "$name", "abcdef")], "q string, t string, s string")
    r = df.select(scalars.name_part_count("q").alias("n"), scalars.name_last_part("q").alias("last"),
                  scalars.strip_dollar("t").alias("t"), scalars.cap_text("s", 3).alias("cap"),
                  scalars.request_id(F.lit(5), F.lit("k")).alias("rid")).first()
    assert (r.n, r.last, r.t, r.cap) == (3, "tab", "name", "abc")
    import hashlib
    assert r.rid == hashlib.sha256(b"5|k").hexdigest()
    rid = scalars.run_id_now()
    assert len(str(rid)) == 17
    ts = spark.createDataFrame([("2024-01-01 00:00:01.2345",)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("ts"))
    assert ts.select(scalars.epoch_millis("ts")).first()[0] == 1704067201234
    assert ts.select(scalars.ts_text("ts")).first()[0] == "2024-01-01 00:00:01.234500"
