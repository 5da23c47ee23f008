"""Due times, rate limit and requests in flight, with a clock that only moves on."""

import json
import pickle
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import delivery, pacing
from tablewright.operators.senders import KeptConnection, json_post_sender

COLUMNS = ["request_id", "key", "data"]


def _frames(n, size=7):
    rows = [(f"r{i}", str(i), f"d{i}") for i in range(n)]
    return [pd.DataFrame(rows[i:i + size], columns=COLUMNS) for i in range(0, n, size)]


def _wait(attempt, status, after):
    return float(after) if status == 429 and after > 0 else min(2.0 * 2.0 ** attempt, 60.0)


def _run(n, answer, **kw):
    """Send n requests; returns (attempt rows, log of (time, attempt, keys), the queue's sizes)."""
    clock, calls, sizes = pacing.VirtualClock(), [], []

    def sender(req, attempt):
        calls.append((clock.now, attempt, [int(k) for k in req["key"]]))
        got = [answer(int(k), attempt) for k in req["key"]]
        return pd.DataFrame(got, columns=["status", "reason", "retry_after"])

    class Watched(pacing.DueQueue):
        def push(self, *a):
            super().push(*a)
            sizes.append(self.size)
    args = dict(classify=delivery._classify_np, wait=_wait, max_retries=3, clock=clock, limit=10, queue_size=20) | kw
    old, pacing.DueQueue = pacing.DueQueue, Watched
    try:
        out = list(pacing.send_when_due(iter(_frames(n)), sender, COLUMNS, **args))
    finally:
        pacing.DueQueue = old
    return (pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=["request_id"])), calls, sizes


def test_a_retry_after_delays_no_other_request():
    slow = {3, 40}
    answer = lambda k, attempt: (429, "slow", 30) if k in slow and attempt == 1 else (202, "ok", 0)
    out, calls, _ = _run(100, answer)
    first = {k: at for at, attempt, keys in calls for k in keys if attempt == 1}
    assert len(first) == 100 and max(first.values()) == 0               # all others went at once
    again = {k: at for at, attempt, keys in calls for k in keys if attempt == 2}
    assert set(again) == slow and all(30 <= at < 31 for at in again.values())
    assert (out[out["final"]]["status"] == 202).all() and out["final"].sum() == 100


def test_each_waits_for_its_own_due_time():
    answer = lambda k, attempt: (429, "x", 1 + k) if attempt == 1 else (202, "ok", 0)
    _, calls, _ = _run(15, answer)
    again = {k: at for at, attempt, keys in calls for k in keys if attempt == 2}
    assert all(1 + k <= at < 2 + k for k, at in again.items()) and len(again) == 15


def test_memory_is_bounded_by_the_queue():
    answer = lambda k, attempt: (500, "x", 0) if attempt <= 2 else (202, "ok", 0)
    out, calls, sizes = _run(400, answer)
    assert max(sizes) <= 20 and out["final"].sum() == 400
    assert sorted(out[out["final"]]["request_id"]) == sorted(f"r{i}" for i in range(400))
    assert out["attempt"].max() == 3 and max(len(k) for _, _, k in calls) <= 10


@pytest.mark.parametrize("in_flight", [1, 3])
def test_rate_limit(in_flight):
    out, calls, _ = _run(100, lambda k, a: (202, "ok", 0), rate=(10, 3.0), in_flight=in_flight)
    assert len(out) == 100
    times = np.array([at for at, _, keys in calls for _ in keys])
    # the bucket holds 10: never more than 10 + 10/3 a second in any stretch of time
    for at in times:
        for span in (0.5, 3.0, 9.0):
            assert ((times >= at) & (times < at + span)).sum() <= 10 + span * 10 / 3 + 1
    assert 26 <= times.max() <= 28


def test_in_flight_calls_run_at_once_and_no_more():
    now, most, lock, both = [0], [0], threading.Lock(), threading.Barrier(3, timeout=20)

    def sender(req, attempt):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        both.wait()
        with lock:
            now[0] -= 1
        return pd.DataFrame({"status": [202] * len(req), "reason": ["ok"] * len(req), "retry_after": [0] * len(req)})
    out = list(pacing.send_when_due(iter(_frames(60, 60)), sender, COLUMNS, classify=delivery._classify_np, wait=_wait,
                                    max_retries=1, clock=pacing.VirtualClock(), limit=10, queue_size=100, in_flight=3))
    assert sum(map(len, out)) == 60 and most[0] == 3


def test_abort_sends_nothing_more():
    out, calls, _ = _run(50, lambda k, a: (403, "no", 0) if k == 12 else (202, "ok", 0), limit=5)
    assert sum(len(k) for _, _, k in calls) == len(out) < 20 and 403 in set(out["status"])


def test_no_requests():
    assert len(_run(0, lambda k, a: (202, "ok", 0))[0]) == 0


def test_two_classifications_are_one(spark):
    rows = [(s, r) for s in [*range(100, 600), 999] for r in ("x", *delivery.FINAL_REASONS)]
    pdf = pd.DataFrame(rows, columns=["s", "r"])
    got = spark.createDataFrame(pdf).select("s", "r", delivery.classify("s", "r").alias("c")).toPandas()
    got = got.sort_values(["s", "r"], ignore_index=True)
    assert got["c"].tolist() == delivery._classify_np(got["s"].to_numpy(), got["r"].to_numpy()).tolist()


def test_deliver_spreads_due_times_over_tasks(spark):
    def sender(req, attempt):
        k = req["key"].astype(int)
        return pd.DataFrame({"status": np.where((k % 10 == 0) & (attempt < 3), 429, 202), "reason": ["r"] * len(req),
                             "retry_after": np.where(k % 10 == 0, 5, 0)})
    reqs = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("request_id"),
                                             F.col("id").alias("key"), F.lit("{}").alias("data"))
    out = delivery.deliver(reqs, sender, group_size=50, group_pause=3.0, in_flight=2, queue_size=60).toPandas()
    assert len(out) == 1200 and out["final"].sum() == 1000 and set(out[out["final"]]["status"]) == {202}


class _Response:
    status, reason, headers = 202, "Accepted", {}

    def read(self):
        return b""

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


class _Connection:
    opened = []

    def __init__(self, breaks_after=None):
        self.sent, self.closed, self.breaks_after = [], False, breaks_after
        _Connection.opened.append(self)

    def request(self, method, target, body, headers):
        if self.breaks_after is not None and len(self.sent) >= self.breaks_after:
            raise ConnectionResetError("closed by the endpoint")
        self.sent.append((method, target, json.loads(body), headers))

    def getresponse(self):
        return _Response()

    def close(self):
        self.closed = True


def _post(n, **kw):
    _Connection.opened = []
    send = json_post_sender("http://endpoint.invalid/bulk?x=1", {"Authorization": "t"},
                            opener=KeptConnection(lambda scheme, host, timeout: _Connection(**kw)))
    req = pd.DataFrame([(f"r{i}", str(i), json.dumps({"n": i})) for i in range(n)], columns=COLUMNS)
    return send(req, 1), _Connection.opened


def test_one_connection_for_all_requests_of_a_task():
    out, opened = _post(20)
    assert out["status"].tolist() == [202] * 20 and len(opened) == 1
    assert [b["n"] for _, _, b, _ in opened[0].sent] == list(range(20))
    assert opened[0].sent[0][:2] == ("POST", "/bulk?x=1")


def test_a_connection_the_endpoint_closed_is_opened_again():
    out, opened = _post(9, breaks_after=4)
    assert out["status"].tolist() == [202] * 9 and [len(c.sent) for c in opened] == [4, 4, 1]
    assert sorted(b["n"] for c in opened for _, _, b, _ in c.sent) == list(range(9))
    out, opened = _post(2, breaks_after=0)                  # a new connection that breaks is an error
    assert out["status"].tolist() == [999, 999] and all(c.closed for c in opened)


def test_connections_do_not_travel():
    kept = KeptConnection()
    kept._own.open = {"x": 1}
    assert not hasattr(pickle.loads(pickle.dumps(kept))._own, "open")
