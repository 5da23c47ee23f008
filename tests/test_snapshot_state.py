"""S7 as a stream: the state of row hashes against the plain change feed."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewright.sources import snapshot_state
from tablewright.sources.changes import change_feed
from tablewright.streaming import capture
from tablewright.workloads import _snapshots

SF = "/root/testdata/sf0.001"


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "digests" not in d}


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


class Table:
    """A table whose content is replaced, captured, and committed."""

    def __init__(self, spark, tmp, keys):
        self.spark, self.keys, self.tmp, self.n = spark, keys, tmp, 0

    def capture(self, df):
        self.n += 1
        path = f"{self.tmp}/t{self.n}"
        df.write.parquet(path)
        ids = capture.capture_snapshot_changes(self.spark, path, self.keys, self.tmp + "/stage", self.tmp + "/state")
        capture.mark_committed(self.spark, self.tmp + "/stage", ids)
        return self.spark.read.parquet(f"{self.tmp}/stage/batch_id={ids[0]}") if ids else None


def test_two_captures_of_orders_are_the_change_feed(spark, tmp):
    old, new = _snapshots(spark, SF)
    t = Table(spark, tmp, ["o_orderkey"])
    first = t.capture(old)
    assert _rows(first.drop("action", "is_update")) == _rows(old)
    assert _rows(first.select("action", "is_update").distinct()) == {("INSERT", False): 1}
    want = change_feed(old, new, ["o_orderkey"])
    assert _rows(t.capture(new).select(want.columns)) == _rows(want)


def test_the_unchanged_table_is_not_rewritten(spark, tmp):
    base = spark.range(0, 20000, 1, 4).select("id", (F.col("id") * 3).alias("v"), F.lit("x").alias("s"))
    t = Table(spark, tmp, ["id"])
    t.capture(base)
    before = _files(tmp + "/state")
    feed = t.capture(base.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v"))))
    assert _rows(feed) == {(77, 231, "x", "DELETE", True): 1, (77, -1, "x", "INSERT", True): 1}
    after = _files(tmp + "/state")
    assert before.items() <= after.items()                               # every old file is as it was
    added = [f for f in after if f not in before]
    assert len(added) <= 2 and spark.read.parquet(*added).count() == 2   # the two changed images
    assert t.capture(base.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v")))) is None
    assert _files(tmp + "/state") == after                               # no change: nothing written


def test_only_changed_buckets_and_their_hashes_are_compared(spark, tmp):
    base = spark.range(0, 5000).select("id", F.lit("x" * 50).alias("s"))
    t = Table(spark, tmp, ["id"])
    t.capture(base)
    changed = base.withColumn("s", F.when(F.col("id") == 9, "y").otherwise(F.col("s")))
    changed.write.parquet(tmp + "/now")
    live, newest = capture._live(capture.batch_log(spark, tmp + "/stage").rows())
    state = snapshot_state.SnapshotState(spark, tmp + "/state", spark.read.parquet(tmp + "/now"), ["id"], live,
                                         f"digests/version={newest}")
    buckets = state.changed_buckets(state.digest())
    assert 1 <= len(buckets) <= 2
    plan = state.changes(buckets)._jdf.queryExecution().executedPlan().toString()
    kept = [line for line in plan.splitlines() if "FileScan" in line and "h1:bigint" in line]   # the state's scans
    assert kept and all("PartitionFilters: [bucket#" in x for x in kept)
    assert not any("img:" in x.split("ReadSchema")[1] for x in kept)     # no images for the comparison
    assert state.changes(buckets).count() == 2


def test_repeated_and_null_keys_are_a_multiset(spark, tmp):
    schema = "k int, s string"
    t = Table(spark, tmp, ["k"])
    t.capture(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "n"), (2, None), (3, "z")], schema))
    feed = t.capture(spark.createDataFrame([(1, "a"), (1, "c"), (1, "c"), (None, "n"), (None, "m"), (2, "now"), (4, None)], schema))
    assert _rows(feed) == {(1, "a", "DELETE", True): 1, (1, "b", "DELETE", True): 1, (1, "c", "INSERT", True): 2,
                           (None, "m", "INSERT", False): 1, (2, None, "DELETE", True): 1, (2, "now", "INSERT", True): 1,
                           (3, "z", "DELETE", False): 1, (4, None, "INSERT", False): 1}


def test_nulls_do_not_hide_a_change(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert df.select(*snapshot_state.row_hashes(df)).distinct().count() == 2
    df = spark.sql("select named_struct('a', cast(null as int), 'b', 1) as x, map('k', 1) as m "
                   "union all select named_struct('a', 1, 'b', cast(null as int)), map('k', 1)")
    assert df.select(*snapshot_state.row_hashes(df)).distinct().count() == 2


@pytest.mark.parametrize("merge_after", [2, 4])
def test_many_captures_fold_and_stay_right(spark, tmp, monkeypatch, merge_after):
    monkeypatch.setattr(capture, "MERGE_AFTER", merge_after)
    t = Table(spark, tmp, ["k"])
    shown: Counter = Counter()
    for i in range(9):
        now = [(k, (k * i) % 5) for k in range(40) if (k + i) % 6] + ([] if i != 5 else [(k, 0) for k in range(40, 300)])
        if i == 7:
            now = []
        feed = t.capture(spark.createDataFrame(now, "k int, v int"))
        for r in feed.collect() if feed is not None else []:
            shown[(r.k, r.v)] += 1 if r.action == "INSERT" else -1
        assert +shown == Counter(now) and min(shown.values(), default=0) >= 0
        live, _ = capture._live(capture.batch_log(spark, tmp + "/stage").rows())
        assert len(live) <= merge_after
        there = [d for d in os.listdir(tmp + "/state") if d.split("=")[0] in ("version", "base", "merged")]
        assert sorted(there) == sorted(live)                              # folded versions are dropped


def test_a_column_that_comes_later(spark, tmp):
    t = Table(spark, tmp, ["k"])
    t.capture(spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string"))
    feed = t.capture(spark.createDataFrame([(1, "a", 5), (3, "c", 6)], "k int, s string, n int"))
    assert _rows(feed) == {(1, "a", None, "DELETE", True): 1, (1, "a", 5, "INSERT", True): 1,
                           (2, "b", None, "DELETE", False): 1, (3, "c", 6, "INSERT", False): 1}
