from pyspark.sql import functions as F

from tablewright.operators.dedup import keep_one, priority
from tablewright.operators.joins import flag_exists, left_chain, split_exists


def test_keep_one_priority_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "O", 5, 10), (1, "P", 9, 11), (1, "O", 7, 12), (1, "O", 7, 9),
         (2, None, 1, 20), (2, "F", 1, 21), (3, "P", None, 30), (3, "P", 2, 31), (None, "O", 1, 40)],
        "k int, st string, d int, id int")
    out = keep_one(df, ["k"], [priority("st", ["O", "P"]), F.col("d").desc(), F.col("id")])
    got = {r.k: r.id for r in out.collect()}
    # key 1: status O first, then highest d (7), tie on d broken by smallest id
    # key 2: null and F both rank 3; d ties; smallest id; key 3: desc puts nulls last
    assert got == {1: 9, 2: 20, 3: 31, None: 40}


def test_keep_one_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    plan = keep_one(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_keep_one_empty(spark):
    df = spark.createDataFrame([], "k int, v int")
    assert keep_one(df, ["k"], [F.col("v")]).count() == 0


def test_left_chain_keys_differ_and_unmatched(spark):
    a = spark.createDataFrame([(1, "x@e"), (2, "y@e"), (3, None)], "id int, email string")
    b = spark.createDataFrame([(1, "b1")], "bid int, bcol string")
    c = spark.createDataFrame([("x@e", "c1"), (None, "cnull")], "cemail string, ccol string")
    out = left_chain(a, [(b, a.id == b.bid), (c, F.col("email") == F.col("cemail"))])
    rows = {r.id: (r.bcol, r.ccol) for r in out.collect()}
    assert rows == {1: ("b1", "c1"), 2: (None, None), 3: (None, None)}  # null keys never match


def test_exists(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    semi, anti = split_exists(a, b, "k")
    assert sorted(r.k for r in semi.collect()) == [1, 3]
    assert [r.k for r in anti.collect()] == [2]
    flags = {r.k: r.f for r in flag_exists(a, b, ["k"], "f").collect()}
    assert flags == {1: True, 2: False, 3: True}
