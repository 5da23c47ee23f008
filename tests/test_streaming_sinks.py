import os

import pytest
from pyspark.sql import functions as F

from tablewright.sinks.writers import drop_staging, run_statements, write_files, write_table
from tablewright.streaming.capture import (
    capture_changes, checkpoint_location, replace_checkpoint, mark_committed, read_staged, uncommitted_batches,
)

SCHEMA = "id long, ts timestamp_ntz, v string"


def _drop(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def test_consume_once_restart_and_empty_run(spark, tmp):
    src, stage, ck = tmp + "/src", tmp + "/stage", tmp + "/ck"
    os.makedirs(src)
    schema = spark.createDataFrame([], SCHEMA).schema
    _drop(spark, src, "f1", [(1, None, "a"), (2, None, "b")])
    src_glob = src + "/*"          # one folder per arriving drop
    b1 = capture_changes(spark, src_glob, schema, stage, ck)
    assert len(b1) == 1 and read_staged(spark, stage, schema, b1).count() == 2
    # unfinished run blocks the next one (T2) ...
    with pytest.raises(RuntimeError, match="previous run"):
        capture_changes(spark, src_glob, schema, stage, ck)
    assert uncommitted_batches(spark, stage) == b1        # restart reads exactly these (T3)
    mark_committed(spark, stage, b1)
    # second file: only the new rows; a run without new input stages nothing
    _drop(spark, src, "f2", [(3, None, "c")])
    b2 = capture_changes(spark, src_glob, schema, stage, ck)
    assert sorted(r.id for r in read_staged(spark, stage, schema, b2).collect()) == [3]
    mark_committed(spark, stage, b2)
    assert capture_changes(spark, src_glob, schema, stage, ck) == []


def test_capture_since(spark, tmp):
    src, stage, ck = tmp + "/src", tmp + "/stage", tmp + "/ck"
    os.makedirs(src)
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (2, "2024-02-01 00:00:00", "b")],
                          "id long, ts string, v string") \
        .select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), "v").write.parquet(src + "/f1")
    b = capture_changes(spark, src + "/*", schema, stage, ck, since=F.lit("2024-01-15").cast("timestamp_ntz"),
                        ts_col="ts")
    assert [r.id for r in read_staged(spark, stage, schema, b).collect()] == [2]


def test_checkpoint_versions(spark):
    name = "proc_versions_test"
    first = checkpoint_location(spark, name)
    assert first.endswith("/v1")
    os.makedirs(first.replace("file:", ""), exist_ok=True)
    assert checkpoint_location(spark, name) == first                 # keep position
    assert replace_checkpoint(spark, name).endswith("/v2")
    assert checkpoint_location(spark, name).endswith("/v2")


def test_table_sink_default_mode_refuses_existing(spark, tmp):
    df = spark.range(3)
    write_table(df, "tw_t1", path=tmp + "/t1")
    with pytest.raises(Exception, match="(?i)already exists"):
        write_table(df, "tw_t1", path=tmp + "/t1b")
    write_table(spark.range(5), "tw_t1", mode="overwrite", path=tmp + "/t1c")
    assert spark.table("tw_t1").count() == 5
    write_table(spark.range(2), "tw_tmp", table_type="temporary")
    assert spark.table("tw_tmp").count() == 2
    drop_staging(spark, "tw_tmp")
    assert not spark.catalog.tableExists("tw_tmp")


def test_file_sink_partitioned_csv(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, p string")
    write_files(df, tmp + "/f", fmt="csv", partition_by=["p"], header=True,
                select_exp=["id", "upper(p) as p"])
    assert sorted(os.listdir(tmp + "/f"))[:2] == ["_SUCCESS", "p=A"] or os.path.isdir(tmp + "/f/p=A")
    back = spark.read.option("header", "true").csv(tmp + "/f")
    assert sorted((r.p, int(r.id)) for r in back.collect()) == [("A", 1), ("A", 3), ("B", 2)]


def test_statements(spark):
    n = run_statements(spark, query_list=["use warehouse wh", "USE ROLE r",
                                          "create or replace temporary view sv as select 1 as x"])
    assert n == 1 and spark.table("sv").first().x == 1
    with pytest.raises(ValueError):
        run_statements(spark)


def test_replayed_committed_batch_is_left_alone(spark, tmp):
    src, stage, ck = tmp + "/src", tmp + "/stage", tmp + "/ck"
    os.makedirs(src)
    schema = spark.createDataFrame([], SCHEMA).schema
    _drop(spark, src, "f1", [(1, None, "a")])
    b = capture_changes(spark, src + "/*", schema, stage, ck)
    mark_committed(spark, stage, b)
    # a stream without the record of the finished batch replays batch 0
    assert capture_changes(spark, src + "/*", schema, stage, tmp + "/ck_fresh") == []
    assert uncommitted_batches(spark, stage) == []
