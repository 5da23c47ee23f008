"""Shared column expressions and small helpers of the text operators.

Words are ``[^\\x20\\x09-\\x0D]+`` everywhere; lower-casing touches A-Z only,
so that offsets and counts do not depend on a locale.
"""

from __future__ import annotations

import gc
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import work_path

BLANKS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
_BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda's own variable
    is not evaluated again for every use in nested lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """All words of a text, in order; an empty array for null or blank texts."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BLANK_RUN))


def stage(df: DataFrame, *parts: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once under the shared folder and read again: cuts the
    lineage, survives lost executors and is the same for every later reader."""
    spark = df.sparkSession
    path = work_path(spark, "llm", *parts, unique=True)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop(*staged: DataFrame | None) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for df in staged:
        at = getattr(df, "_staged_at", None)
        if at is not None:
            jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(conf).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs. It does so once the driver's
    memory is tidied, which a driver with little to do hardly ever does by itself."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark resolves it on, for
    files that tasks open themselves (``store_of``)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def store_of(path: str):
    """(pyarrow file system, path in it) of a qualified path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


_KEPT: dict = {}


def kept(name, make):
    """``make()``, made once per Python worker and kept for its next tasks, one thing at
    a time: workers outlive a stage, and the next one needs the memory for its own."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def next_pow2(n: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, n))))
