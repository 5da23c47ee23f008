"""Scans (S1), source selection (S3) and dead-letter replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.scalars import request_id
from tablewright.schemas import DEAD_LETTER
from tablewright.sinks.writers import dead_letter_folder
from tablewright.streaming.eventlog import read_if_there


def scan(spark: SparkSession, source: str, columns: list[str] | None = None) -> DataFrame:
    """A table by name or a parquet location by path. Selecting ``columns``
    here lets the scan read only those (``ReadSchema`` in the plan)."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return df.select(*columns) if columns else df


def select_source(spark: SparkSession, obj: dict, delta: DataFrame | None = None) -> tuple[str, DataFrame]:
    """The extract step: a view is read as itself, an incremental table as its
    captured delta, any other table in full. Returns ``(<object>_df, df)``."""
    name = obj["object_name"]
    kind = (obj.get("object_type") or "").lower()
    if kind == "view":
        df = spark.table(name)
    elif kind == "table":
        if obj.get("incremental_capture_flag"):
            if delta is None:
                raise ValueError(f"incremental table {name} has no captured delta")
            df = delta
        else:
            df = spark.table(name)
    else:
        raise ValueError(f"object type {obj.get('object_type')!r} is neither table nor view")
    return f"{name}_df", df


def stored_dead_letters(spark: SparkSession, location: str, run_id: int, target: str) -> DataFrame | None:
    """The dead letters that one run stored for one target (S8): only that
    partition is read. None if the run never completed its send."""
    rows = read_if_there(spark, dead_letter_folder(location, run_id, target), DEAD_LETTER)
    return None if rows is None else rows.withColumn("run_id", F.lit(run_id).cast("long"))


def replay(dead_letters: DataFrame, run_id: int, new_run_id: int,
           status_codes: list[int] | None = None) -> DataFrame:
    """Dead letters of one run (optionally only some status codes) become the
    input of a resend: payload as stored, a new request id."""
    df = dead_letters.where(F.col("run_id") == F.lit(run_id))
    if status_codes:
        df = df.where(F.col("status_code").isin([int(c) for c in status_codes]))
    rid = request_id(F.lit(new_run_id), F.col("source_request_id"))
    # The stored document keeps every field; only its request id changes
    # (ids are hex, so the field is found exactly in the compact JSON text).
    data = F.regexp_replace("data", r'"source_request_id":"[0-9A-Za-z-]*"',
                            F.concat(F.lit('"source_request_id":"'), rid, F.lit('"')))
    return df.select(rid.alias("request_id"),
                     F.col("source_request_id").alias("replayed_request_id"),
                     F.col("status_code").alias("previous_status"),
                     data.alias("data"))
