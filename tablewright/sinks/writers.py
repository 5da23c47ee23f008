"""Sinks: tables (K1), files (K2), dead letters (K5), staging cleanup (K8)
and statement steps (K9). All writes are Spark writers, executed by the
executors in parallel; nothing is gathered on the driver."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Warehouse-session statements with no meaning in Spark; skipped.
SKIPPED_STATEMENTS = re.compile(r"^\s*use\s+(role|warehouse)\b", re.IGNORECASE)


def write_table(df: DataFrame, table: str, mode: str | None = None,
                table_type: str | None = None, path: str | None = None,
                select_exp: list[str] | None = None) -> DataFrame:
    """K1: optional projection, then ``saveAsTable``. Without a mode an
    existing table is an error. ``table_type='temporary'`` registers a
    temporary view instead. ``path`` makes the table external (a shared
    location rather than the warehouse folder)."""
    if select_exp:
        df = df.selectExpr(*select_exp)
    if (table_type or "").lower() in ("temporary", "temp"):
        df.createOrReplaceTempView(table)
        return df
    w = df.write
    if mode:
        w = w.mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df


def write_files(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, options: dict | None = None,
                header: bool | None = None, mode: str = "errorifexists",
                select_exp: list[str] | None = None) -> None:
    """K2: write to a location with partition columns, format and options."""
    if select_exp:
        df = df.selectExpr(*select_exp)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    opts = dict(options or {})
    if header is not None:
        opts["header"] = str(bool(header)).lower()
    if opts:
        w = w.options(**opts)
    w.save(path)


def dead_letter_folder(location: str, run_id: int, target: str) -> str:
    return f"{location}/run_id={run_id}/target={target}"


def append_dead_letters(dead: DataFrame, location: str, run_id: int, target: str) -> None:
    """K5: the failed records of one run and target, in a partition of their
    own: a replay reads only its run, and a run executed twice leaves its rows
    once. The partition is written even when nothing failed; its presence says
    that the send of this run and target was completed."""
    dead.drop("run_id").write.mode("overwrite").parquet(dead_letter_folder(location, run_id, target))


def drop_staging(spark: SparkSession, name: str) -> None:
    """K8: drop the staged delta after success (a table or a temp view)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.dropTempView(name)


def run_statements(spark: SparkSession, query: str | None = None,
                   query_list: list[str] | None = None) -> int:
    """K9: one statement or a list, in order. Warehouse role/compute
    switches are skipped. Neither given is an error. Returns the number run."""
    stmts = [query] if query else list(query_list or [])
    if not stmts:
        raise ValueError("statement step needs `query` or `query_list`")
    n = 0
    for s in stmts:
        if SKIPPED_STATEMENTS.match(s):
            log.info("skipped warehouse statement: %s", s)
            continue
        spark.sql(s)
        n += 1
    return n
