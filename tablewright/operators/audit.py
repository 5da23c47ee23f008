"""Counts, thresholds and run history.

Run history is append-only: a run appends a STARTED event and later its final
event; the current state of a run is the event with the highest sequence
number (``max_by``), so nothing is ever updated in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

# Run states and the threshold failure text.
STARTED, SUCCEEDED, FAILED = "STARTED", "SUCCEEDED", "FAILED"
THRESHOLD_REASON = "Threshold percentage is not met"


def observe_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """A1: count rows while a write consumes them (no second pass). Read
    ``obs.get['n']`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def threshold_status(total: Column, failed: Column, threshold: Column) -> tuple[Column, Column, Column]:
    """A4: success % = (total − failed) / total × 100; SUCCEEDED iff it is at
    least the threshold; no threshold or no records → SUCCEEDED."""
    pct = (total - failed).cast("double") / total.cast("double") * 100.0
    passed = threshold.isNull() | (total == 0) | (pct >= threshold.cast("double"))
    status = F.when(passed, F.lit(SUCCEEDED)).otherwise(F.lit(FAILED))
    reason = F.when(passed, F.lit(None).cast("string")).otherwise(F.lit(THRESHOLD_REASON))
    return F.when(total > 0, pct), status, reason


def run_counts(result: DataFrame, threshold: int | None, by: list[str] | None = None,
               extra: dict[str, Column] | None = None) -> DataFrame:
    """A3 + A4 over a delivery result (``ok`` per request), per group, in one
    aggregation (``extra`` aggregates ride along; no second pass)."""
    by = by or []
    extra = extra or {}
    agg = (result.groupBy(*by)
                 .agg(F.count(F.lit(1)).alias("total_records_processed"),
                      F.sum(F.when(F.col("ok"), 0).otherwise(1)).cast("long").alias("failed_record_count"),
                      *[c.alias(n) for n, c in extra.items()]))
    total, failed = F.col("total_records_processed"), F.col("failed_record_count")
    pct, status, reason = threshold_status(total, failed, F.lit(threshold).cast("int"))
    return agg.select(*by, *extra, F.lit(threshold).cast("int").alias("threshold_percentage"),
                      total.alias("total_records_processed"),
                      (total - failed).alias("successful_record_count"),
                      failed.alias("failed_record_count"),
                      pct.alias("success_pct"), status.alias("status"),
                      reason.alias("failure_reason"))


def run_events(counts: DataFrame, process: Column, run_id: Column, start: Column,
               end: Column, restart_run_id: Column | None = None) -> DataFrame:
    """K7: the two history events of each run: STARTED (seq 1) and its final
    state with counts (seq 2)."""
    restart = restart_run_id if restart_run_id is not None else F.lit(None).cast("long")
    base = [process.alias("process_name"), run_id.cast("long").alias("run_id"),
            restart.alias("restart_run_id"), start.alias("start_date_time")]
    started = F.struct(F.lit(1).alias("event_seq"), F.lit(None).cast("timestamp").alias("end_date_time"),
                       F.lit(STARTED).alias("status"), F.lit(None).cast("long").alias("successful_record_count"),
                       F.lit(None).cast("long").alias("failed_record_count"),
                       F.lit(None).cast("string").alias("failure_reason"))
    final = F.struct(F.lit(2).alias("event_seq"), end.cast("timestamp").alias("end_date_time"),
                     F.col("status"), F.col("successful_record_count"),
                     F.col("failed_record_count"), F.col("failure_reason"))
    return (counts.select(*base, F.explode(F.array(started, final)).alias("_e"))
                  .select("process_name", "run_id", F.col("_e.event_seq").alias("event_seq"),
                          "restart_run_id", F.col("start_date_time").cast("timestamp").alias("start_date_time"),
                          "_e.end_date_time", "_e.status", "_e.successful_record_count",
                          "_e.failed_record_count", "_e.failure_reason"))


def latest_runs(events: DataFrame) -> DataFrame:
    """Current state of each (process, run): the event with the highest
    sequence. Partial aggregation runs before the shuffle."""
    cols = [c for c in events.columns if c not in ("process_name", "run_id", "event_seq")]
    last = F.max_by(F.struct(*cols), "event_seq")
    return (events.groupBy(F.lower("process_name").alias("process_name"), "run_id")
                  .agg(last.alias("_l"))
                  .select("process_name", "run_id", *[F.col(f"_l.{c}").alias(c) for c in cols]))


def rollup_runs(latest: DataFrame) -> DataFrame:
    """Per process: any run FAILED, and run counts by state."""
    st = F.col("status")
    return (latest.groupBy("process_name")
                  .agg(F.bool_or(st == FAILED).alias("any_failed"),
                       F.count(F.lit(1)).alias("n_runs"),
                       F.count(F.when(st == SUCCEEDED, 1)).alias("n_succeeded"),
                       F.count(F.when(st == FAILED, 1)).alias("n_failed"),
                       F.count(F.when(st == STARTED, 1)).alias("n_running")))
