"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_dollar(c) -> Column:
    """Target names may start with ``$`` (reserved attribute names); aliases
    drop it."""
    return F.regexp_replace(_c(c), r"^\$", "")


def name_part_count(c) -> Column:
    """Number of dot-separated parts of a qualified name (3 = db.schema.obj)."""
    return F.size(F.split(_c(c), r"\."))


def name_last_part(c) -> Column:
    return F.element_at(F.split(_c(c), r"\."), -1)


def epoch_millis(c) -> Column:
    """Event time as epoch milliseconds (truncating). ``timestamp_ntz`` input
    is read in the session time zone, which the library pins to UTC."""
    return F.unix_millis(_c(c).cast("timestamp"))


def date_text(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd")


def ts_text(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def cap_text(c, n: int) -> Column:
    return F.left(_c(c), F.lit(n))


def request_id(run_id, key) -> Column:
    """Deterministic request id: a retried task resends the same id, so the
    receiving end can de-duplicate. ``sha256(run_id || '|' || key)``; a null
    key has a mark of its own."""
    return F.sha2(F.concat_ws("|", _c(run_id).cast("string"),
                              F.coalesce(_c(key).cast("string"), F.lit("\x00null"))), 256)


def backoff_wait(attempt, base: float, cap: float) -> Column:
    """Seconds to wait after failed attempt ``n`` (1-based):
    ``least(base * 2^n, cap)`` — exponential, capped, jitter excluded."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), _c(attempt).cast("double")),
                   F.lit(float(cap)))


def run_id_now(now: datetime | None = None) -> int:
    """Run id = local time as ``yyyyMMddHHmmssSSS`` (17 digits)."""
    now = now or datetime.now()
    return int(now.strftime("%Y%m%d%H%M%S%f")[:-3])
