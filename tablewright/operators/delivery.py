"""Delivery to an external endpoint (K3, K4, D1–D4) and dead letters (K5).

The send loop of a client library becomes data: ``deliver`` runs a pluggable
*sender* inside ``mapInPandas`` on the executors (requests by due time, retries
within the task, see ``pacing``) and returns one row per attempt. Outcome, schedule,
counts and dead letters are then ordinary DataFrame operators over that
attempt table.

Sender protocol: ``sender(requests: pandas.DataFrame, attempt: int) ->
pandas.DataFrame`` with columns ``status`` (int), ``reason`` (str) and
``retry_after`` (int seconds, 0 if none), one row per request row in order.
``requests`` has ``request_id``, ``key`` (text) and ``data`` (JSON text).
Request ids are deterministic, so a task that is retried after an executor
loss resends the same ids; stage the attempt table once (``stage``) before
more than one action reads it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType

from tablewright.functions.scalars import backoff_wait, date_text, ts_text
from tablewright.operators.pacing import RealClock, VirtualClock, send_when_due
from tablewright.schemas import ATTEMPT_DDL
from tablewright.sources.snapshot_state import row_hashes

# Status codes and reasons of the delivery protocol.
OK_STATUSES = (200, 202)
RATE_LIMITED = 429
BAD_REQUEST = 400
TRANSPORT_ERROR = 999
FINAL_REASONS = ("Attribute error", "Max Retry Error")
DEFAULT_MAX_RETRIES = 5
DEFAULT_BASE_WAIT = 2.0
DEFAULT_MAX_WAIT = 60.0
DEFAULT_ENVELOPE_SIZE = 100

GROUP = 10_000              # requests in one call of the sender, if nothing else is said
QUEUE = 10_000              # requests that may wait in one task
FEW = 200_000               # rows that may be broadcast
ROWS_PER_RANGE = 1_000_000  # records that one task numbers


def classify(status, reason) -> Column:
    """``ok`` | ``retry`` | ``final`` | ``abort``.

    200/202 ok; a malformed record or the client's own retry limit (400 with
    those reasons) is final; 429, 400, 5xx and transport errors (999) are
    retried; anything else aborts the run."""
    s = F.col(status) if isinstance(status, str) else status
    r = F.col(reason) if isinstance(reason, str) else reason
    return (F.when(s.isin(*OK_STATUSES), "ok")
             .when((s == BAD_REQUEST) & r.isin(*FINAL_REASONS), "final")
             .when((s == RATE_LIMITED) | (s == BAD_REQUEST) | (F.floor(s / 100) == 5)
                   | (s == TRANSPORT_ERROR), "retry")
             .otherwise("abort"))


def _classify_np(status: np.ndarray, reason: np.ndarray) -> np.ndarray:
    ok = np.isin(status, OK_STATUSES)
    final = (status == BAD_REQUEST) & np.isin(reason, FINAL_REASONS)
    retry = ((status == RATE_LIMITED) | (status == BAD_REQUEST)
             | (status // 100 == 5) | (status == TRANSPORT_ERROR))
    return np.select([ok, final, retry], ["ok", "final", "retry"], "abort")


def deliver(requests: DataFrame, sender, max_retries: int = DEFAULT_MAX_RETRIES,
            base_wait: float = DEFAULT_BASE_WAIT, max_wait: float = DEFAULT_MAX_WAIT,
            sleep: bool = False, partitions: int | None = None,
            key: str = "key", carry: tuple = (), group_size: int | None = None,
            group_pause: float = 0.0, queue_size: int = QUEUE, in_flight: int = 1, clock=None) -> DataFrame:
    """K3: send every request; one row per attempt (``schemas.ATTEMPT``).

    Parallelism is the number of partitions of ``requests``; ``partitions``
    spreads them round-robin first. Inside a task a request that is retried waits
    for its due time while others go on (D2); at most ``queue_size`` wait, and
    ``in_flight`` calls of the sender run at once, each with at most
    ``group_size`` requests. ``group_size`` requests per ``group_pause`` seconds
    is the rate limit of a task. Without ``sleep`` time is virtual: the schedule
    is the same, but nothing waits.

    Only the attempt that ends a request in failure carries the payload, for
    the dead-letter table. Columns named in ``carry`` pass through to every
    attempt row. After an unexpected status (class ``abort``) a task sends
    nothing more; see ``aborted``."""
    columns = ["request_id", "key", "data", *carry]
    src = requests.select("request_id", F.col(key).cast("string").alias("key"), "data", *carry)
    if partitions:
        src = src.repartition(partitions)
    ddl = ATTEMPT_DDL + "".join(
        f", `{c}` {requests.schema[c].dataType.simpleString()}" for c in carry)

    def wait(attempt: int, status: int, retry_after: int) -> float:
        return float(retry_after) if status == RATE_LIMITED and retry_after > 0 else min(base_wait * 2.0 ** attempt, max_wait)

    def run(frames):
        own = clock or (RealClock() if sleep else VirtualClock())
        yield from send_when_due(
            frames, sender, columns, classify=_classify_np, wait=wait, max_retries=max_retries, clock=own,
            limit=group_size or GROUP, queue_size=queue_size, in_flight=in_flight,
            rate=(group_size, group_pause) if group_size and group_pause else None, carry=carry)

    return src.mapInPandas(run, ddl)


def numbered_repeats(records: DataFrame, rid: str, repeated: DataFrame) -> DataFrame:
    """``records`` (written once) with ``rid``, a hash of the whole record, made
    unique: of k equal records the first keeps it, the others get ``|2`` to
    ``|k`` after it. ``repeated`` holds (``rid``, ``_copies``) of the hashes that
    occur more than once, also written.

    Equal records are the same in every column, so copies are counted (combined
    before the shuffle) and made again from one of them; no window sorts them,
    however many are equal."""
    n = repeated.count()
    if not n:
        return records
    small = F.broadcast(repeated) if n <= FEW else repeated
    single = records.join(small, rid, "left_anti")
    one = records.join(small, rid).dropDuplicates([rid])
    many = one.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    number = F.when(F.col("_copy") == 1, F.col(rid)).otherwise(F.concat_ws("|", rid, F.col("_copy").cast("string")))
    return single.unionByName(many.withColumn(rid, number).select(*records.columns))


def repeated_records(records: DataFrame, rid: str) -> DataFrame:
    return records.groupBy(rid).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")


def aborted(attempts: DataFrame) -> int | None:
    """The smallest unexpected status of (written) attempts, if there is one."""
    return attempts.where(classify("status", "reason") == "abort").agg(F.min("status")).first()[0]


def retry_schedule(attempts: DataFrame, base_wait: float = DEFAULT_BASE_WAIT,
                   max_wait: float = DEFAULT_MAX_WAIT) -> DataFrame:
    """Wait after every attempt that is retried: the endpoint's
    Retry-After for 429 when positive, else ``least(base * 2^n, cap)``."""
    wait = (F.when((F.col("status") == RATE_LIMITED) & (F.col("retry_after") > 0),
                   F.col("retry_after").cast("double"))
             .otherwise(backoff_wait("attempt", base_wait, max_wait)))
    return attempts.where(~F.col("final")).withColumn("wait_s", wait)


def outcome(attempts: DataFrame) -> DataFrame:
    """D3: the last attempt of each request decides."""
    last = F.max_by(F.struct("status", "reason", "data"), "attempt")
    return (attempts.groupBy("request_id")
                    .agg(last.alias("_l"), F.max("attempt").alias("n_attempts"))
                    .select("request_id", "n_attempts",
                            F.col("_l.status").alias("status_code"),
                            F.col("_l.reason").alias("reason"),
                            F.col("_l.status").isin(*OK_STATUSES).alias("ok"),
                            F.col("_l.data").alias("data")))


def final_outcome(attempts: DataFrame) -> DataFrame:
    """D3 without a shuffle: ``deliver`` marks the attempt that ended each
    request, so the outcome is a filter over the attempt rows."""
    extra = [c for c in attempts.columns if c not in
             ("request_id", "attempt", "status", "reason", "retry_after", "final", "data")]
    return attempts.where(F.col("final")).select(
        "request_id", F.col("attempt").alias("n_attempts"), F.col("status").alias("status_code"),
        "reason", F.col("status").isin(*OK_STATUSES).alias("ok"), "data", *extra)


def dead_letters(result: DataFrame, run_id: int) -> DataFrame:
    """K5: one dead-letter row per failed request (never one per batch)."""
    now = F.current_timestamp()
    return (result.where(~F.col("ok"))
                  .select(date_text(now).alias("request_date"), ts_text(now).alias("request_ts"),
                          F.lit(run_id).cast("long").alias("run_id"),
                          F.col("status_code").cast("int").alias("status_code"),
                          F.col("reason").alias("failed_reason"),
                          F.col("request_id").alias("source_request_id"), "data"))


def _key_text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("\x00null"))


def envelopes(df: DataFrame, key: str, size: int = DEFAULT_ENVELOPE_SIZE,
              per_range: int = ROWS_PER_RANGE, unique: bool | None = None) -> DataFrame:
    """K4: assign every row to a bulk envelope of at most ``size`` records, as
    (``bucket``, ``envelope``).

    Keys are dealt to ranges of their hash, as many as the number of rows asks for
    (a power of two, about ``per_range`` rows each), and numbered inside a range
    in the order of (hash, key). Only keys with their counts are sorted, never
    documents: a key gets the sum of the counts before it, and rows are joined to
    the numbers afterwards. Rows with the same key are numbered within it, in
    groups of a hash of the row. A new record moves later envelopes of its range
    only (until the number of rows doubles). ``unique`` says that no key repeats;
    it is found out if it is not given."""
    total = df.select(key).count()
    ranges = 1 << max(0, -(-total // per_range) - 1).bit_length()
    # md5 of the key's text, so that other engines find the same range
    text = F.col("_key")
    h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    keys = (df.groupBy(_key_text(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.first(key).alias("_k"))
              .withColumn("_h", h).withColumn("bucket", F.shiftright(F.col("_h") * ranges, 32).cast("int")))
    w = Window.partitionBy("bucket").orderBy("_h", "_k").rowsBetween(Window.unboundedPreceding, 0)
    numbers = keys.select("_key", "_n", "bucket", (F.sum("_n").over(w) - F.col("_n")).alias("_start"))
    rows = df.withColumn("_key", _key_text(key)).join(numbers.hint("shuffle_hash"), "_key")
    envelope = lambda at: F.floor(at / size).cast("int").alias("envelope")
    if unique or (unique is None and df.select(key).distinct().count() == total):
        return rows.select(*df.columns, "bucket", envelope(F.col("_start")))
    # repeated keys: number within (key, salt), after the salts before it
    plain = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(64)))
    per = salted.groupBy("_key", "_salt").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy("_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, 0)
    per = per.select("_key", "_salt", (F.sum("_m").over(before) - F.col("_m")).alias("_before"))
    own = Window.partitionBy("_key", "_salt").orderBy(F.xxhash64(*plain))
    numbered = salted.withColumn("_i", F.row_number().over(own) - 1).join(per, ["_key", "_salt"])
    return numbered.select(*df.columns, "bucket", envelope(F.col("_start") + F.col("_before") + F.col("_i")))


def bulk_requests(docs: DataFrame, key: str, run_id: int, size: int = DEFAULT_ENVELOPE_SIZE,
                  per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """K4 for sending: one request per envelope of at most ``size`` documents
    (a bounded group); ``key`` is unique, as request ids are. ``data`` is the JSON array of the documents; ``members``
    lists the record request ids in the same order. Request id of an
    envelope = ``sha256(run_id|bucket|envelope)``; key = ``bucket-envelope``."""
    env = envelopes(docs.select(*dict.fromkeys((key, "request_id", "data"))), key, size, per_range, unique=True)
    recs = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), "request_id", "data")))
    return (env.groupBy("bucket", "envelope").agg(recs.alias("recs"))
               .select(F.sha2(F.concat_ws("|", F.lit(run_id).cast("string"), "bucket", "envelope"), 256)
                        .alias("request_id"),
                       F.concat_ws("-", "bucket", "envelope").alias("key"),
                       F.concat(F.lit("["), F.array_join(F.transform("recs", lambda r: r["data"]), ","),
                                F.lit("]")).alias("data"),
                       F.transform("recs", lambda r: r["request_id"]).alias("members")))


def per_record(envelope_result: DataFrame) -> DataFrame:
    """The outcome of each record of a bulk send: an envelope's outcome applies
    to all its members; a failed envelope hands each member its own document
    (one dead letter per record, never one per envelope)."""
    docs = F.coalesce(F.from_json("data", "array<string>"),
                      F.array_repeat(F.lit(None).cast("string"), F.size("members")))
    return (envelope_result
            .select(F.col("request_id").alias("envelope_request_id"), "n_attempts", "status_code",
                    "reason", "ok", F.explode(F.arrays_zip(F.col("members").alias("rid"),
                                                           docs.alias("doc"))).alias("m"))
            .select(F.col("m.rid").alias("request_id"), "envelope_request_id", "n_attempts",
                    "status_code", "reason", "ok", F.col("m.doc").alias("data")))


def canary_split(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The first record by key is sent alone before the fan-out; the rest
    is everything else, other records with the same key (or no key) and copies
    equal to it included: one copy of the record goes, not its key. Records are
    told apart by two hashes of all columns, so any column type will do. The
    first record is a per-partition top-1 and a merge; rows equal to it are
    counted and made again from it, so nothing is shuffled."""
    h1, h2 = row_hashes(df)
    hashed = df.withColumn("_c1", h1).withColumn("_c2", h2)
    first = hashed.orderBy(key, "_c1", "_c2").limit(1)
    at = F.broadcast(first.select("_c1", "_c2"))
    equal = hashed.join(at, ["_c1", "_c2"], "left_semi").agg(F.count(F.lit(1)).alias("_n"))
    more = first.join(F.broadcast(equal)).where("_n > 1") \
        .withColumn("_i", F.explode(F.sequence(F.lit(2).cast("long"), F.greatest("_n", F.lit(2)))))
    rest = hashed.join(at, ["_c1", "_c2"], "left_anti").unionByName(more.select(*hashed.columns))
    return first.select(*df.columns), rest.select(*df.columns)
