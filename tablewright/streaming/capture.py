"""Consume-once change capture with Structured Streaming.

A process's source is read as a stream with ``trigger(availableNow=True)``:
every run takes exactly the rows that arrived since the last successful run
and then stops. Each micro-batch is *staged* to a location keyed by its batch
id (overwrite), so a batch replayed after a failure rewrites the same place —
idempotent. The stream's offset moves when ``foreachBatch`` returns (T1).

The state of the staged batches is an append-only *batch log* next to them
(``eventlog``), rows of (first id, last id, state): ``staged``, ``committed``,
and ``snapshot``, ``merged`` or ``base`` for the state of a change feed.
Committed batches are folded into ranges, so the log stays small however many
runs there were. Downstream steps read the staged batches; after they succeed,
the batches are logged as committed and their data dropped (K8). A staged batch
outside all committed ranges is an unfinished run (T2); a restart processes
exactly those batches without reading the stream again (T3); a replayed batch
that is already committed is left alone. A process's stream checkpoint is
versioned in a log too: replacing the stream opens a new version, otherwise the
current one (and its position) is kept (T5). A replacement is known by its
transaction, so one that is asked for again is not another one.
"""

from __future__ import annotations

import os
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tablewright.session import work_path
from tablewright.sources.snapshot_state import DIGEST, MERGE_AFTER, SnapshotState
from tablewright.streaming.eventlog import EventLog

# Batch ids of stream version N start at (N - 1) times this: a replaced stream
# counts its batches from 0 again and must not meet the old one's.
VERSION_STEP = 1_000_000_000
LOG_SCHEMA = "batch_id long, until long, state string, at timestamp"
VERSION_SCHEMA = "process string, version int, tx string, at timestamp"
STATES = ("snapshot", "merged", "base")


def _islands(done: DataFrame) -> DataFrame:
    """Ranges of ids as few ranges: neighbours and overlaps become one. (Few
    rows: the log's.)"""
    order = Window.orderBy("batch_id", "until")
    before = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = (before.isNull() | (F.col("batch_id") > before + 1)).cast("int")
    return done.select("batch_id", "until").distinct().withColumn("new", new) \
        .withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy("island").agg(F.min("batch_id").alias("batch_id"), F.max("until").alias("until")).drop("island")


def _open(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Staged rows outside all committed ranges."""
    r = ranges.select(F.col("batch_id").alias("lo"), F.col("until").alias("hi"))
    return rows.where("state = 'staged'").join(r, F.col("batch_id").between(F.col("lo"), F.col("hi")), "left_anti")


def _fold(rows: DataFrame) -> DataFrame:
    """Committed ranges, open batches, and the states that still count."""
    ranges = _islands(rows.where("state = 'committed'"))
    cols = ["batch_id", "until", "state", "at"]
    base = rows.where("state = 'base'").agg(F.max("batch_id")).first()[0]
    kept = rows.where(F.col("state").isin(*STATES) & (F.col("batch_id") >= F.lit(-1 if base is None else base)))
    return ranges.withColumn("state", F.lit("committed")).withColumn("at", F.current_timestamp()).select(*cols) \
        .unionByName(_open(rows, ranges).select(*cols)).unionByName(kept.select(*cols))


def batch_log(spark: SparkSession, stage_root: str) -> EventLog:
    return EventLog(spark, f"{stage_root}/_batch_log", LOG_SCHEMA, _fold)


def _log(spark: SparkSession, stage_root: str, batch_ids: list[int], *states: str) -> None:
    """All given states of the batches at once: one file, so all or none."""
    now = datetime.now()
    batch_log(spark, stage_root).append([(int(b), int(b), s, now) for b in batch_ids for s in states])


def _drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def committed_ranges(spark: SparkSession, stage_root: str) -> list[tuple[int, int]]:
    """Committed batches as ranges: one, as a rule, for each stream version."""
    rows = batch_log(spark, stage_root).rows().where("state = 'committed'")
    return sorted((int(r.batch_id), int(r.until)) for r in _islands(rows).collect())


def _within(ranges: list[tuple[int, int]], batch_id: int) -> bool:
    return any(lo <= batch_id <= hi for lo, hi in ranges)


def committed_batches(spark: SparkSession, stage_root: str) -> list[int]:
    """Every committed batch id, for inspection; no run asks for it."""
    return [b for lo, hi in committed_ranges(spark, stage_root) for b in range(lo, hi + 1)]


def uncommitted_batches(spark: SparkSession, stage_root: str) -> list[int]:
    """Staged but not committed (a run failed after staging)."""
    rows = batch_log(spark, stage_root).rows()
    left = _open(rows, _islands(rows.where("state = 'committed'")))
    return sorted(int(r[0]) for r in left.select("batch_id").distinct().collect())


def mark_committed(spark: SparkSession, stage_root: str, batch_ids: list[int]) -> None:
    _log(spark, stage_root, batch_ids, "committed")


def purge_committed(spark: SparkSession, stage_root: str, batch_ids: list[int]) -> None:
    """K8: drop the staged data of committed batches; the log keeps their
    range, so a replayed batch id is still recognised as done."""
    done = committed_ranges(spark, stage_root)
    for b in batch_ids:
        if _within(done, b):
            _drop_folder(spark, f"{stage_root}/batch_id={b}")


def read_staged(spark: SparkSession, stage_root: str, schema: StructType,
                batch_ids: list[int] | None = None) -> DataFrame:
    """The staged delta (all open batches or the given ones) as one DataFrame;
    the batch folders are named explicitly, so only they are listed."""
    ids = uncommitted_batches(spark, stage_root) if batch_ids is None else batch_ids
    if not ids:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", stage_root).parquet(
        *[f"{stage_root}/batch_id={b}" for b in ids])
    return df.select(*schema.fieldNames())


def stream_versions(spark: SparkSession, process: str, root: str) -> EventLog:
    """The versions of one process's stream."""
    return EventLog(spark, f"{root}/{process.lower()}/_versions", VERSION_SCHEMA)


def _current_version(spark: SparkSession, process: str, root: str) -> int:
    v = stream_versions(spark, process, root).rows().agg(F.max("version")).first()[0]
    return int(v) if v is not None else 1


def checkpoint_location(spark: SparkSession, process: str, root: str | None = None) -> str:
    """T5: the current stream checkpoint of a process,
    ``<root>/<process>/v<N>`` (v1 until the stream is replaced)."""
    root = root or work_path(spark, "checkpoints")
    return f"{root}/{process.lower()}/v{_current_version(spark, process, root)}"


def _first_id(checkpoint: str) -> int:
    version = checkpoint.rstrip("/").rsplit("/v", 1)[-1]
    return (int(version) - 1) * VERSION_STEP if version.isdigit() else 0


def replace_checkpoint(spark: SparkSession, process: str, root: str | None = None, tx: str | None = None) -> str:
    """T5: replace the process's stream — the next run starts a new
    checkpoint version (with a time-travel property, at that point). The same
    transaction ``tx`` always gives the same version; without one every call is
    its own transaction."""
    root = root or work_path(spark, "checkpoints")
    tx = tx or uuid.uuid4().hex
    log = stream_versions(spark, process, root)
    known = log.rows().where(F.col("tx") == tx).agg(F.min("version")).first()[0]
    version = known or _current_version(spark, process, root) + 1
    if known is None:
        log.append([(process.lower(), version, tx, datetime.now())])
    return f"{root}/{process.lower()}/v{version}"


def capture_changes(spark: SparkSession, source: str, schema: StructType,
                    stage_root: str, checkpoint: str, since=None,
                    ts_col: str | None = None, block_unfinished: bool = True,
                    max_files_per_trigger: int | None = None) -> list[int]:
    """Stage everything new in ``source`` (a parquet location or glob)
    and return the batch ids staged by this run ([] when nothing arrived —
    later steps are then skipped, F7). ``since`` (S7b) starts the stream at a
    point in the past: rows before it are filtered out at the scan.

    With ``block_unfinished`` a previous run's uncommitted batch stops this
    run (T2) instead of piling a second delta on top of it."""
    if block_unfinished and uncommitted_batches(spark, stage_root):
        raise RuntimeError("a previous run's staged data is not processed yet; restart that run first")
    if since is not None and not ts_col:
        raise ValueError("a start point in the past needs the source's time column")
    first = _first_id(checkpoint)
    done = committed_ranges(spark, stage_root)
    # Files are taken by what the checkpoint has seen, never by their age.
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if any(ch in source for ch in "*?["):
        reader = reader.option("basePath", os.path.dirname(source.rstrip("/")))
    stream = reader.parquet(source)
    if since is not None:
        stream = stream.where(F.col(ts_col) >= F.lit(since))
    staged: list[int] = []

    def stage(batch: DataFrame, batch_id: int) -> None:
        # A batch replayed after it was processed and committed (the query
        # stopped before its offset was recorded) is left as it is.
        batch_id += first
        if _within(done, batch_id):
            return
        batch.write.mode("overwrite").parquet(f"{stage_root}/batch_id={batch_id}")
        _log(batch.sparkSession, stage_root, [batch_id], "staged")
        staged.append(batch_id)

    q = (stream.writeStream.foreachBatch(stage)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(staged)


def capture_snapshot_changes(spark: SparkSession, source: str, keys: list[str], stage_root: str,
                             snapshot_root: str, block_unfinished: bool = True) -> list[int]:
    """S7 for a stream that is not append-only: the full change feed of the
    table since the previous run (inserts, deletes, and updates as DELETE +
    INSERT images, ``action`` / ``is_update``), staged like any captured batch.

    What the previous run saw is kept as a state of row hashes and images
    (``sources.snapshot_state``); only changes are added to it. The table's files
    are listed once; should one of them vanish before all is read, the run fails
    and changes nothing. Returns ``[batch id]``, or ``[]`` when nothing changed."""
    if block_unfinished and uncommitted_batches(spark, stage_root):
        raise RuntimeError("a previous run's staged data is not processed yet; restart that run first")
    rows = batch_log(spark, stage_root).rows()
    last = rows.agg(F.max("until")).first()[0]
    batch = int(last) + 1 if last is not None else 0
    live, newest = _live(rows)
    state = SnapshotState(spark, snapshot_root, spark.read.parquet(source), keys, live,
                          f"digests/version={newest}" if newest is not None else None)
    digests = f"{snapshot_root}/digests/version={batch}"
    state.digest().write.mode("overwrite").parquet(digests)
    buckets = state.changed_buckets(spark.read.schema(DIGEST).parquet(digests))
    if not buckets and newest is not None:
        return []
    work = f"{snapshot_root}/work/version={batch}"
    state.changes(buckets).write.mode("overwrite").parquet(f"{work}/changes")
    state.images(spark.read.parquet(f"{work}/changes"), buckets).write.mode("overwrite").parquet(f"{work}/images")
    images = spark.read.parquet(f"{work}/images")
    state.write(images, f"version={batch}")
    folder = f"{stage_root}/batch_id={batch}"
    state.feed(images).write.mode("overwrite").parquet(folder)
    # One log write, and the last one: after a crash before it, the next call
    # compares with the old state again and loses nothing.
    changed = not spark.read.parquet(folder).isEmpty()
    _log(spark, stage_root, [batch], "snapshot", "staged", *([] if changed else ["committed"]))
    _drop_folder(spark, work)
    if newest is not None:
        _drop_folder(spark, f"{snapshot_root}/digests/version={newest}")
    _merge(spark, state, stage_root, [*live, f"version={batch}"], batch)
    return [batch] if changed else []


def _live(rows: DataFrame) -> tuple[list[str], int | None]:
    """The folders of the state that count, and the newest version."""
    found = [(int(r.batch_id), r.state) for r in rows.where(F.col("state").isin(*STATES)).collect()]
    newest = max((b for b, _ in found), default=None)
    base = max((b for b, s in found if s == "base"), default=-1)
    merged = max((b for b, s in found if s == "merged" and b > base), default=base)
    folders = ([f"base={base}"] if base >= 0 else []) + ([f"merged={merged}"] if merged > base else [])
    return folders + [f"version={b}" for b, s in sorted(found) if s == "snapshot" and b > merged], newest


def _merge(spark: SparkSession, state: SnapshotState, stage_root: str, live: list[str], batch: int) -> None:
    """Fold the state's versions when there are many: the deltas into one, or
    all of it once the deltas are as large as the base. Old folders are dropped
    after the log names the new one."""
    if len(live) < MERGE_AFTER:
        return
    base, deltas = live[:1], live[1:]     # at first, the first version is the base
    size = lambda folders: state.rows(folders).count()
    whole = size(deltas) >= size(base) or live[0].startswith("version=")
    kind, folders = ("base", live) if whole else ("merged", deltas)
    state.fold(folders, f"{kind}={batch}")
    _log(spark, stage_root, [batch], kind)
    for f in folders:
        _drop_folder(spark, f"{state.root}/{f}")
