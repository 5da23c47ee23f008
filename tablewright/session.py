"""Session construction and the shared working folder.

Every job that must cut lineage or stage data writes under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is absent
(unit tests, a laptop) do we create a local one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None


def build_session(master: str | None = None, app: str = "tablewright",
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """A session with the settings the library is designed around: AQE with
    partition coalescing and skew-join splitting, UTC, Arrow, no UI."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or int(cpus) * 2))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for staged data, checkpoints and written tables.

    Read from ``spark.checkpoint.dir``. Only a local-mode session without one
    (tests, a laptop) gets a temporary folder; on a cluster the setting is
    required, never a machine-local folder."""
    global _LOCAL_FALLBACK
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(staged deltas, attempts and run history are written there)")
        if _LOCAL_FALLBACK is None:
            _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="tablewright-")
            try:
                spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK)
            except Exception:
                pass
        root = _LOCAL_FALLBACK
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` appends a fresh id so that
    repeated calls never read or overwrite each other's output."""
    segs = [shared_root(spark), "tablewright", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(s.strip("/") if i else s for i, s in enumerate(segs))
