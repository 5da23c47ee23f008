"""Append-only logs of small rows that stay cheap to read.

An append is one small parquet file in ``tail``. When ``every`` files have
gathered, the whole log is written again as the next *checkpoint*, by ``fold``
if the log can be summed up (committed batches become ranges), and the files it
holds are dropped. A reader opens the newest finished checkpoint and the tail
files that it does not hold, so it never opens more than a bounded number of
files, however many events there were.

A checkpoint counts once it is whole (``_SUCCESS`` of its rows, the last file
written). It names the tail files that it holds, so a crash before they are
dropped, or an append while it was written, loses and repeats nothing. One
process compacts a log at a time; the logs are kept per process for that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

EVERY = 40


def child_folders(spark: SparkSession, root: str) -> list[str]:
    log = EventLog(spark, root, "value string")
    return [n for n in log._names(root) if not n.startswith(("_", "."))]


def read_if_there(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # nothing written there yet
            return None
        raise


class EventLog:
    def __init__(self, spark: SparkSession, root: str, schema: str | StructType,
                 fold: Callable[[DataFrame], DataFrame] | None = None, every: int = EVERY):
        self.spark, self.root, self.fold, self.every = spark, root, fold, every
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    # ------------------------------------------------------------- folders
    def _path(self, folder: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        if not fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path))

    def _checkpoints(self) -> list[tuple[int, str]]:
        """(number, folder) of the finished checkpoints, oldest first."""
        fs = self._fs()
        found = [(int(n.split("=")[1].split("-")[0]), f"{self.root}/{n}")
                 for n in self._names(self.root) if n.startswith("checkpoint=")]
        return sorted(x for x in found if fs.exists(self._path(f"{x[1]}/rows/_SUCCESS")))

    def _state(self) -> tuple[str | None, list[str], list[str]]:
        """The newest checkpoint, the tail files it does not hold, all tail files."""
        there = [n for n in self._names(f"{self.root}/tail") if n.endswith(".parquet")]
        done = self._checkpoints()
        if not done:
            return None, there, there
        folder = done[-1][1]
        held = {r[0] for r in self.spark.read.schema("value string").text(f"{folder}/held").collect()}
        return folder, [n for n in there if n not in held], there

    # ---------------------------------------------------------------- rows
    def _read(self, folder: str | None, tail: list[str]) -> DataFrame:
        paths = ([f"{folder}/rows"] if folder else []) + [f"{self.root}/tail/{n}" for n in tail]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self) -> DataFrame:
        return self._read(*self._state()[:2])

    def append(self, rows: list[tuple]) -> None:
        """All given rows at once: one file, so all or none."""
        if not rows:
            return
        # object columns keep None as None on both the Arrow and the row path
        pdf = pd.DataFrame(rows, columns=self.schema.fieldNames(), dtype=object)
        self.spark.createDataFrame(pdf, self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/tail")
        if len(self._state()[1]) >= self.every:
            self.compact()

    def compact(self) -> None:
        done = self._checkpoints()
        folder, tail, there = self._state()
        new = f"{self.root}/checkpoint={done[-1][0] + 1 if done else 1}-{uuid.uuid4().hex}"
        self.spark.createDataFrame(pd.DataFrame({"value": there}, dtype=object), "value string") \
            .coalesce(1).write.text(f"{new}/held")
        rows = self._read(folder, tail)
        (rows if self.fold is None else self.fold(rows)).coalesce(1).write.parquet(f"{new}/rows")
        fs = self._fs()
        for name in there:
            fs.delete(self._path(f"{self.root}/tail/{name}"), False)
        for _, old in done:
            fs.delete(self._path(old), True)
