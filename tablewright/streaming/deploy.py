"""Configuration-change stream (T4) with the versioned pipeline table (K6).

New rows of ``deploy_attr`` arrive as a stream. Each micro-batch compiles the
pipelines of all its processes at once (N6), checks them (N7) and upserts the
good ones into the pipeline table; every deploy row gets a status and a log
message. Errors are rows: one bad process does not stop the others.

A micro-batch is a *transaction*, known by its stream's id (kept in the stream's
checkpoint) and its batch id. The version log maps transactions to versions of
the pipeline table, and the log alone counts them: a stream with a new checkpoint
adds to the newest version, whatever its batch ids are. A transaction writes its
pipelines, its status rows and its stream replacements under its version's
number, then one log row publishes them. After that the status rows are copied
to the status table and the streams are replaced, both keyed by the transaction.
A replayed micro-batch finds its log row, compiles nothing and does only this
last part again, which changes nothing if it was done. One deploy stream writes a
pipeline table at a time.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.operators.upsert import upsert
from tablewright.plans.compile import compile_pipelines, config_violations
from tablewright.plans.runner import Config, RunContext, Runner
from tablewright.schemas import DEPLOY_ATTR, PIPELINE
from tablewright.streaming.capture import replace_checkpoint
from tablewright.streaming.eventlog import EventLog

DEPLOY_LOG = "version int, tx string, at timestamp"


def deploy_log(spark: SparkSession, root: str) -> EventLog:
    return EventLog(spark, f"{root}/_log", DEPLOY_LOG)


def newest_version(spark: SparkSession, root: str) -> int:
    """The newest published version; 0 before the first."""
    return int(deploy_log(spark, root).rows().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0])


def current_pipelines(spark: SparkSession, root: str) -> DataFrame:
    version = newest_version(spark, root)
    if not version:
        return spark.createDataFrame([], PIPELINE)
    return spark.read.schema(PIPELINE).parquet(f"{root}/version={version}")


def transaction(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """The stream id that Spark keeps in the checkpoint, and the batch id."""
    line = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return f"{json.loads(line)['id']}/{batch_id}"


def run_deployed(runner: Runner, root: str, ctx: RunContext) -> dict:
    """Entry B: run the stored pipeline of ``ctx.process`` (any case); returns
    the final run state."""
    rows = (current_pipelines(runner.spark, root)
            .where(F.lower("process_name") == F.lower(F.lit(ctx.process))).select("pipeline_config").collect())
    if len(rows) != 1:
        raise ValueError(f"process {ctx.process}: {len(rows)} rows in the pipeline table")
    return runner.run(json.loads(rows[0][0]), ctx)


def replace_streams(spark: SparkSession, deploys: DataFrame, checkpoint_root: str, tx: str | None = None) -> list[str]:
    """T5: a deploy row asking to replace its process's stream opens a new
    checkpoint version (the next run starts a new stream; with a time-travel
    property it starts at that point), once per transaction. Others keep their
    stream position."""
    procs = [r[0] for r in deploys.where(F.coalesce("replace_existing_stream", F.lit(False)))
                                  .select(F.lower("process_name")).distinct().collect()]
    for proc in procs:
        replace_checkpoint(spark, proc, root=checkpoint_root, tx=tx)
    return procs


def _compile(spark: SparkSession, deploys: DataFrame, config: Config, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next pipeline table and the status rows of one batch."""
    procs = deploys.select(F.lower("process_name").alias("process")).distinct()
    objs = config.object_attr.join(procs, F.lower(config.object_attr.process_name) == procs.process, "left_semi")
    bad = (config_violations(objs, config.target_attr, config.column_attr, config.query_view)
           .groupBy("process").agg(F.array_join(F.array_sort(F.collect_set(
               F.concat_ws(": ", F.coalesce("target", F.lit("process")), "rule"))), "; ").alias("log")))
    compiled = compile_pipelines(objs, config.target_attr, config.column_attr, config.query_view,
                                 config.query_order, config.templates) \
        .withColumnRenamed("process_name", "process")
    good = compiled.join(bad, "process", "left_anti")
    last = (deploys.withColumn("process", F.lower("process_name"))
                   .groupBy("process").agg(F.max_by("commit_message", "sequence_number").alias("msg")))
    now, user = F.current_timestamp(), F.current_user()
    new = (good.join(last, "process", "left").select(
        F.col("process").alias("process_name"), "pipeline_config",
        F.lit(None).cast("string").alias("runtime_params"), F.col("msg").alias("comment_text"),
        user.alias("create_user"), now.alias("create_date_time"),
        user.alias("update_user"), now.alias("update_date_time")))
    merged = upsert(old, new, ["process_name"], keep_from_old=["create_user", "create_date_time"])
    # status per deploy row: succeeded, failed with the rules broken, or
    # failed because the process has no configuration at all
    known = objs.select(F.lower("process_name").alias("process")).distinct().withColumn("known", F.lit(True))
    status = (deploys.withColumn("process", F.lower("process_name"))
              .join(bad, "process", "left").join(known, "process", "left")
              .select(*[c for c in DEPLOY_ATTR.fieldNames() if c not in ("status", "log_message",
                                                                        "completion_date_time")],
                      F.when(F.col("known").isNull(), "FAILED").when(F.col("log").isNotNull(), "FAILED")
                       .otherwise("SUCCEEDED").alias("status"),
                      F.when(F.col("known").isNull(), F.lit("process not found in object_attr"))
                       .otherwise(F.col("log")).alias("log_message"),
                      F.current_timestamp().cast("timestamp_ntz").alias("completion_date_time")))
    return merged, status


def publish_deploys(spark: SparkSession, deploys: DataFrame, config: Config, root: str, tx: str,
                    status_root: str, checkpoint_root: str | None = None) -> int:
    """Publish one batch of deploy rows as transaction ``tx``; returns its
    version. Called again with the same ``tx`` it changes nothing."""
    log = deploy_log(spark, root)
    version = log.rows().where(F.col("tx") == tx).agg(F.min("version")).first()[0]
    if version is None:
        version = newest_version(spark, root) + 1
        merged, status = _compile(spark, deploys, config, current_pipelines(spark, root))
        merged.write.mode("overwrite").parquet(f"{root}/version={version}")
        status.write.mode("overwrite").parquet(f"{root}/status/version={version}")
        log.append([(version, tx, datetime.now())])
    # what follows from the log row, the same however often it is done
    status = spark.read.parquet(f"{root}/status/version={version}")
    status.write.mode("overwrite").parquet(f"{status_root}/tx={hashlib.sha256(tx.encode()).hexdigest()[:32]}")
    if checkpoint_root:
        replace_streams(spark, status, checkpoint_root, tx)
    return version


def run_deploy_stream(spark: SparkSession, deploy_source: str, config: Config,
                      pipeline_root: str, status_root: str, checkpoint: str,
                      stream_checkpoint_root: str | None = None) -> list[int]:
    """Process every new deploy row (availableNow); returns the batch ids."""
    seen: list[int] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        session = batch.sparkSession
        publish_deploys(session, batch, config, pipeline_root, transaction(session, checkpoint, batch_id),
                        status_root, stream_checkpoint_root)

    # Files are taken by what the checkpoint has seen, never by their age.
    reader = spark.readStream.schema(DEPLOY_ATTR).option("maxFileAge", "36500d")
    if any(ch in deploy_source for ch in "*?["):
        reader = reader.option("basePath", deploy_source.rsplit("/", 2)[0])
    q = (reader.parquet(deploy_source).writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return seen
