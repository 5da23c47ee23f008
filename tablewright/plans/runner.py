"""Run a compiled pipeline (entry B) and restart a failed run (entry C).

The runner keeps a dictionary of named DataFrames (the environment) and
executes the steps of one pipeline in order. Nothing is computed until a sink
writes; every sink is a Spark job on the executors. Steps below the restart
step are skipped (F6); when the change stream delivered nothing the remaining
steps are skipped (F7). Each run appends its STARTED and final events to the
run history (K7); the final state applies the success threshold (A4) to the
record counts of all delivery targets of the run (counted per target, summed
for the run).

Step functions: ``consume_stream``, ``create_view``, ``sql``, ``statements``,
``deliver``, ``table_sink``, ``file_sink``, ``drop_staging``. Users may add
their own: ``Runner.steps[name] = fn(runner, args) -> None``.
"""

from __future__ import annotations

import json
import logging
import traceback
from dataclasses import dataclass, field
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, NullType, StringType, StructField, StructType

from tablewright.functions.params import bind_sql
from tablewright.functions.scalars import run_id_now
from tablewright.operators import audit, delivery, mapping
from tablewright.operators.payload import build_payload
from tablewright.schemas import QUERY_ORDER_CONFIG, QUERY_TEMPLATE_CONFIG, QUERY_VIEW_CONFIG, RUN_EVENT
from tablewright.session import work_path
from tablewright.sinks.writers import append_dead_letters, run_statements, write_files, write_table
from tablewright.sources.scan import replay, stored_dead_letters
from tablewright.sources.views import build_view, child_session, register_tables
from tablewright.streaming.capture import (
    capture_changes, capture_snapshot_changes, checkpoint_location, mark_committed, purge_committed,
    read_staged, uncommitted_batches,
)
from tablewright.streaming.eventlog import EventLog, child_folders

log = logging.getLogger(__name__)

# Steps that only name DataFrames. A restart runs them again, whatever its step,
# so that later steps see the delta of the failed run and not the whole table.
LAZY_STEPS = ("consume_stream", "create_view", "sql")


@dataclass
class Config:
    """The configuration tables (small DataFrames)."""
    object_attr: DataFrame
    target_attr: DataFrame
    column_attr: DataFrame
    query_view: DataFrame | None = None
    query_order: DataFrame | None = None
    templates: DataFrame | None = None


@dataclass
class RunContext:
    process: str
    run_id: int = field(default_factory=run_id_now)
    restart_run_id: int | None = None
    restart_step_id: int | None = None
    status_codes: list[int] | None = None
    args: dict = field(default_factory=dict)


class Runner:
    def __init__(self, spark: SparkSession, config: Config, tables: dict[str, str],
                 sender=None, history: str | None = None, dead_letter_root: str | None = None,
                 max_retries: int = delivery.DEFAULT_MAX_RETRIES,
                 base_wait: float = delivery.DEFAULT_BASE_WAIT,
                 max_wait: float = delivery.DEFAULT_MAX_WAIT, sleep: bool = False,
                 partitions: int | None = None, work_root: str | None = None):
        self.spark = spark
        self.session = spark
        self.config = config
        self.tables = tables            # table name → parquet location
        self.sender = sender
        # staged deltas, stream checkpoints and attempts live under work_root
        self.work_root = work_root or work_path(spark)
        self.history = history or work_path(spark, "run_history")
        self.dead_root = dead_letter_root or work_path(spark, "dead_letters")
        self.retry = dict(max_retries=max_retries, base_wait=base_wait, max_wait=max_wait,
                          sleep=sleep, partitions=partitions)
        self.env: dict[str, DataFrame] = {}
        self.counts: dict[str, dict] = {}
        self.ctx: RunContext | None = None
        self.obj: dict = {}
        self.stream_has_data = True
        self.steps = {
            "consume_stream": Runner.consume_stream, "create_view": Runner.create_view,
            "sql": Runner.sql, "statements": Runner.statements, "deliver": Runner.deliver,
            "table_sink": Runner.table_sink, "file_sink": Runner.file_sink,
            "drop_staging": Runner.drop_staging,
        }

    # ------------------------------------------------------------ lifecycle
    def run(self, pipeline: dict, ctx: RunContext) -> dict:
        """Execute ``pipeline`` (``{"pipeline_name", "data_flow": [steps]}``).
        Returns the final run state; the run history gets both events."""
        self.ctx, self.env, self.counts, self.stream_has_data = ctx, {}, {}, True
        self.session, self.batches = self.spark, []
        obj = (self.config.object_attr
               .where(F.lower("process_name") == F.lower(F.lit(ctx.process))).collect())
        if len(obj) != 1:
            raise ValueError(f"process {ctx.process}: {len(obj)} rows in object_attr")
        self.obj = obj[0].asDict()
        register_tables(self.spark, self.tables)
        start = datetime.now()
        self._history([(1, "STARTED", None, None, None, None, None)], start)
        state = {"status": audit.FAILED, "failure_reason": None}
        try:
            for step in sorted(pipeline["data_flow"], key=lambda s: int(s["step_id"])):
                ahead = int(step["step_id"]) - int(ctx.restart_step_id or 0)
                if ctx.restart_step_id is not None and ahead < 0 and step["func"] not in LAZY_STEPS:
                    log.info("restart: skipping step %s", step["step_id"])
                    continue
                # without staged data a restart can still resend its step's dead letters
                resend = ctx.restart_run_id is not None and ahead == 0 and step["func"] == "deliver"
                bound = ctx.restart_run_id is not None and step["func"] in LAZY_STEPS
                if not self.stream_has_data and not resend and not bound:
                    log.info("no new data: skipping step %s", step["step_id"])
                    continue
                args = step.get("args", step)
                self.steps[step["func"]](self, {k: v for k, v in args.items()}, int(step["step_id"]))
            state = self._evaluate()
        except Exception as e:  # the run fails, history says why
            log.error(traceback.format_exc())
            state = {"status": audit.FAILED, "failure_reason": f"{type(e).__name__}: {e}",
                     "successful_record_count": None, "failed_record_count": None}
            self._history([(2, audit.FAILED, None, None, state["failure_reason"], datetime.now(), self._target_rows())], start)
            raise
        self._history([(2, state["status"], state["successful_record_count"], state["failed_record_count"],
                        state["failure_reason"], datetime.now(), self._target_rows())], start)
        return state

    def _target_rows(self) -> dict:
        """A1: rows per target, of endpoints, tables and files alike."""
        return {target: c["rows"] for target, c in self.counts.items()}

    def _evaluate(self) -> dict:
        sent = [c for c in self.counts.values() if "failed" in c]
        total = sum(c["rows"] for c in sent)
        failed = sum(c["failed"] for c in sent)
        thresholds = [c["threshold"] for c in sent if c["threshold"] is not None]
        threshold = min(thresholds) if thresholds else None
        pct = (total - failed) / total * 100 if total else None
        ok = threshold is None or total == 0 or pct >= threshold
        return {"status": audit.SUCCEEDED if ok else audit.FAILED,
                "successful_record_count": total - failed, "failed_record_count": failed,
                "failure_reason": None if ok else audit.THRESHOLD_REASON,
                "per_target": dict(self.counts)}

    def _log(self, process: str) -> EventLog:
        """The run history of one process."""
        return EventLog(self.spark, f"{self.history}/{process.lower()}", RUN_EVENT)

    def _history(self, events, start):
        ctx = self.ctx
        self._log(ctx.process).append(
            [(ctx.process, ctx.run_id, seq, ctx.restart_run_id, start, end, status, ok, failed, reason, rows)
             for seq, status, ok, failed, reason, end, rows in events])

    def latest_runs(self, process: str | None = None, since_run_id: int | None = None) -> DataFrame:
        """Current state of the runs of one process or all, on request from a run
        id on (run ids are times, and a history is read by its run ids)."""
        names = [process] if process else child_folders(self.spark, self.history)
        rows = self.spark.createDataFrame([], RUN_EVENT)
        for name in names:
            own = self._log(name).rows()
            rows = rows.unionByName(own if since_run_id is None else own.where(F.col("run_id") >= since_run_id))
        return audit.latest_runs(rows)

    # --------------------------------------------------------------- steps
    def _stage_root(self) -> str:
        return f"{self.work_root}/staging/{self.ctx.process.lower()}"

    def consume_stream(self, args: dict, step_id: int) -> None:
        """S6/T1–T3 (append-only) or S7 (full change feed, when the stream
        properties say ``append_only: false`` and name ``key_columns``): stage
        what is new; on restart use the staged batches."""
        stage = self._stage_root()
        primary = self.obj["primary_table"] or self.obj["object_name"]
        source = self.tables[primary]
        schema = self.spark.read.parquet(source).schema
        props = {k.lower(): v for k, v in (self.obj.get("stream_properties") or {}).items()}
        append_only = str(props.get("append_only", "true")).lower() != "false"
        if not append_only:
            schema = StructType(schema.fields + [StructField("action", StringType()),
                                                 StructField("is_update", BooleanType())])
        if self.ctx.restart_run_id is not None:
            batches = uncommitted_batches(self.spark, stage)
        elif append_only:
            since = props.get("time_travel")
            ckpt = checkpoint_location(self.spark, self.ctx.process, root=f"{self.work_root}/checkpoints")
            batches = capture_changes(self.spark, props.get("source_glob", source), schema, stage, ckpt,
                                      since=F.lit(since).cast("timestamp_ntz") if since else None,
                                      ts_col=props.get("time_column"))
        else:
            keys = [k.strip() for k in str(props.get("key_columns", "")).split(",") if k.strip()]
            if not keys:
                raise ValueError("a change-feed stream needs key_columns in its stream properties")
            batches = capture_snapshot_changes(self.spark, source, keys, stage,
                                               f"{self.work_root}/snapshots/{self.ctx.process.lower()}")
        self.stream_has_data = bool(batches)
        self.batches = batches
        if batches or self.ctx.restart_run_id is not None:
            self.env["_delta"] = read_staged(self.spark, stage, schema, batches)
            # bind the delta by name in a child session
            child = child_session(self.spark)
            register_tables(child, {k: v for k, v in self.tables.items() if k != primary})
            read_staged(child, stage, schema, batches).createOrReplaceTempView(primary)
            name = (args.get("transient_table") or "").split(".")[-1]
            if name:
                read_staged(child, stage, schema, batches).createOrReplaceTempView(name)
            self.session = child

    def create_view(self, args: dict, step_id: int) -> None:
        c = self.config
        if args.get("view_config"):  # compiled in: the configuration of deploy time
            doc = json.loads(args["view_config"])
            tables = [self.session.createDataFrame(
                [tuple(r.get(f) for f in schema.fieldNames()) for r in doc.get(name) or []], schema)
                for name, schema in (("query_view", QUERY_VIEW_CONFIG), ("query_order", QUERY_ORDER_CONFIG),
                                     ("templates", QUERY_TEMPLATE_CONFIG))]
        else:
            tables = [self._in(c.query_view), self._in(c.query_order), self._in(c.templates)]
        build_view(self.session, args["view_name"], *tables, self.ctx.args)

    def _in(self, df: DataFrame | None) -> DataFrame | None:
        """Configuration rows as a DataFrame of the current session."""
        if df is None or df.sparkSession is self.session:
            return df
        return self.session.createDataFrame(df.toPandas(), df.schema)

    def sql(self, args: dict, step_id: int) -> None:
        self.env[args["output_df"]] = bind_sql(self.session, args["query"], self.ctx.args)

    def statements(self, args: dict, step_id: int) -> None:
        ql = args.get("query_list")
        run_statements(self.session, args.get("query"), json.loads(ql) if isinstance(ql, str) else ql)

    def _select(self, args: dict, prefix: list[str] | None = None) -> DataFrame:
        exprs = args.get("select_exp")
        exprs = json.loads(exprs) if isinstance(exprs, str) else exprs
        df = self.env[args["input_df"]]
        if not exprs:
            return df.selectExpr(*prefix, "*") if prefix else df
        return df.selectExpr(*(prefix or []), *exprs)

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        path = f"{self.work_root}/{path}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _records(self, df: DataFrame, target: str) -> DataFrame:
        """The records of one target, written once with an id each
        (``_record_id``): the source and its mapping rules are evaluated a single
        time, whatever reads the records later. The id is a hash of the record
        with an occurrence number for records that are equal in every column, so
        no two share one and a rerun gives the same ids."""
        void = [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]
        for c in void:
            df = df.withColumn(c, F.col(f"`{c}`").cast("string"))   # files have no void columns
        record = F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in df.columns]), {"ignoreNullFields": "false"}), 256)
        df = df.withColumn("_record_id", record)
        if "_record_key" not in df.columns:
            df = df.withColumn("_record_key", F.col("_record_id"))
        at = f"{self.ctx.process.lower()}/{self.ctx.run_id}/{target}"
        records = self._written(df, f"records/{at}")
        repeated = self._written(delivery.repeated_records(records, "_record_id"), f"repeated/{at}")
        return delivery.numbered_repeats(records, "_record_id", repeated)

    def deliver(self, args: dict, step_id: int) -> None:
        """Documents → endpoint → attempts staged once → dead
        letters appended → counts for this target."""
        ctx, target = self.ctx, args["target"]
        props = args.get("properties")
        props = json.loads(props) if isinstance(props, str) else (props or {})
        lower = {k.lower(): v for k, v in props.items()}
        dead_path = f"{self.dead_root}/{(lower.get('fail_rec_table_name') or target).split('.')[-1]}"
        old = None
        if ctx.restart_run_id is not None and ctx.restart_step_id is not None \
                and int(ctx.restart_step_id) == step_id:
            # without this partition the failed run never completed its send
            old = stored_dead_letters(self.spark, dead_path, ctx.restart_run_id, target)
        if old is not None:
            requests = replay(old, ctx.restart_run_id, ctx.run_id, ctx.status_codes).select(
                "request_id", F.col("request_id").alias("key"), "data")
        else:
            cmap = json.loads(args["column_mapping"]) if args.get("column_mapping") else \
                mapping.category_map_dict(self.config.column_attr, ctx.process, target)
            key_col = lower.get("key_column")
            df = self._select(args, prefix=[f"{key_col} AS _record_key"] if key_col else None)
            parsed = tuple(c.strip() for c in (lower.get("json_columns") or "").split(",") if c.strip())
            requests = build_payload(self._records(df, target), cmap, props, lower.get("environment", "development"),
                                     ctx.run_id, "_record_id", json_columns=parsed, carry=("_record_key",)) \
                .withColumnRenamed("_record_key", "key")
        requests = requests.select("request_id", "key", "data")
        attempts_path = f"{self.work_root}/attempts/{ctx.process.lower()}/{ctx.run_id}/{target}"
        bulk = int(lower["bulk_size"]) if lower.get("bulk_size") else None
        carry = ()
        if bulk:
            # K4: envelopes of `bulk_size` records, one request each, written once:
            # the canary and the rest read the same envelopes
            requests = delivery.bulk_requests(requests, "request_id", ctx.run_id, bulk,
                                              int(lower.get("bulk_range_rows", delivery.ROWS_PER_RANGE)))
            requests = self._written(requests, f"envelopes/{ctx.process.lower()}/{ctx.run_id}/{target}")
            carry = ("members",)
        pace = {k: cast(lower[k]) for k, cast in (("group_size", int), ("group_pause", float), ("in_flight", int),
                                                  ("queue_size", int)) if lower.get(k)}

        # Exactly once per run: the send happens in these writes; every later
        # read uses the staged attempts, never the live send.
        def send(reqs: DataFrame, mode: str) -> None:
            delivery.deliver(reqs, self.sender, carry=carry, **self.retry, **pace) \
                .write.mode(mode).parquet(attempts_path)
            bad = delivery.aborted(self.spark.read.parquet(attempts_path))
            if bad is not None:
                raise RuntimeError(f"delivery aborted: unexpected status {bad}")

        canary = str(lower.get("canary", "true")).lower() != "false"
        first = requests.limit(1).collect() if canary else []
        if first:
            # One request alone first; an abort (e.g. rejected credentials)
            # fails the run before the fan-out. Request ids are unique, so the
            # rest is everything with another id.
            row = first[0].asDict()
            send(self.spark.createDataFrame(pd.DataFrame([row]), requests.schema), "overwrite")
            send(requests.where(F.col("request_id") != row["request_id"]), "append")
        else:
            send(requests, "overwrite")
        final = delivery.final_outcome(self.spark.read.parquet(attempts_path))
        if bulk:
            final = delivery.per_record(final)
        dead = delivery.dead_letters(final, ctx.run_id)
        append_dead_letters(dead, dead_path, ctx.run_id, target)
        row = final.agg(F.count(F.lit(1)).alias("t"),
                        F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("f")).first()
        th = lower.get("threshold_percentage")
        self.counts[target] = {"rows": int(row.t or 0), "failed": int(row.f or 0),
                               "threshold": int(th) if th not in (None, "") else None}

    def table_sink(self, args: dict, step_id: int) -> None:
        props = args.get("properties")
        props = {k.lower(): v for k, v in (json.loads(props) if isinstance(props, str) else (props or {})).items()}
        table, kind = props.get("table", args["target"]), props.get("table_type")
        if (kind or "").lower() in ("temporary", "temp"):      # a view: nothing is written, nothing counted
            write_table(self._select(args), table, table_type=kind)
            return
        df, obs = audit.observe_count(self._select(args))
        write_table(df, table, props.get("mode"), kind, props.get("path"))
        if self.session is not self.spark:
            self.spark.catalog.refreshTable(table)   # written through the delta's child session
        self.counts[args["target"]] = {"rows": obs.get["n"]}

    def file_sink(self, args: dict, step_id: int) -> None:
        props = args.get("properties")
        props = {k.lower(): v for k, v in (json.loads(props) if isinstance(props, str) else (props or {})).items()}
        # Properties are texts: lists are comma-separated, options JSON objects.
        as_dict = lambda v: json.loads(v) if isinstance(v, str) and v.strip() else (v or {})
        text = lambda v: str(v).lower() if isinstance(v, bool) else str(v)
        pb, header = props.get("partition_by"), props.get("header")
        if isinstance(pb, str):
            pb = [c.strip() for c in pb.split(",") if c.strip()]
        copy = {k.lower(): v for k, v in as_dict(props.get("copy_options")).items()}
        mode = props.get("mode") or ("overwrite" if text(copy.pop("overwrite", "false")).lower() == "true" else "errorifexists")
        options = {k: text(v) for k, v in (as_dict(props.get("format_type_options")) | copy).items()}
        df, obs = audit.observe_count(self._select(args))
        write_files(df, props["target_location"], props.get("file_format_type", "parquet"), pb, options,
                    None if header is None else text(header).lower() == "true", mode)
        self.counts[args["target"]] = {"rows": obs.get["n"]}

    def drop_staging(self, args: dict, step_id: int) -> None:
        """K8: after success the consumed batches are committed."""
        if self.batches:
            mark_committed(self.spark, self._stage_root(), self.batches)
            purge_committed(self.spark, self._stage_root(), self.batches)
        self.session = self.spark

