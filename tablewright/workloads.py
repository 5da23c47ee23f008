"""Registered workloads: every operator of the inventory applied to the given
tables, each with the DuckDB SQL that computes the same rows.

Roles of the tables (as in FIXTURES.md): ``orders`` is the primary table with
change capture, ``customer``/``nation``/``region`` are static join sides,
``events`` is the append-only stream and the source of outbound documents.
Configuration rows (mappings, views, templates, target properties) are small
literals below; the data they drive is always the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright import schemas
from tablewright.endpoints import bulk_rule_sender, rule_sender
from tablewright.functions.scalars import epoch_millis
from tablewright.operators import audit, delivery, mapping
from tablewright.operators.dedup import keep_one, priority
from tablewright.operators.joins import flag_exists, left_chain
from tablewright.operators.payload import build_payload
from tablewright.operators.upsert import upsert
from tablewright.session import work_path
from tablewright.sinks.writers import append_dead_letters, write_files, write_table
from tablewright.sources.changes import backfill, change_feed
from tablewright.sources.scan import replay, stored_dead_letters
from tablewright.sources.views import build_view, register_tables, with_delta
from tablewright.functions.params import bind_sql
from tablewright.streaming.capture import capture_changes, capture_snapshot_changes, mark_committed, read_staged

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the registered workloads.
RUN_ID = 20240101000000000
REPLAY_RUN_ID = 20240102000000000
MAX_RETRIES = 2
BASE_WAIT = 2.0
MAX_WAIT = 60.0
THRESHOLD = 95
ENVIRONMENT = "development"
ENVELOPE_SIZE = 100
ENVELOPE_RANGE_ROWS = 2_000
OPEN_STATUS_ORDER = ["O", "P"]
TARGET_PROPERTIES = {"PLAN_ID": "engagement_plan", "plan_version": "2",
                     "Event_Name": "activity", "fail_rec_table_name": "failed_events"}
OLD_SNAPSHOT_BEFORE = "2000-01-01"
NEW_SNAPSHOT_FROM = "1996-01-01"
BACKFILL_FROM = "2024-01-15"


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def _prep(spark: SparkSession) -> None:
    # Event times are timestamp_ntz; epoch conversions read them in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _register(spark: SparkSession, sf_dir: str, names=("orders", "customer", "nation", "region", "events")):
    register_tables(spark, {n: _path(sf_dir, n) for n in names})


# ---------------------------------------------------------------- config rows
ORDERS_MAPPING = [
    ("Orders_Feed", "WAREHOUSE", "o_orderkey", None, "order_id", None),
    ("orders_feed", "warehouse", "o_custkey", None, "customer_id", None),
    ("orders_feed", "warehouse", "o_orderstatus", "lower(trim(o_orderstatus))", "status", None),
    ("orders_feed", "warehouse", "o_totalprice", "cast(round(o_totalprice) as bigint)", "total_rounded", None),
    ("orders_feed", "warehouse", "o_orderdate", "date_format(o_orderdate, 'yyyy-MM-dd')", "order_day", None),
    ("orders_feed", "warehouse", "o_orderpriority", "try_cast(substr(o_orderpriority, 1, 1) as int)",
     "priority_rank", None),
    ("orders_feed", "warehouse", "o_comment", None, None, None),
    ("other_feed", "warehouse", "o_orderkey", None, "other_id", None),
]

EVENTS_MAPPING = [
    ("events_feed", "engage", "user_id", "cast(user_id as string)", "customerid", "User_Identities"),
    ("events_feed", "engage", "event_type", None, "$category", "USER_ATTRIBUTES"),
    ("events_feed", "engage", "value", None, "amount", "user_attributes"),
    ("events_feed", "engage", "props", "from_json(props, 'k int')", "props", "user_attributes"),
    ("events_feed", "engage", "ts", "unix_millis(cast(ts as timestamp))", "timestamp_unixtime_ms",
     "app_event_attributes"),
    ("events_feed", "engage", "event_type", "upper(event_type)", "event_type", "App_Event_Attributes"),
    ("events_feed", "engage", "event_id", None, "$category", "app_event_attributes"),
    ("events_feed", "engage", "ts", None, None, "app_event_attributes"),
    ("Events_Feed", "archive", "event_id", None, "event_id", None),
]

VIEW_CONFIG = [
    ("v_customer_orders",
     "select cn.c_custkey, cn.c_name, cn.n_name, ct.n_orders, round(ct.total, 2) as total "
     "from cust_nation cn join cust_totals ct on cn.c_custkey = ct.o_custkey", None, None),
    ("v_all_orders",
     "select cn.c_custkey, cn.c_name, cn.n_name, ct.n_orders, round(ct.total, 2) as total "
     "from cust_nation cn join cust_totals ct on cn.c_custkey = ct.o_custkey", None, None),
    ("v_segment_big_orders",
     "select c.c_mktsegment, count(*) as n_orders, round(sum(b.o_totalprice), 2) as total "
     "from t{{tpl_big_orders}} b join customer c on b.o_custkey = c.c_custkey group by c.c_mktsegment",
     None, {"min_price": "300000"}),
]
ORDER_CONFIG = [
    ("v_customer_orders", 2, "select o_custkey, count(*) as n_orders, sum(o_totalprice) as total "
                             "from recent_orders group by o_custkey", None, "cust_totals", None),
    ("v_customer_orders", 1, None, "tpl_recent_orders", "recent_orders", {"since": "1997-01-01"}),
    ("v_customer_orders", 3, "select c_custkey, c_name, n_name from customer "
                             "join nation on c_nationkey = n_nationkey", None, "cust_nation", None),
    ("v_all_orders", 1, "select o_custkey, count(*) as n_orders, sum(o_totalprice) as total "
                        "from orders group by o_custkey", None, "cust_totals", None),
    ("v_all_orders", 2, "select c_custkey, c_name, n_name from customer "
                        "join nation on c_nationkey = n_nationkey", None, "cust_nation", None),
]
TEMPLATE_CONFIG = [
    ("tpl_recent_orders", "select o_orderkey, o_custkey, o_totalprice from orders "
                          "where o_orderdate >= cast({{since}} as timestamp_ntz)"),
    ("tpl_big_orders", "select o_custkey, o_totalprice from orders "
                       "where o_totalprice > cast({{min_price}} as double)"),
]
PARAM_QUERY = ("select event_id, user_id, event_type, value from events "
               "where lower(event_type) = lower({{etype}}) and value >= {{min_value}}")
PARAM_VALUES = {"etype": "PURCHASE", "min_value": 25.0}
PARAM_LIKE_QUERY = """select event_id, event_type, concat(event_type, ': ', "{{label}} {{label}}") as labelled -- {{ignored}}
from events where event_type like '%{{part}}%' and "{{label}}" <> 'it''s {{part}}' /* {{ignored}} */ and value < {{max_value}}"""
PARAM_LIKE_VALUES = {"part": "c", "label": "x'y", "max_value": 60.0}
NESTED_MAPPING = [
    ("events_feed", "nest", "user_id", "cast(user_id as string)", "customerid", "user_identities"),
    ("events_feed", "nest", "props", "from_json(props, 'map<string,int>')", "as_map", "user_attributes"),
    ("events_feed", "nest", "event_type", "array(event_type, upper(event_type))", "as_array", "user_attributes"),
    ("events_feed", "nest", "value", "parse_json(props)", "as_variant", "user_attributes"),
    ("events_feed", "nest", "ts", "props", "as_text", "user_attributes"),
    ("events_feed", "nest", "props", "from_json(props, 'map<string,int>')", "as_map", "app_event_attributes"),
    ("events_feed", "nest", "event_type", "array(event_type, upper(event_type))", "as_array", "app_event_attributes"),
]


def _cfg(spark, rows, schema):
    """Inline configuration rows as a DataFrame. Built from pandas so that,
    with Arrow enabled, the rows go to the JVM directly instead of running as
    Python tasks."""
    return spark.createDataFrame(pd.DataFrame(rows, columns=schema.fieldNames(), dtype=object), schema)


# ----------------------------------------------------- shared building blocks
def _latest_orders(orders: DataFrame) -> DataFrame:
    """Latest order per customer by status priority."""
    return keep_one(orders, ["o_custkey"],
                    [priority("o_orderstatus", OPEN_STATUS_ORDER), F.col("o_orderdate").desc(),
                     F.col("o_orderkey")])


def _events_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → categorised projection → category map."""
    events = _read(spark, sf_dir, "events")
    cattr = _cfg(spark, EVENTS_MAPPING, schemas.COLUMN_ATTR)
    exprs, cmap = mapping.mapping_spec(cattr, "events_feed", "engage", categorised=True)
    return events.selectExpr(*exprs), cmap


def _delivery_attempts(spark: SparkSession, sf_dir: str, carry=()) -> DataFrame:
    """Documents of every event (N1–N4) sent through the deterministic
    endpoint (K3). Rows are spread before the Python-heavy stages when the
    scan alone would not give every core a partition."""
    events = _read(spark, sf_dir, "events")
    cattr = _cfg(spark, EVENTS_MAPPING, schemas.COLUMN_ATTR)
    exprs, cmap = mapping.mapping_spec(cattr, "events_feed", "engage", categorised=True)
    extra = [f"`{c}`" for c in carry]
    projected = events.selectExpr("event_id", *extra, *exprs)
    docs = build_payload(projected, cmap, TARGET_PROPERTIES, ENVIRONMENT, RUN_ID, "event_id",
                         carry=tuple(carry))
    return delivery.deliver(docs, rule_sender, max_retries=MAX_RETRIES, base_wait=BASE_WAIT,
                            max_wait=MAX_WAIT, key="event_id", carry=tuple(carry))


# ------------------------------------------------------------------ queries
def q_dedup_priority(spark, sf_dir):
    return _latest_orders(_read(spark, sf_dir, "orders")).select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")


def q_left_join_chain(spark, sf_dir):
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    latest = _latest_orders(_read(spark, sf_dir, "orders")).select(
        "o_custkey", "o_orderkey", "o_orderstatus")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = left_chain(customer, [
        (latest, customer.c_custkey == latest.o_custkey),
        (nation, F.col("c_nationkey") == F.col("n_nationkey")),
        (region, F.col("n_regionkey") == F.col("r_regionkey")),
    ])
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_orderstatus", "n_name", "r_name",
                         F.col("o_orderkey").isNull().alias("no_order"))


def q_cte_view(spark, sf_dir):
    _prep(spark)
    _register(spark, sf_dir)
    return build_view(spark, "v_customer_orders",
                      _cfg(spark, VIEW_CONFIG, schemas.QUERY_VIEW_CONFIG),
                      _cfg(spark, ORDER_CONFIG, schemas.QUERY_ORDER_CONFIG),
                      _cfg(spark, TEMPLATE_CONFIG, schemas.QUERY_TEMPLATE_CONFIG))


def q_incremental_view(spark, sf_dir):
    _prep(spark)
    # The captured delta of orders, staged in the shared folder, is bound to
    # the name `orders` in a child session; the view text is unchanged.
    staged = work_path(spark, "staging", "orders_delta", unique=True)
    backfill(_read(spark, sf_dir, "orders"), "o_orderdate", F.lit(OLD_SNAPSHOT_BEFORE).cast("timestamp_ntz")) \
        .write.parquet(staged)
    child = with_delta(spark, staged, "orders",
                       {n: _path(sf_dir, n) for n in ("customer", "nation")})
    return build_view(child, "v_customer_orders",
                      _cfg(child, VIEW_CONFIG, schemas.QUERY_VIEW_CONFIG),
                      _cfg(child, ORDER_CONFIG, schemas.QUERY_ORDER_CONFIG),
                      _cfg(child, TEMPLATE_CONFIG, schemas.QUERY_TEMPLATE_CONFIG))


def q_param_filter(spark, sf_dir):
    _register(spark, sf_dir, ("events",))
    return bind_sql(spark, PARAM_QUERY, PARAM_VALUES)


def q_param_like(spark, sf_dir):
    _register(spark, sf_dir, ("events",))
    return bind_sql(spark, PARAM_LIKE_QUERY, PARAM_LIKE_VALUES)


def q_template_view(spark, sf_dir):
    _register(spark, sf_dir)
    return build_view(spark, "v_segment_big_orders",
                      _cfg(spark, VIEW_CONFIG, schemas.QUERY_VIEW_CONFIG), None,
                      _cfg(spark, TEMPLATE_CONFIG, schemas.QUERY_TEMPLATE_CONFIG))


def q_mapping_project(spark, sf_dir):
    _prep(spark)
    return mapping.map_columns(_read(spark, sf_dir, "orders"),
                               _cfg(spark, ORDERS_MAPPING, schemas.COLUMN_ATTR),
                               "orders_feed", "warehouse")


def q_categorised_project(spark, sf_dir):
    _prep(spark)
    projected, _ = _events_payload(spark, sf_dir)
    return projected.withColumn("props_user_attributes", F.col("props_user_attributes.k")) \
                    .withColumnRenamed("props_user_attributes", "props_k_user_attributes")


def q_payload_fields(spark, sf_dir):
    _prep(spark)
    events = _read(spark, sf_dir, "events")
    cattr = _cfg(spark, EVENTS_MAPPING, schemas.COLUMN_ATTR)
    exprs, cmap = mapping.mapping_spec(cattr, "events_feed", "engage", categorised=True)
    projected = events.selectExpr(*exprs)
    docs = build_payload(projected.withColumn("event_id", F.col("category_app_event_attributes")),
                         cmap, TARGET_PROPERTIES, ENVIRONMENT, RUN_ID, "event_id")
    # Read the fields back from the JSON text (never compare JSON as text).
    parsed = F.from_json("data", docs.schema["payload"].dataType)
    d = docs.select("event_id", "request_id", parsed.alias("p"))
    ev = F.col("p.events")[0]
    return d.select(
        "event_id", "request_id",
        F.col("p.environment").alias("environment"),
        F.col("p.user_identities.customerid").alias("customerid"),
        F.col("p.user_attributes.$category").alias("category"),
        F.col("p.user_attributes.amount").alias("amount"),
        F.col("p.user_attributes.props.k").alias("props_k"),
        F.col("p.context.data_plan.plan_id").alias("plan_id"),
        F.col("p.context.data_plan.plan_version").alias("plan_version"),
        ev["data"]["event_name"].alias("event_name"),
        ev["data"]["custom_event_type"].alias("custom_event_type"),
        ev["event_type"].alias("event_type"),
        ev["data"]["timestamp_unixtime_ms"].alias("ts_ms"),
        F.col("p.source_request_id").alias("source_request_id"))


def q_nested_payload(spark, sf_dir):
    """What nests follows from the columns' types; read back from the JSON
    text of the documents."""
    _prep(spark)
    events = _read(spark, sf_dir, "events")
    cattr = _cfg(spark, NESTED_MAPPING, schemas.COLUMN_ATTR)
    exprs, cmap = mapping.mapping_spec(cattr, "events_feed", "nest", categorised=True)
    docs = build_payload(events.selectExpr("event_id", *exprs), cmap, TARGET_PROPERTIES, ENVIRONMENT, RUN_ID, "event_id")
    at = lambda path: F.get_json_object("data", f"$.{path}")
    user, event = "user_attributes", "events[0].data"
    return docs.select(
        "event_id", at(f"{user}.as_map.k").cast("int").alias("map_k"), at(f"{user}.as_array[1]").alias("array_1"),
        at(f"{user}.as_variant.k").cast("int").alias("variant_k"),
        F.get_json_object(at(f"{user}.as_text"), "$.k").cast("int").alias("text_k"), at(f"{user}.as_text.k").alias("text_as_value"),
        at(f"{event}.as_map.k").cast("int").alias("event_map_k"), at(f"{event}.as_array[1]").alias("event_array_as_value"),
        F.get_json_object(at(f"{event}.as_array"), "$[1]").alias("event_array_1"))


def q_json_nested(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def q_epoch_attr(spark, sf_dir):
    _prep(spark)
    events = _read(spark, sf_dir, "events")
    return events.select("event_id", epoch_millis("ts").alias("ts_ms"))


def q_bulk_envelopes(spark, sf_dir):
    events = _read(spark, sf_dir, "events").select("event_id")
    env = delivery.envelopes(events, "event_id", ENVELOPE_SIZE, ENVELOPE_RANGE_ROWS, unique=True)
    return (env.groupBy("bucket", "envelope")
               .agg(F.count(F.lit(1)).alias("n_records"), F.min("event_id").alias("first_key"),
                    F.max("event_id").alias("last_key")))


def q_delivery_outcome(spark, sf_dir):
    _prep(spark)
    return delivery.outcome(_delivery_attempts(spark, sf_dir)).drop("data")


def q_retry_schedule(spark, sf_dir):
    _prep(spark)
    sched = delivery.retry_schedule(_delivery_attempts(spark, sf_dir), BASE_WAIT, MAX_WAIT)
    return sched.select("request_id", "attempt", "status", "wait_s")


def q_dead_letters(spark, sf_dir):
    _prep(spark)
    final = delivery.final_outcome(_delivery_attempts(spark, sf_dir))
    dead = delivery.dead_letters(final, RUN_ID)
    return dead.select("source_request_id", "run_id", "status_code", "failed_reason",
                       F.get_json_object("data", "$.user_identities.customerid").alias("customerid"),
                       F.get_json_object("data", "$.events[0].data.event_name").alias("event_name"))


def q_replay(spark, sf_dir):
    _prep(spark)
    final = delivery.final_outcome(_delivery_attempts(spark, sf_dir))
    location = work_path(spark, "dead_letters", unique=True)
    append_dead_letters(delivery.dead_letters(final, RUN_ID), location, RUN_ID, "engage")
    again = replay(stored_dead_letters(spark, location, RUN_ID, "engage"), RUN_ID, REPLAY_RUN_ID, status_codes=[500, 999])
    return again.select("request_id", "replayed_request_id", "previous_status",
                        F.get_json_object("data", "$.user_identities.customerid").alias("customerid"))


def q_bulk_delivery(spark, sf_dir):
    _prep(spark)
    events = _read(spark, sf_dir, "events")
    cattr = _cfg(spark, EVENTS_MAPPING, schemas.COLUMN_ATTR)
    exprs, cmap = mapping.mapping_spec(cattr, "events_feed", "engage", categorised=True)
    docs = build_payload(events.selectExpr("event_id", *exprs), cmap, TARGET_PROPERTIES, ENVIRONMENT,
                         RUN_ID, "event_id")
    bulk = delivery.bulk_requests(docs, "event_id", RUN_ID, ENVELOPE_SIZE, ENVELOPE_RANGE_ROWS)
    sent = delivery.deliver(bulk, bulk_rule_sender, max_retries=MAX_RETRIES, base_wait=BASE_WAIT,
                            max_wait=MAX_WAIT, carry=("members",))
    recs = delivery.per_record(delivery.final_outcome(sent))
    return recs.select("request_id", "envelope_request_id", "n_attempts", "status_code", "ok",
                       F.get_json_object("data", "$.user_identities.customerid").alias("customerid"))


def q_canary_split(spark, sf_dir):
    events = _read(spark, sf_dir, "events").select("event_id", "user_id")
    canary, rest = delivery.canary_split(events, "event_id")
    return (canary.withColumn("is_canary", F.lit(True))
                  .unionByName(rest.withColumn("is_canary", F.lit(False))))


def q_threshold(spark, sf_dir):
    _prep(spark)
    final = delivery.final_outcome(_delivery_attempts(spark, sf_dir, carry=("event_type",)))
    counts = audit.run_counts(final, THRESHOLD, by=["event_type"])
    return counts.withColumn("success_pct", F.round("success_pct", 6))


def _run_latest(spark, sf_dir):
    attempts = _delivery_attempts(spark, sf_dir, carry=("event_type", "ts"))
    final = delivery.final_outcome(attempts).withColumn(
        "run_id", F.date_format("ts", "yyyyMMdd").cast("long"))
    counts = audit.run_counts(final, THRESHOLD, by=["event_type", "run_id"],
                              extra={"start_ts": F.min("ts"), "end_ts": F.max("ts")})
    events = audit.run_events(counts, F.col("event_type"), F.col("run_id"),
                              F.col("start_ts"), F.col("end_ts"))
    return audit.latest_runs(events)


def q_latest_run(spark, sf_dir):
    _prep(spark)
    return _run_latest(spark, sf_dir).select("process_name", "run_id", "status",
                                             "successful_record_count", "failed_record_count",
                                             "failure_reason")


def q_run_rollup(spark, sf_dir):
    _prep(spark)
    return audit.rollup_runs(_run_latest(spark, sf_dir))


def _snapshots(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    cut_old = F.lit(OLD_SNAPSHOT_BEFORE).cast("timestamp_ntz")
    cut_new = F.lit(NEW_SNAPSHOT_FROM).cast("timestamp_ntz")
    old = orders.where(F.col("o_orderdate") < cut_old)
    new = orders.where(F.col("o_orderdate") >= cut_new).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1)
                         .otherwise(F.col("o_totalprice")))
    return old, new


def q_change_feed(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return change_feed(old, new, ["o_orderkey"])


def q_change_feed_stream(spark, sf_dir):
    """S7 as a stream: the table is captured twice, as it was and as it is; the
    second delta is the feed between the two."""
    work = work_path(spark, "change_stream", unique=True)
    for name, df in zip(("old", "new"), _snapshots(spark, sf_dir)):
        df.write.parquet(f"{work}/{name}")
        batches = capture_snapshot_changes(spark, f"{work}/{name}", ["o_orderkey"], f"{work}/stage", f"{work}/state")
        mark_committed(spark, f"{work}/stage", batches)
    schema = spark.read.parquet(f"{work}/stage/batch_id={batches[0]}").schema
    return read_staged(spark, f"{work}/stage", schema, batches)


def q_upsert(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    old = old.withColumn("first_seen", F.col("o_orderdate"))
    new = new.withColumn("first_seen", F.lit("2001-09-01").cast("timestamp_ntz"))
    return upsert(old, new, ["o_orderkey"], keep_from_old=["first_seen"])


def q_backfill(spark, sf_dir):
    events = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return backfill(events, "ts", F.lit(BACKFILL_FROM).cast("timestamp_ntz"))


def q_append_stream(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    stage = work_path(spark, "staging", "events", unique=True)
    ckpt = work_path(spark, "checkpoints", "events", unique=True)
    source = _path(sf_dir, "events")[:-1] + "[t]"  # a glob: stream sources list a folder
    batches = capture_changes(spark, source, events.schema, stage, ckpt)
    return read_staged(spark, stage, events.schema, batches)


def q_exists_flag(spark, sf_dir):
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    ordered = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return flag_exists(customer, ordered, ["c_custkey"], "has_order")


def q_duplicate_keys(spark, sf_dir):
    from tablewright.plans.compile import duplicate_keys
    return duplicate_keys(_read(spark, sf_dir, "orders"), ["o_custkey"])


def _events_projection(spark, sf_dir):
    return _read(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "lower(event_type) as event_type", "value")


def q_table_sink(spark, sf_dir):
    name = "tw_sink_" + work_path(spark, unique=True).rsplit("/", 1)[-1][:12]
    write_table(_events_projection(spark, sf_dir), name,
                path=work_path(spark, "tables", name))
    return (spark.table(name).groupBy("event_type")
                 .agg(F.count(F.lit(1)).alias("n_rows"),
                      F.round(F.sum("value"), 2).alias("total_value")))


def q_file_sink(spark, sf_dir):
    path = work_path(spark, "files", "events", unique=True)
    df = _events_projection(spark, sf_dir)
    write_files(df, path, fmt="csv", partition_by=["event_type"], header=True)
    back = (spark.read.schema("event_id long, user_id long, value double, event_type string")
                 .option("header", "true").csv(path))
    return (back.groupBy("event_type")
                .agg(F.count(F.lit(1)).alias("n_rows"),
                     F.round(F.sum("value"), 2).alias("total_value")))


def _compiled(cfg) -> dict:
    from tablewright.plans.compile import compile_pipelines
    import json
    return json.loads(compile_pipelines(cfg.object_attr, cfg.target_attr, cfg.column_attr)
                      .first().pipeline_config)


def q_process_run(spark, sf_dir):
    """The whole process on the events table: configuration compiled to a
    pipeline (N6), run by the step runner — extract, documents to the
    endpoint with retries and dead letters, a table copy — then the run's
    final state from the history (K7) with the threshold (A4)."""
    from tablewright.plans.runner import Config, RunContext, Runner
    _prep(spark)
    work = work_path(spark, "runs", unique=True)
    archive = "tw_archive_" + work.rsplit("/", 1)[-1][:12]
    props = {**TARGET_PROPERTIES, "key_column": "event_id", "threshold_percentage": str(THRESHOLD)}
    cfg = Config(
        _cfg(spark, [("events_feed", "events to the engagement endpoint", "db", "sch", "events", "table",
                      None, None, {"engage": "endpoint", "archive": "table"}, False, None, None)],
             schemas.OBJECT_ATTR),
        _cfg(spark, [("Events_Feed", "ENGAGE", props),
                     ("events_feed", "archive", {"table": archive, "path": f"{work}/tables/{archive}"})],
             schemas.TARGET_ATTR),
        _cfg(spark, EVENTS_MAPPING, schemas.COLUMN_ATTR))
    runner = Runner(spark, cfg, {"events": _path(sf_dir, "events")}, sender=rule_sender,
                    max_retries=MAX_RETRIES, base_wait=BASE_WAIT, max_wait=MAX_WAIT,
                    history=f"{work}/history", dead_letter_root=f"{work}/dead", work_root=work)
    runner.run(_compiled(cfg), RunContext("events_feed", run_id=RUN_ID))
    return runner.latest_runs("events_feed").select(
        "process_name", "run_id", "status", "successful_record_count", "failed_record_count", "failure_reason",
        F.col("target_rows")["engage"].alias("engage_rows"), F.col("target_rows")["archive"].alias("archive_rows"))


def q_process_incremental(spark, sf_dir):
    """An incremental view process: the orders stream is consumed once and
    staged (S6, T1), bound under the name ``orders`` (S5) for the configured
    view (S4, F3, F4), projected by the mapping (P2) into a table (K1), and
    the staged batch is committed (K8)."""
    from tablewright.plans.runner import Config, RunContext, Runner
    _prep(spark)
    work = work_path(spark, "runs", unique=True)
    table = "tw_orders_view_" + work.rsplit("/", 1)[-1][:12]
    cfg = Config(
        _cfg(spark, [("orders_cdc", "customer order totals", "db", "sch", "v_all_orders", "view",
                      "db.sch.orders_stream", None, {"warehouse": "table"}, True, "orders",
                      "db.sch.orders_stg")], schemas.OBJECT_ATTR),
        _cfg(spark, [("orders_cdc", "warehouse", {"table": table, "mode": "overwrite",
                                                  "path": f"{work}/tables/{table}"})], schemas.TARGET_ATTR),
        _cfg(spark, [("orders_cdc", "warehouse", "c_custkey", None, "customer_key", None),
                     ("orders_cdc", "warehouse", "c_name", None, "customer_name", None),
                     ("orders_cdc", "warehouse", "n_name", "upper(n_name)", "nation", None),
                     ("orders_cdc", "warehouse", "n_orders", None, "n_orders", None),
                     ("orders_cdc", "warehouse", "total", None, "total", None)], schemas.COLUMN_ATTR),
        _cfg(spark, VIEW_CONFIG, schemas.QUERY_VIEW_CONFIG),
        _cfg(spark, ORDER_CONFIG, schemas.QUERY_ORDER_CONFIG),
        _cfg(spark, TEMPLATE_CONFIG, schemas.QUERY_TEMPLATE_CONFIG))
    orders_glob = _path(sf_dir, "orders")[:-1] + "[t]"   # stream sources list a folder
    runner = Runner(spark, cfg, {"orders": orders_glob, "customer": _path(sf_dir, "customer"),
                                 "nation": _path(sf_dir, "nation")},
                    history=f"{work}/history", work_root=work)
    runner.run(_compiled(cfg), RunContext("orders_cdc", run_id=RUN_ID))
    return spark.table(table)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_priority": q_dedup_priority,
    "left_join_chain": q_left_join_chain,
    "cte_view": q_cte_view,
    "incremental_view": q_incremental_view,
    "param_filter": q_param_filter,
    "param_like": q_param_like,
    "template_view": q_template_view,
    "mapping_project": q_mapping_project,
    "categorised_project": q_categorised_project,
    "payload_fields": q_payload_fields,
    "json_nested": q_json_nested,
    "nested_payload": q_nested_payload,
    "epoch_attr": q_epoch_attr,
    "bulk_envelopes": q_bulk_envelopes,
    "delivery_outcome": q_delivery_outcome,
    "retry_schedule": q_retry_schedule,
    "dead_letters": q_dead_letters,
    "replay": q_replay,
    "bulk_delivery": q_bulk_delivery,
    "canary_split": q_canary_split,
    "threshold": q_threshold,
    "latest_run": q_latest_run,
    "run_rollup": q_run_rollup,
    "change_feed": q_change_feed,
    "change_feed_stream": q_change_feed_stream,
    "upsert": q_upsert,
    "backfill": q_backfill,
    "append_stream": q_append_stream,
    "exists_flag": q_exists_flag,
    "duplicate_keys": q_duplicate_keys,
    "table_sink": q_table_sink,
    "file_sink": q_file_sink,
    "process_run": q_process_run,
    "process_incremental": q_process_incremental,
}


# --------------------------------------------------------------- oracle SQL
_RID = "sha256('20240101000000000|' || CAST(event_id AS VARCHAR))"
_FINAL_STATUS = ("CASE WHEN event_id % 100 = 50 THEN 202 WHEN event_id % 50 = 0 THEN 500 "
                 "WHEN event_id % 31 = 0 THEN 429 WHEN event_id % 97 = 0 THEN 999 ELSE 202 END")
_N_ATTEMPTS = ("CASE WHEN event_id % 100 = 50 THEN 2 WHEN event_id % 50 = 0 OR event_id % 31 = 0 "
               "OR event_id % 97 = 0 THEN 3 ELSE 1 END")
_REASON = ("CASE {s} WHEN 202 THEN 'Accepted' WHEN 500 THEN 'Internal Server Error' "
           "WHEN 429 THEN 'Too Many Requests' WHEN 999 THEN 'Protocol error' END")
_DELIVERED = f"""
  SELECT *, {_RID} AS request_id, {_FINAL_STATUS} AS status_code, {_N_ATTEMPTS} AS n_attempts
  FROM events"""

_VIEW_WITH = """
WITH recent_orders AS (
  SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}
  WHERE o_orderdate >= CAST('1997-01-01' AS TIMESTAMP)),
cust_totals AS (
  SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM recent_orders GROUP BY o_custkey),
cust_nation AS (
  SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT cn.c_custkey, cn.c_name, cn.n_name, ct.n_orders, round(ct.total, 2) AS total
FROM cust_nation cn JOIN cust_totals ct ON cn.c_custkey = ct.o_custkey"""

_RANGES = """
WITH h AS (SELECT event_id, user_id, ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT AS h,
                  ceil(count(*) OVER () / 2000.0) AS wanted FROM events),
e AS (SELECT event_id, user_id, h, CAST((h * CAST(pow(2, ceil(log2(wanted))) AS BIGINT)) >> 32 AS INTEGER) AS bucket
      FROM h)"""

_SNAPSHOTS = """
WITH old AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01'),
new AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01')"""

_RUNS = f"""
WITH d AS ({_DELIVERED}),
g AS (
  SELECT event_type AS process_name, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS run_id,
         count(*) AS total, sum(CASE WHEN status_code IN (200, 202) THEN 0 ELSE 1 END) AS failed
  FROM d GROUP BY ALL),
r AS (
  SELECT process_name, run_id,
         CASE WHEN total = 0 OR (total - failed)::DOUBLE / total::DOUBLE * 100.0 >= 95
              THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
         total - failed AS successful_record_count, failed AS failed_record_count
  FROM g)"""

ORACLE_SQL: dict[str, str] = {
    "dedup_priority": """
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END, o_orderdate DESC, o_orderkey) = 1""",
    "left_join_chain": """
WITH latest AS (
  SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
    CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END, o_orderdate DESC, o_orderkey) = 1)
SELECT c.c_custkey, c.c_name, l.o_orderkey, l.o_orderstatus, n.n_name, r.r_name,
       l.o_orderkey IS NULL AS no_order
FROM customer c LEFT JOIN latest l ON c.c_custkey = l.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "cte_view": _VIEW_WITH.format(orders="orders"),
    "incremental_view": _VIEW_WITH.format(
        orders="(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')"),
    "param_filter": """
SELECT event_id, user_id, event_type, value FROM events
WHERE lower(event_type) = lower('PURCHASE') AND value >= 25.0""",
    "param_like": """
SELECT event_id, event_type, event_type || ': x''y x''y' AS labelled FROM events
WHERE event_type LIKE '%c%' AND value < 60.0""",
    "template_view": """
SELECT c.c_mktsegment, count(*) AS n_orders, round(sum(b.o_totalprice), 2) AS total
FROM (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000) b
JOIN customer c ON b.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""",
    "mapping_project": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, lower(trim(o_orderstatus)) AS status,
       CAST(round(o_totalprice) AS BIGINT) AS total_rounded, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank
FROM orders""",
    "categorised_project": """
SELECT CAST(1 AS INTEGER) AS dummy_num_column, CAST(user_id AS VARCHAR) AS customerid_user_identities,
       event_type AS category_user_attributes, value AS amount_user_attributes,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k_user_attributes,
       epoch_us(ts) // 1000 AS timestamp_unixtime_ms_app_event_attributes,
       upper(event_type) AS event_type_app_event_attributes, event_id AS category_app_event_attributes
FROM events""",
    "payload_fields": f"""
SELECT event_id, {_RID} AS request_id, 'development' AS environment, CAST(user_id AS VARCHAR) AS customerid,
       event_type AS category, value AS amount, CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k,
       'engagement_plan' AS plan_id, '2' AS plan_version, 'activity' AS event_name,
       'other' AS custom_event_type, upper(event_type) AS event_type, epoch_us(ts) // 1000 AS ts_ms,
       {_RID} AS source_request_id
FROM events""",
    "json_nested": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "nested_payload": """
SELECT event_id, k AS map_k, upper(event_type) AS array_1, k AS variant_k, k AS text_k, NULL::VARCHAR AS text_as_value,
       k AS event_map_k, NULL::VARCHAR AS event_array_as_value, upper(event_type) AS event_array_1
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "epoch_attr": """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events""",
    "bulk_envelopes": f"""
{_RANGES},
n AS (SELECT bucket, event_id,
             CAST((row_number() OVER (PARTITION BY bucket ORDER BY h, event_id) - 1) // 100 AS INTEGER) AS envelope
      FROM e)
SELECT bucket, envelope, count(*) AS n_records, min(event_id) AS first_key, max(event_id) AS last_key
FROM n GROUP BY bucket, envelope""",
    "delivery_outcome": f"""
SELECT request_id, CAST(n_attempts AS INTEGER) AS n_attempts, CAST(status_code AS INTEGER) AS status_code,
       {_REASON.format(s='status_code')} AS reason, status_code IN (200, 202) AS ok
FROM ({_DELIVERED})""",
    "retry_schedule": f"""
WITH d AS ({_DELIVERED}),
a AS (SELECT d.*, t.attempt FROM d JOIN generate_series(1, 2) t(attempt) ON t.attempt < d.n_attempts)
SELECT request_id, CAST(attempt AS INTEGER) AS attempt,
       CAST(CASE WHEN event_id % 100 = 50 THEN 500 ELSE status_code END AS INTEGER) AS status,
       CASE WHEN status_code = 429 AND event_id % 3 > 0 THEN CAST(event_id % 3 AS DOUBLE)
            ELSE least(2.0 * pow(2.0, attempt), 60.0) END AS wait_s
FROM a""",
    "dead_letters": f"""
SELECT request_id AS source_request_id, CAST(20240101000000000 AS BIGINT) AS run_id,
       CAST(status_code AS INTEGER) AS status_code, {_REASON.format(s='status_code')} AS failed_reason,
       CAST(user_id AS VARCHAR) AS customerid, 'activity' AS event_name
FROM ({_DELIVERED}) WHERE status_code NOT IN (200, 202)""",
    "replay": f"""
SELECT sha256('20240102000000000|' || request_id) AS request_id, request_id AS replayed_request_id,
       CAST(status_code AS INTEGER) AS previous_status, CAST(user_id AS VARCHAR) AS customerid
FROM ({_DELIVERED}) WHERE status_code IN (500, 999)""",
    "bulk_delivery": f"""
{_RANGES},
n AS (SELECT *, CAST((row_number() OVER (PARTITION BY bucket ORDER BY h, event_id) - 1) // 100 AS INTEGER)
                AS envelope
      FROM e)
SELECT sha256('20240101000000000|' || CAST(event_id AS VARCHAR)) AS request_id,
       sha256('20240101000000000|' || CAST(bucket AS VARCHAR) || '|' || CAST(envelope AS VARCHAR))
         AS envelope_request_id,
       CAST(CASE WHEN (bucket + envelope) % 5 = 0 THEN 3 ELSE 1 END AS INTEGER) AS n_attempts,
       CAST(CASE WHEN (bucket + envelope) % 5 = 0 THEN 500 ELSE 202 END AS INTEGER) AS status_code,
       (bucket + envelope) % 5 <> 0 AS ok,
       CASE WHEN (bucket + envelope) % 5 = 0 THEN CAST(user_id AS VARCHAR) END AS customerid
FROM n""",
    "canary_split": """
SELECT event_id, user_id, event_id = (SELECT min(event_id) FROM events) AS is_canary FROM events""",
    "threshold": f"""
WITH d AS ({_DELIVERED}),
g AS (SELECT event_type, count(*) AS total,
             sum(CASE WHEN status_code IN (200, 202) THEN 0 ELSE 1 END) AS failed
      FROM d GROUP BY event_type)
SELECT event_type, CAST(95 AS INTEGER) AS threshold_percentage, total AS total_records_processed,
       total - failed AS successful_record_count, failed AS failed_record_count,
       round((total - failed)::DOUBLE / total::DOUBLE * 100.0, 6) AS success_pct,
       CASE WHEN (total - failed)::DOUBLE / total::DOUBLE * 100.0 >= 95 THEN 'SUCCEEDED' ELSE 'FAILED' END
         AS status,
       CASE WHEN (total - failed)::DOUBLE / total::DOUBLE * 100.0 >= 95 THEN NULL
            ELSE 'Threshold percentage is not met' END AS failure_reason
FROM g""",
    "latest_run": _RUNS + """
SELECT process_name, run_id, status, successful_record_count, failed_record_count,
       CASE WHEN status = 'FAILED' THEN 'Threshold percentage is not met' END AS failure_reason
FROM r""",
    "run_rollup": _RUNS + """
SELECT process_name, bool_or(status = 'FAILED') AS any_failed, count(*) AS n_runs,
       count(*) FILTER (WHERE status = 'SUCCEEDED') AS n_succeeded,
       count(*) FILTER (WHERE status = 'FAILED') AS n_failed,
       count(*) FILTER (WHERE status = 'STARTED') AS n_running
FROM r GROUP BY process_name""",
    "change_feed": _SNAPSHOTS + """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, 'DELETE' AS action,
       n.o_orderkey IS NOT NULL AS is_update
FROM old o LEFT JOIN new n ON o.o_orderkey = n.o_orderkey
WHERE n.o_orderkey IS NULL OR o.o_custkey IS DISTINCT FROM n.o_custkey
   OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice
   OR o.o_orderdate IS DISTINCT FROM n.o_orderdate
UNION ALL
SELECT n.o_orderkey, n.o_custkey, n.o_orderstatus, n.o_totalprice, n.o_orderdate, 'INSERT' AS action,
       o.o_orderkey IS NOT NULL AS is_update
FROM new n LEFT JOIN old o ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR o.o_custkey IS DISTINCT FROM n.o_custkey
   OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice
   OR o.o_orderdate IS DISTINCT FROM n.o_orderdate""",
    "upsert": _SNAPSHOTS + """
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_custkey ELSE o.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderdate ELSE o.o_orderdate END AS o_orderdate,
       coalesce(o.o_orderdate, TIMESTAMP '2001-09-01') AS first_seen
FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey""",
    "backfill": """
SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'""",
    "append_stream": """
SELECT event_id, ts, user_id, event_type, value, props FROM events""",
    "exists_flag": """
SELECT c_custkey, c_name, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) AS has_order
FROM customer c""",
    "duplicate_keys": """
SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
    "table_sink": """
SELECT lower(event_type) AS event_type, count(*) AS n_rows, round(sum(value), 2) AS total_value
FROM events GROUP BY 1""",
    "process_run": f"""
WITH d AS ({_DELIVERED}),
g AS (SELECT count(*) AS total, sum(CASE WHEN status_code IN (200, 202) THEN 0 ELSE 1 END) AS failed FROM d)
SELECT 'events_feed' AS process_name, CAST(20240101000000000 AS BIGINT) AS run_id,
       CASE WHEN (total - failed)::DOUBLE / total::DOUBLE * 100.0 >= 95 THEN 'SUCCEEDED' ELSE 'FAILED' END
         AS status,
       total - failed AS successful_record_count, failed AS failed_record_count,
       CASE WHEN (total - failed)::DOUBLE / total::DOUBLE * 100.0 >= 95 THEN NULL
            ELSE 'Threshold percentage is not met' END AS failure_reason,
       total AS engage_rows, total AS archive_rows
FROM g""",
    "process_incremental": """
SELECT c_custkey AS customer_key, c_name AS customer_name, upper(n_name) AS nation, n_orders, round(total, 2) AS total
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
  ON c_custkey = o_custkey""",
    "file_sink": """
SELECT lower(event_type) AS event_type, count(*) AS n_rows, round(sum(value), 2) AS total_value
FROM events GROUP BY 1""",
}

ORACLE_SQL["change_feed_stream"] = ORACLE_SQL["change_feed"]
