"""Configuration checks and pipeline compilation.

All of it is DataFrame work over the configuration tables, for every process
of a deploy batch at once: lookups are joins (not one query per lookup),
violations are rows (not the first exception), and the pipeline document is
an aggregate per process.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions.scalars import name_part_count, strip_dollar
from tablewright.operators.mapping import DUMMY_COLUMN
from tablewright.schemas import QUERY_ORDER_CONFIG, QUERY_TEMPLATE_CONFIG, QUERY_VIEW_CONFIG

# Target kinds, required target properties, step numbering.
TARGET_KINDS = {"endpoint": "deliver", "table": "table_sink", "files": "file_sink"}
REQUIRED_PROPERTIES = ["plan_id", "event_name", "fail_rec_table_name"]
STEP_GAP = 100


def duplicate_keys(df: DataFrame, keys: list[str], case_insensitive: bool = True) -> DataFrame:
    """A2: keys that occur more than once (text keys compared lower-cased).
    A hash aggregate with partial counts before the shuffle, so a hot key
    costs one row per map partition."""
    dtypes = dict(df.dtypes)
    cols = [F.lower(k).alias(k) if case_insensitive and dtypes[k] == "string" else F.col(k)
            for k in keys]
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def _lkey(c: str) -> Column:
    return F.lower(F.col(c))


def lookup_config(object_attr: DataFrame, target_attr: DataFrame, column_attr: DataFrame) -> DataFrame:
    """Process → its targets → their properties and mapping rows in one
    plan. Left joins keep targets without properties or mappings, flagged."""
    targets = object_attr.select(
        _lkey("process_name").alias("process"), F.explode_outer("target_name_list").alias("target", "kind"))
    props = target_attr.select(_lkey("process_name").alias("process"),
                               _lkey("target_name").alias("target"), "target_properties")
    cols = (column_attr.where(F.col("target_column_name").isNotNull())
            .groupBy(_lkey("process_name").alias("process"), _lkey("target_name").alias("target"))
            .agg(F.count(F.lit(1)).alias("n_columns")))
    t = targets.withColumn("target", F.lower("target"))
    # No broadcast hints: configuration tables have no proven size bound, so
    # Spark's size estimate (and AQE at run time) picks the join.
    return (t.join(props, ["process", "target"], "left")
             .join(cols, ["process", "target"], "left")
             .select("process", "target", F.lower("kind").alias("kind"), "target_properties",
                     F.coalesce("n_columns", F.lit(0)).alias("n_columns"),
                     F.col("target_properties").isNull().alias("missing_properties"),
                     F.col("n_columns").isNull().alias("missing_mapping")))


def property_violations(target_attr: DataFrame) -> DataFrame:
    """Required property keys (any case) that are missing, per target."""
    keys = F.transform(F.map_keys(F.coalesce("target_properties", F.create_map().cast("map<string,string>"))),
                       lambda k: F.lower(k))
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED_PROPERTIES]), keys)
    return (target_attr.select(_lkey("process_name").alias("process"), _lkey("target_name").alias("target"),
                               missing.alias("missing_keys"))
                       .where(F.size("missing_keys") > 0))


def qualify_fail_table(props: Column, database: Column, schema: Column) -> Column:
    """A dead-letter table name without database and schema gets the
    process's; values of other keys are unchanged."""
    return F.transform_values(props, lambda k, v: F.when(
        (F.lower(k) == "fail_rec_table_name") & (name_part_count(v) != 3),
        F.concat_ws(".", database, schema, F.element_at(F.split(v, r"\."), -1))).otherwise(v))


def config_violations(object_attr: DataFrame, target_attr: DataFrame, column_attr: DataFrame,
                      query_view: DataFrame | None = None) -> DataFrame:
    """N7 (with A2, N5): every rule broken by every process as one row
    ``(process, target, rule)``; nothing stops at the first error."""
    o = object_attr
    inc = F.coalesce(F.col("incremental_capture_flag"), F.lit(False))
    kind = F.lower("object_type")
    obj_rules = F.array_compact(F.array(
        F.when(~kind.isin("table", "view") | kind.isNull(), F.lit("object type is neither table nor view")),
        F.when(inc & (kind == "view") & F.col("primary_table").isNull(),
               F.lit("incremental view without primary table")),
        F.when(inc & F.col("stream_name").isNull(), F.lit("stream name missing")),
        F.when(inc & F.col("stream_name").isNotNull() & (name_part_count("stream_name") != 3),
               F.lit("stream name is not database.schema.name")),
        F.when(inc & F.col("transient_stg_table").isNull(), F.lit("staging table name missing")),
        F.when(inc & F.col("transient_stg_table").isNotNull() & (name_part_count("transient_stg_table") != 3),
               F.lit("staging table name is not database.schema.name")),
        F.when(F.coalesce(F.size("target_name_list"), F.lit(0)) <= 0, F.lit("target list is empty")),
    ))
    v_obj = o.select(_lkey("process_name").alias("process"), F.lit(None).cast("string").alias("target"),
                     F.explode(obj_rules).alias("rule"))
    v_dup = duplicate_keys(o.select("process_name"), ["process_name"]).select(
        F.col("process_name").alias("process"), F.lit(None).cast("string").alias("target"),
        F.lit("duplicate process").alias("rule"))
    lk = lookup_config(o, target_attr, column_attr)
    t_rules = F.array_compact(F.array(
        F.when(~F.col("kind").isin(*TARGET_KINDS), F.lit("unknown target kind")),
        F.when(F.col("missing_mapping"), F.lit("no column mapping")),
        F.when((F.col("kind") == "endpoint") & F.col("missing_properties"), F.lit("target properties missing")),
    ))
    v_tgt = lk.where(F.col("target").isNotNull()).select("process", "target", F.explode(t_rules).alias("rule"))
    v_prop = (property_violations(target_attr)
              .join(lk.where(F.col("kind") == "endpoint").select("process", "target"), ["process", "target"])
              .select("process", "target",
                      F.concat(F.lit("missing properties: "), F.array_join("missing_keys", ",")).alias("rule")))
    cat = (column_attr.where(F.col("target_column_name").isNotNull() & F.col("object_category").isNull())
           .select(_lkey("process_name").alias("process"), _lkey("target_name").alias("target"))
           .join(lk.where(F.col("kind") == "endpoint").select("process", "target"), ["process", "target"])
           .distinct().select("process", "target", F.lit("object category missing").alias("rule")))
    out = v_obj.unionByName(v_dup).unionByName(v_tgt).unionByName(v_prop).unionByName(cat)
    if query_view is not None:
        views = o.where(kind == "view").select(_lkey("process_name").alias("process"),
                                               _lkey("object_name").alias("view"))
        qv = query_view.select(_lkey("view_name").alias("view"),
                               (F.col("query").isNull() & F.col("query_template_name").isNull()).alias("empty"))
        out = out.unionByName(
            views.join(qv, "view", "left")
                 .where(F.coalesce("empty", F.lit(True)))
                 .select("process", F.lit(None).cast("string").alias("target"),
                         F.lit("view has neither query nor template").alias("rule")))
    return out


def _step(order: int, func: str, **args: Column) -> Column:
    return F.struct(F.lit(order).alias("phase"), F.lit(func).alias("func"),
                    F.create_map(*[x for k, v in sorted(args.items()) for x in (F.lit(k), v.cast("string"))])
                    .alias("args"))


def _view_documents(query_view: DataFrame, query_order: DataFrame | None, templates: DataFrame | None) -> DataFrame:
    """Per view (lower-cased name) its configuration rows as one JSON text, so
    that later changes of the tables do not reach a deployed pipeline. All
    templates go with it: a template may name another one."""
    def rows(df: DataFrame, cols: list[str], by: list[Column]) -> DataFrame:
        return df.groupBy(*by).agg(F.collect_list(F.struct(*cols)).alias("rows"))

    out = rows(query_view, QUERY_VIEW_CONFIG.fieldNames(), [_lkey("view_name").alias("view")]) \
        .withColumnRenamed("rows", "query_view")
    if query_order is not None:
        out = out.join(rows(query_order, QUERY_ORDER_CONFIG.fieldNames(), [_lkey("view_name").alias("view")])
                       .withColumnRenamed("rows", "query_order"), "view", "left")
    if templates is not None:  # one row: the aggregate of the template table
        one = rows(templates, QUERY_TEMPLATE_CONFIG.fieldNames(), [F.lit(1).alias("one")])
        out = out.withColumn("one", F.lit(1)).join(one.withColumnRenamed("rows", "templates"), "one", "left").drop("one")
    return out.select("view", F.to_json(F.struct(*[c for c in out.columns if c != "view"])).alias("view_config"))


def _mapped(column_attr: DataFrame, kinds: DataFrame) -> DataFrame:
    """P2-P4 in the document: projection and category map per (process, target).
    The target's kind decides: endpoints get the constant column and aliases
    with the category, all others the plain target names."""
    rows = (column_attr.where(F.col("target_column_name").isNotNull())
            .withColumn("process", _lkey("process_name")).withColumn("target", _lkey("target_name"))
            .join(kinds, ["process", "target"])
            .withColumn("category", F.when(F.col("kind") == "endpoint", _lkey("object_category")))
            .withColumn("alias", F.when(F.col("category").isNotNull(),
                                        F.concat(strip_dollar("target_column_name"), F.lit("_"), F.col("category")))
                                  .otherwise(F.col("target_column_name"))))
    expr = F.concat(F.coalesce("transform_rule", "column_name"), F.lit(" AS `"), F.col("alias"), F.lit("`"))
    constant = F.when(F.col("kind") == "endpoint", F.array(F.lit(DUMMY_COLUMN))) \
        .otherwise(F.array().cast("array<string>"))
    exprs = (rows.groupBy("process", "target", "kind").agg(F.array_sort(F.collect_list(expr)).alias("exprs"))
             .select("process", "target", F.concat(constant, "exprs").alias("select_exp")))
    cmap = (rows.where(F.col("category").isNotNull()).groupBy("process", "target", "category")
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("alias", "target_column_name")))).alias("m"))
            .groupBy("process", "target")
            .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("category", "m")))).alias("column_mapping")))
    return exprs.join(cmap, ["process", "target"], "left")


def compile_pipelines(object_attr: DataFrame, target_attr: DataFrame, column_attr: DataFrame,
                      query_view: DataFrame | None = None, query_order: DataFrame | None = None,
                      templates: DataFrame | None = None) -> DataFrame:
    """One pipeline document per process. Steps in fixed order: consume
    stream (incremental), create view (view), extract, one per target, drop
    staging (incremental); numbered 100, 200, ... Returns ``process_name,
    steps (array<struct>), pipeline_config (JSON text)``. With ``query_view`` the
    document carries the view's configuration as it is now."""
    o = object_attr.withColumn("process", _lkey("process_name"))
    if query_view is not None:
        o = o.join(_view_documents(query_view, query_order, templates), _lkey("object_name") == F.col("view"), "left")
    else:
        o = o.withColumn("view_config", F.lit(None).cast("string"))
    inc = F.coalesce(F.col("incremental_capture_flag"), F.lit(False))
    is_view = F.lower("object_type") == "view"
    # The staged delta is bound under the staging table's short name.
    source = F.when(is_view | ~inc, F.col("object_name")).otherwise(
        F.element_at(F.split("transient_stg_table", r"\."), -1))
    fixed = o.select("process", F.explode(F.array_compact(F.array(
        F.when(inc, _step(1, "consume_stream", stream_name=F.col("stream_name"),
                          transient_table=F.col("transient_stg_table"))),
        F.when(is_view, _step(2, "create_view", view_name=F.col("object_name"),
                                view_config=F.col("view_config"))),
        _step(3, "sql", query=F.concat(F.lit("select * from "), source),
              output_df=F.concat(F.col("object_name"), F.lit("_df"))),
        F.when(inc, _step(5, "drop_staging", name=F.col("transient_stg_table"))),
    ))).alias("s")).select("process", F.col("s.phase").alias("phase"), F.lit("").alias("target"),
                           F.col("s.func").alias("func"), F.col("s.args").alias("args"))
    kinds = o.select("process", F.explode("target_name_list").alias("target", "kind")).select(
        "process", F.lower("target").alias("target"), F.lower("kind").alias("kind"))
    mapped = _mapped(column_attr, kinds)
    props = target_attr.select(_lkey("process_name").alias("process"), _lkey("target_name").alias("target"),
                               "target_properties")
    targets = (o.select("process", "object_name", "database_name", "schema_name",
                        F.explode("target_name_list").alias("target", "kind"))
                .withColumn("target", F.lower("target"))
                .join(props, ["process", "target"], "left")
                .join(mapped, ["process", "target"], "left")
                .select("process", F.lit(4).alias("phase"), "target",
                        F.coalesce(F.element_at(F.create_map(*[x for k, v in TARGET_KINDS.items()
                                                               for x in (F.lit(k), F.lit(v))]),
                                                F.lower("kind")), F.lit("unknown")).alias("func"),
                        F.create_map(F.lit("input_df"), F.concat(F.col("object_name"), F.lit("_df")),
                                     F.lit("target"), F.col("target"),
                                     F.lit("select_exp"), F.to_json("select_exp"),
                                     F.lit("properties"), F.to_json(qualify_fail_table(
                                         F.col("target_properties"), F.col("database_name"),
                                         F.col("schema_name"))),
                                     F.lit("column_mapping"), F.col("column_mapping")).alias("args")))
    steps = fixed.unionByName(targets)
    w = Window.partitionBy("process").orderBy("phase", "target")
    numbered = steps.withColumn("step_id", F.row_number().over(w) * STEP_GAP)
    return (numbered.groupBy("process")
                    .agg(F.array_sort(F.collect_list(F.struct("step_id", "func", "args")),
                                      lambda a, b: (a["step_id"] - b["step_id"]).cast("int")).alias("steps"))
                    .select(F.col("process").alias("process_name"), "steps",
                            F.to_json(F.struct(F.col("process").alias("pipeline_name"),
                                               F.col("steps").alias("data_flow"))).alias("pipeline_config")))


def remaining_steps(pipelines: DataFrame, restart_step_id: int | None) -> DataFrame:
    """the steps of each pipeline from ``restart_step_id`` on (compared
    as integers); all steps when none is given."""
    steps = pipelines.select("process_name", F.explode("steps").alias("s")).select("process_name", "s.*")
    if restart_step_id is None:
        return steps
    return steps.where(F.col("step_id").cast("int") >= F.lit(int(restart_step_id)))
