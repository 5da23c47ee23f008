"""Views assembled from configuration (S4), templates (F4), run-time
parameters (F3) and the incremental delta bound by name (S5).

A view is one final query preceded by named sub-queries in
``execution_sequence`` order. Each sub-query becomes a temporary view, so later
ones (and the final query) refer to earlier ones by name; Catalyst inlines
them all into one plan. Only configuration rows are collected to the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.params import bind_sql, replace_template_refs, template_refs


def _rows_for(cfg: DataFrame, key: str, value: str):
    return cfg.where(F.lower(F.col(key)) == F.lower(F.lit(value)))


def _template_text(templates, name, cache):
    """Template texts, collected once per view build (configuration only)."""
    if "_all" not in cache:
        cache["_all"] = {} if templates is None else {
            r[0].lower(): r[1] for r in templates.select("query_template_name", "query_template").collect()}
    text = cache["_all"].get(name.lower())
    if text is None:
        raise ValueError(f"query template '{name}' is not configured")
    return text


def _template_views(spark, text, params, templates, done):
    """Register every template the text refers to; returns name → view."""
    names = {}
    for name in template_refs(text):
        # one view per template and bound values: two uses with different
        # parameters are two views
        bound = (name, hashlib.md5(repr(sorted((params or {}).items())).encode()).hexdigest()[:10])
        if bound in done:
            names[name] = done[bound]
            continue
        inner = _template_text(templates, name, done.setdefault("_texts", {}))
        inner_names = _template_views(spark, inner, params, templates, done)
        view = f"tpl_{name}_{bound[1]}"
        bind_sql(spark, replace_template_refs(inner, inner_names), params).createOrReplaceTempView(view)
        done[bound] = names[name] = view
    return names


def _resolve(spark, query, template_name, params, templates, done, what):
    if query:
        text = query
    elif template_name:
        text = "select * from t{{" + template_name + "}}"
    else:
        raise ValueError(f"{what}: neither query nor query template is configured")
    names = _template_views(spark, text, params, templates, done)
    return bind_sql(spark, replace_template_refs(text, names), params)


def build_view(spark: SparkSession, view_name: str, query_view: DataFrame,
               query_order: DataFrame | None = None,
               templates: DataFrame | None = None,
               args: dict | None = None) -> DataFrame:
    """Create (or replace) the temporary view ``view_name`` from configuration
    and return it. Run-time ``args`` override configured parameters."""
    rows = _rows_for(query_view, "view_name", view_name).collect()
    if len(rows) != 1:
        raise ValueError(f"view {view_name} has {len(rows)} rows in query_view_config")
    view = rows[0].asDict()
    done: dict[str, str] = {}
    if query_order is not None:
        steps = (_rows_for(query_order, "view_name", view_name)
                 .orderBy("execution_sequence").collect())
        for step in steps:
            s = step.asDict()
            params = {**(s.get("parameters") or {}), **(args or {})}
            df = _resolve(spark, s.get("query"), s.get("query_template_name"), params,
                          templates, done, f"{view_name} step {s.get('execution_sequence')}")
            df.createOrReplaceTempView(s["temp_table"])
    params = {**(view.get("parameters") or {}), **(args or {})}
    final = _resolve(spark, view.get("query"), view.get("query_template_name"), params,
                     templates, done, view_name)
    final.createOrReplaceTempView(view_name)
    return spark.table(view_name)


def register_tables(spark: SparkSession, tables: dict[str, str]) -> SparkSession:
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return spark


def child_session(spark: SparkSession) -> SparkSession:
    """A new session (own temporary views) with the parent's run-time SQL
    settings — time zone, ANSI mode, shuffle partitions, ... — which a bare
    ``newSession()`` would reset to the defaults."""
    child = spark.newSession()
    try:
        settings = spark.conf.getAll
        items = settings.items() if isinstance(settings, dict) else settings
    except Exception:
        items = []
    for key, value in items:
        if key.startswith("spark.sql.") and value is not None:
            try:
                if spark.conf.isModifiable(key):
                    child.conf.set(key, value)
            except Exception:
                pass
    return child


def with_delta(spark: SparkSession, staged_path: str, primary_table: str,
               tables: dict[str, str] | None = None) -> SparkSession:
    """A child session in which ``primary_table`` names the staged delta.

    The name is bound, never rewritten in the query text. The child has its
    own temporary views, so the parent keeps seeing the full table; the delta
    is re-read from its staged location through the child (a DataFrame of the
    parent cannot be registered in another session)."""
    child = child_session(spark)
    register_tables(child, tables or {})
    child.read.parquet(staged_path).createOrReplaceTempView(primary_table)
    return child
