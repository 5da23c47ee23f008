"""Table-driven projections (P1–P5) and the category map (A5).

The mapping table ``column_attr`` holds, per (process, target), one row per
output column: a source column, an optional SQL transform rule, the target
column name and (for document targets) an object category. The tiny set of
rows for one target is turned into ``selectExpr`` text; the data itself is
projected by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.scalars import strip_dollar

DUMMY_COLUMN = "cast(1 as integer) AS dummy_num_column"


def mapping_rows(column_attr: DataFrame, process: str, target: str) -> DataFrame:
    """Rows of one (process, target), matched case-insensitively (F1)."""
    return (column_attr
            .where(F.lower("process_name") == F.lower(F.lit(process)))
            .where(F.lower("target_name") == F.lower(F.lit(target))))


def _alias(categorised: bool):
    if categorised:
        return F.concat(strip_dollar("target_column_name"), F.lit("_"),
                        F.lower("object_category"))
    return F.col("target_column_name")


def mapping_spec(column_attr: DataFrame, process: str, target: str,
                 categorised: bool = False) -> tuple[list[str], dict]:
    """The projection and the category map of one target from a single
    collect of its (few) mapping rows.

    Projection: ``transform_rule AS alias`` (or the plain column when the
    rule is null); rows without a target column are skipped; none at all is
    an error. Categorised targets get the constant column first, aliases
    ``<target without $>_<category>``, and a null category is an error.
    Category map: category → {alias → target column}."""
    rows = (mapping_rows(column_attr, process, target)
            .select("column_name", "transform_rule", "target_column_name",
                    F.lower("object_category").alias("category"),
                    _alias(categorised).alias("alias"))
            .collect())
    if not rows:
        raise ValueError(f"no column mapping for process {process}, target {target}")
    rows = [r for r in rows if r.target_column_name is not None]
    if categorised and any(r.category is None for r in rows):
        raise ValueError(f"object category missing in the mapping of {process}/{target}")
    # Sorted by alias: the configuration table defines no order.
    rows.sort(key=lambda r: r.alias)
    exprs = [f"{r.transform_rule or r.column_name} AS `{r.alias}`" for r in rows]
    cmap: dict[str, dict] = {}
    for r in rows:
        if r.category is not None:
            cmap.setdefault(r.category, {})[r.alias] = r.target_column_name
    return ([DUMMY_COLUMN] if categorised else []) + exprs, cmap


def select_exprs(column_attr: DataFrame, process: str, target: str,
                 categorised: bool = False) -> list[str]:
    return mapping_spec(column_attr, process, target, categorised)[0]


def map_columns(df: DataFrame, column_attr: DataFrame, process: str, target: str,
                categorised: bool = False) -> DataFrame:
    return df.selectExpr(*select_exprs(column_attr, process, target, categorised))


def category_map(column_attr: DataFrame) -> DataFrame:
    """Per (process, target, category): ``map(alias → target column)``."""
    rows = column_attr.where(F.col("target_column_name").isNotNull()
                             & F.col("object_category").isNotNull())
    return (rows.groupBy(F.lower("process_name").alias("process_name"),
                         F.lower("target_name").alias("target_name"),
                         F.lower("object_category").alias("category"))
                .agg(F.map_from_entries(F.array_sort(F.collect_list(
                    F.struct(_alias(True).alias("alias"),
                             F.col("target_column_name").alias("target"))))).alias("mapping")))


def category_map_dict(column_attr: DataFrame, process: str, target: str) -> dict:
    """The category map of one target as a driver dict (configuration only)."""
    return mapping_spec(column_attr, process, target, categorised=True)[1]
