"""Keep one row per key by a priority order.

``QUALIFY row_number() OVER (...) = 1`` is written as a row number and a
filter. Spark plans this with ``WindowGroupLimit`` twice: a *partial* limit
before the shuffle keeps at most one row per key per input partition, so a hot
key (even a third of all rows) is cut down map-side before it is shuffled, and
a final limit after it. The caller passes a unique tie-breaker last so the
kept row is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def priority(col, values: list) -> Column:
    """``CASE col WHEN v1 THEN 1 WHEN v2 THEN 2 ... ELSE n+1 END``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, v in enumerate(values, start=1):
        expr = F.when(c == F.lit(v), i) if expr is None else expr.when(c == F.lit(v), i)
    return expr.otherwise(len(values) + 1)


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_keep_rn", F.row_number().over(w))
              .where(F.col("_keep_rn") == 1).drop("_keep_rn"))
