"""Joins of the integration views.

Spark picks the physical join; with AQE a shuffle join whose side turns out
small at run time becomes a broadcast, and skewed partitions are split, so
no side carries a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def left_chain(base: DataFrame, steps: list[tuple[DataFrame, object]]) -> DataFrame:
    """Successive left outer joins; each step has its own condition or key
    list, so keys may differ per join."""
    out = base
    for other, on in steps:
        out = out.join(other, on=on, how="left")
    return out


def split_exists(left: DataFrame, right: DataFrame, on) -> tuple[DataFrame, DataFrame]:
    """(rows of ``left`` with a match in ``right``, rows without)."""
    return left.join(right, on=on, how="left_semi"), left.join(right, on=on, how="left_anti")


def flag_exists(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """``left`` with a boolean column saying whether the key exists in
    ``right``: one pass over ``left``; ``right`` is reduced to distinct keys
    (partially aggregated before its shuffle)."""
    r = right.select(*keys).distinct().withColumn(flag, F.lit(True))
    return (left.join(r, on=keys, how="left")
                .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))
