"""Keyed upsert without UPDATE/MERGE (K6).

Parquet tables refuse ``UPDATE`` and ``MERGE``. The new state is computed as a
DataFrame — new rows win, old rows without a new version are kept, and
columns that record creation keep their old value — and written to a *new*
version location (never reading and overwriting the same path). One full
outer join on the key does it: a single shuffle of each side. Keys are compared
null-safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str],
           keep_from_old: list[str] | None = None) -> DataFrame:
    keep_from_old = keep_from_old or []
    cols = [c for c in old.columns if c not in keys]

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_{tag}k{i}") for i, k in enumerate(keys)],
                         F.struct(F.lit(True).alias("_there"), *[c for c in df.columns if c not in keys]).alias(f"_{tag}"))

    on = reduce(lambda a, b: a & b,
                [F.col(f"_ok{i}").eqNullSafe(F.col(f"_nk{i}")) for i in range(len(keys))])
    j = side(old, "o").join(side(new, "n"), on, "full_outer")
    has_old, has_new = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    out = [F.when(has_new, F.col(f"_nk{i}")).otherwise(F.col(f"_ok{i}")).alias(k) for i, k in enumerate(keys)]
    for c in cols:
        if c in keep_from_old:
            out.append(F.when(has_old & F.col(f"_o.{c}").isNotNull(), F.col(f"_o.{c}"))
                       .otherwise(F.col(f"_n.{c}")).alias(c))
        else:
            out.append(F.when(has_new, F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")).alias(c))
    return j.select(*out)
