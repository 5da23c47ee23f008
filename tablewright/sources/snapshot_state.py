"""Bucketed state of a table for change capture.

The state holds every row once, as (bucket, two 64-bit row hashes, number of
equal rows, image), in versions that are only ever added: a capture appends the
rows that came (``n`` > 0, with image) and went (``n`` < 0, without). The rows of
the table are the sums of ``n``. Rows of a bucket are spread by their own hash,
so a key that holds a third of all rows is spread, too, and repeated or null keys
need no special case.

A capture compares digests per bucket first (count and sums of the row hashes,
an aggregation with a few thousand groups and no shuffle of rows). Only rows of
buckets that differ are compared, by hash, in one aggregation; only changed rows
are fetched, inserted ones from the table and deleted ones from the state. What
did not change is neither shuffled nor written.

After ``MERGE_AFTER`` versions they are folded: into one delta, or, when the
deltas have grown as large as the base, into a new base.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, MapType, StructField, StructType, VariantType

MERGE_AFTER = 20
ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS, MOST_BUCKETS = 16, 4096
DIGEST = "bucket int, rows long, s1 decimal(38,0), s2 decimal(38,0), buckets int"


def row_hashes(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Two 64-bit hashes of the given columns. Nulls are marked, since a null
    alone leaves a hash as it is; nested values go in as JSON text."""
    parts: list[Column] = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            c = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
        parts += [F.col(f"`{f.name}`").isNull(), c]
    return [F.xxhash64(F.lit(k), *parts) for k in (1, 2)]


def bucket_count(rows: int) -> int:
    """A power of two that follows the size of the table at its first capture."""
    wanted = -(-rows // ROWS_PER_BUCKET)
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, wanted - 1).bit_length()))


class SnapshotState:
    """The state under ``root``; ``live`` are its folders that count (a base, a
    merged delta, single versions), as the caller's log knows them."""

    def __init__(self, spark: SparkSession, root: str, source: DataFrame, keys: list[str], live: list[str],
                 digests: str | None):
        self.spark, self.root, self.source, self.keys, self.live = spark, root, source, keys, live
        self.schema = StructType([StructField("h1", LongType()), StructField("h2", LongType()),
                                  StructField("n", LongType()), StructField("img", source.schema),
                                  StructField("bucket", IntegerType())])
        self.old = spark.read.schema(DIGEST).parquet(f"{root}/{digests}") if digests else None
        first = self.old.select("buckets").first() if digests else None
        self.buckets = first[0] if first else bucket_count(source.count())

    def rows(self, folders: list[str] | None = None) -> DataFrame:
        folders = self.live if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        each = [self.spark.read.schema(self.schema).parquet(f"{self.root}/{f}") for f in folders]
        return reduce(DataFrame.unionByName, each)

    def current(self) -> DataFrame:
        """The table with its row hashes and bucket."""
        h1, h2 = row_hashes(self.source)
        return self.source.select(F.struct(*[f"`{c}`" for c in self.source.columns]).alias("img"), h1.alias("h1"), h2.alias("h2")) \
            .withColumn("bucket", F.pmod("h1", F.lit(self.buckets)).cast("int"))

    def digest(self) -> DataFrame:
        wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
        return self.current().groupBy("bucket").agg(
            F.count(F.lit(1)).alias("rows"), wide("h1").cast("decimal(38,0)").alias("s1"),
            wide("h2").cast("decimal(38,0)").alias("s2")).withColumn("buckets", F.lit(self.buckets))

    def changed_buckets(self, new: DataFrame) -> list[int]:
        """Buckets whose digest differs; at most ``MOST_BUCKETS`` numbers."""
        if self.old is None:
            return [r[0] for r in new.select("bucket").collect()]
        both = new.select("bucket", "rows", "s1", "s2").withColumn("side", F.lit(1)).unionByName(
            self.old.select("bucket", "rows", "s1", "s2").withColumn("side", F.lit(-1)))
        return [r[0] for r in both.groupBy("bucket", "rows", "s1", "s2").agg(F.sum("side").alias("d"))
                .where("d <> 0").select("bucket").distinct().collect()]

    def changes(self, buckets: list[int]) -> DataFrame:
        """h1, h2, bucket, d: by how many rows each row hash came or went."""
        keep = F.col("bucket").isin(buckets)
        old = self.rows().where(keep).select("h1", "h2", "bucket", (-F.col("n")).alias("n"))
        new = self.current().where(keep).select("h1", "h2", "bucket", F.lit(1).cast("long").alias("n"))
        return old.unionByName(new).groupBy("h1", "h2", "bucket").agg(F.sum("n").alias("d")).where("d <> 0")

    def images(self, changes: DataFrame, buckets: list[int]) -> DataFrame:
        """h1, h2, bucket, n, img of every changed row hash: from the table if
        rows came, from the state if rows went."""
        keep = F.col("bucket").isin(buckets)
        came = self.current().where(keep).join(changes.where("d > 0").drop("bucket"), ["h1", "h2"])
        went = self.rows().where(keep & (F.col("n") > 0)).drop("n").join(changes.where("d < 0").drop("bucket"), ["h1", "h2"])
        cols = ["h1", "h2", "bucket", "d", "img"]
        return came.select(*cols).unionByName(went.select(*cols)).groupBy("h1", "h2", "bucket", F.col("d").alias("n")) \
            .agg(F.first("img").alias("img"))

    def write(self, images: DataFrame, folder: str) -> None:
        """Append the changes as a version; rows that went need no image."""
        img = F.when(F.col("n") > 0, F.col("img")).alias("img")
        images.select("h1", "h2", "n", img, "bucket").repartition("bucket").write.mode("overwrite") \
            .partitionBy("bucket").parquet(f"{self.root}/{folder}")

    def feed(self, images: DataFrame) -> DataFrame:
        """The change feed: the table's columns, action, is_update."""
        k1, k2 = row_hashes(self.source, self.keys)
        n = F.col("_tw_n")
        each = images.select("img.*", F.col("n").alias("_tw_n")).select("*", k1.alias("_tw_k1"), k2.alias("_tw_k2"))
        sides = each.groupBy("_tw_k1", "_tw_k2").agg((F.bool_or(n > 0) & F.bool_or(n < 0)).alias("is_update"))
        copies = F.sequence(F.lit(1).cast("long"), F.abs(n))
        return each.join(sides, ["_tw_k1", "_tw_k2"]).withColumn("_tw_copy", F.explode(copies)).select(
            *[f"`{c}`" for c in self.source.columns], F.when(n > 0, "INSERT").otherwise("DELETE").alias("action"),
            "is_update")

    def fold(self, folders: list[str], folder: str) -> None:
        """One folder for many: sums of ``n``, and any image."""
        self.rows(folders).groupBy("h1", "h2", "bucket").agg(
            F.sum("n").alias("n"), F.first("img", ignorenulls=True).alias("img")).where("n <> 0") \
            .select("h1", "h2", "n", "img", "bucket").repartition("bucket").write.mode("overwrite") \
            .partitionBy("bucket").parquet(f"{self.root}/{folder}")
