"""Sharding by histogram sort (operator 8); every law named here is ``bytes``.

Rows get a sort key: (60 bits of the text's md5, 32 bits of the doc_id's md5,
doc_id). Equal texts are neighbours in that order, so a group of copies stays
together unless a splitter must cut it for balance. Shard borders are found by
counting, never by sampling: each round counts the exact bytes below a set of
probe keys in all partitions (one map-side-combined aggregate with a bounded
number of rows), keeps the interval around every border and refines it, until
the border is within ``tolerance`` of its target, or a single key is left.
With tolerance 0 (the default) the result is a pure function of the table.
Only then do rows move, once, and without their text.

Slots: inside a shard, the 4,096 md5 cells hold their exact row counts; a cell
that holds more than its share of rows (a group of copies) is dealt into salted
parts by the doc_id's md5. Row numbers inside parts plus the running total of
the parts give gapless slots; no task numbers a whole shard.

Defined cases: a null text counts 1 byte (size 1) and sorts like an empty one
(but has a null text_crc32); a null doc_id sorts first; fully equal rows tie
and get different slots; an empty table gives an empty result; other columns
of the input never matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import stage

CELL_BITS = 12
_KEY_BITS = 60


def _md5_bits(value: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """Narrow rows: doc_id, size, text_crc32 and the sort key (h, g, doc_id)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.col("text")).alias("text_crc32"), _md5_bits(text, 15).alias("h"),
        _md5_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 8).alias("g")
    ).withColumn("cell", F.shiftright("h", _KEY_BITS - CELL_BITS).cast("int"))


def _key():
    return F.struct("h", "g", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("d"))


def _evenly(lo, hi, n):
    """Up to n keys after ``lo`` and up to ``hi`` (included), by interpolation on
    the first component in which the two ends differ."""
    at = next((i for i in range(3) if lo[i] != hi[i]), None)
    if at is None:
        return [hi]
    span = hi[at] - lo[at]
    top = (1 << 60, 1 << 32, (1 << 63) - 1)
    out = {tuple(lo[:at]) + (lo[at] + span * k // n,) + top[at + 1:] for k in range(n)}
    return sorted(out | {tuple(hi)})


def splitters(rows: DataFrame, shards: int, probes: int = 16, tolerance: float = 0.0) -> list[tuple]:
    """The border keys: shard k holds the keys after border k-1 and up to border
    k. Border k is the first key at which the running bytes reach k/shards of
    all bytes (or any key within ``tolerance`` of a shard's share)."""
    cells = {r["cell"]: r for r in rows.groupBy("cell").agg(
        F.sum("size").alias("b"), F.min(_key()).alias("lo"), F.max(_key()).alias("hi")).collect()}
    total = sum(r["b"] for r in cells.values())
    if not total:
        return []
    slack = tolerance * total / shards
    open_, done = {}, {}
    below = 0
    targets = {k: total * k / shards for k in range(1, shards)}
    for c in sorted(cells):
        r = cells[c]
        for k, t in targets.items():
            if below < t <= below + r["b"]:
                open_[k] = (c, below, tuple(r["lo"]), tuple(r["hi"]))
        below += r["b"]
    spark = rows.sparkSession
    while open_:
        found = {}
        for k, (c, below, lo, hi) in open_.items():
            if lo == hi:
                done[k] = hi
            else:
                found.setdefault((c, lo, hi, below), []).append(k)
        open_ = {}
        if not found:
            break
        spec = [(i, c, lo, hi, _evenly(lo, hi, probes)) for i, (c, lo, hi, _) in enumerate(found)]
        # at most shards-1 rows: a bounded broadcast whatever the input size
        ranges = spark.createDataFrame(
            [(i, c, lo, hi, p) for i, c, lo, hi, p in spec],
            "iv int, cell int, a struct<h:bigint,g:bigint,d:bigint>, z struct<h:bigint,g:bigint,d:bigint>,"
            " probes array<struct<h:bigint,g:bigint,d:bigint>>")
        hist = (rows.select("cell", "size", _key().alias("k")).join(F.broadcast(ranges), "cell")
                .where((F.col("k") >= F.col("a")) & (F.col("k") <= F.col("z")))
                .withColumn("bin", F.size(F.filter("probes", lambda p: p < F.col("k"))))
                .groupBy("iv", "bin").agg(F.sum("size").alias("b"), F.min("k").alias("lo"), F.max("k").alias("hi"))
                .collect())
        by = {}
        for r in hist:
            by.setdefault(r["iv"], []).append(r)
        for i, (c, lo, hi, below) in enumerate(found):
            for k in found[(c, lo, hi, below)]:
                run = below
                for r in sorted(by[i], key=lambda r: r["bin"]):
                    if run < targets[k] <= run + r["b"]:
                        if run + r["b"] - targets[k] <= slack:
                            done[k] = tuple(r["hi"])
                        else:
                            open_[k] = (c, run, tuple(r["lo"]), tuple(r["hi"]))
                        break
                    run += r["b"]
    return [done[k] for k in sorted(done)]


def shard(docs: DataFrame, shards: int = 8, probes: int = 16, tolerance: float = 0.0,
          parts: int = 1024) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot. ``parts``: into how many about
    equal parts the slots are numbered."""
    rows = stage(keyed(docs), "shards")
    borders = splitters(rows, shards, probes, tolerance)
    k = _key()
    inside = F.lit(0)
    for h, g, d in borders:
        at = F.struct(F.lit(h).cast("long").alias("h"), F.lit(g).cast("long").alias("g"), F.lit(d).cast("long").alias("d"))
        inside = inside + (k > at).cast("int")
    placed = rows.withColumn("shard", inside)
    n_rows = rows.count()
    per_part = max(1, -(-n_rows // parts))
    cells = (placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
             .select("shard", "cell", F.ceil(F.col("n") / per_part).cast("int").alias("salts")))
    # at most 4,096 + shards rows: every row of the cell histogram is one cell
    # of one shard, and shards are ranges of the cell order
    salted = (placed.join(F.broadcast(cells), ["shard", "cell"])
              .withColumn("part", F.floor(F.col("g") * F.col("salts") / F.lit(1 << 32)).cast("int")))
    counts = salted.groupBy("shard", "cell", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("shard", "cell", "part").orderBy("h", "g", F.col("doc_id").asc_nulls_first(), "size")
    return (salted.join(offsets, ["shard", "cell", "part"])
            .withColumn("slot", (F.col("base") + F.row_number().over(inner) - 1).cast("long"))
            .select("doc_id", "size", "text_crc32", "shard", "slot"))
