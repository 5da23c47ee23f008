"""Conversation prefix trie (operator 11): a minimal-perfect-hash node table.

Every distinct sequence of the first d turns is a node, known by a 128-bit digest.
A digest is made from running sums of hashes of (place, turn), so prefixes need no
chain of hashes: turns are numbered and summed in blocks, and a conversation with
a third of all turns is spread over many tasks.

Nodes are aggregated by digest (members, smallest member, parent, ends). Equal
digests must agree in depth, parent and last turn (128 bits of its SHA-256); by
induction over the depth their sequences then agree, too. If any do not, all is
digested again with the next seed.

The trie is cut so that no task holds more than about the square root of all
rows: a node is *heavy* if more rows than that lie below it, else light. Heavy
nodes are a small top of the trie (at each depth at most as many as the square
root). Each light subtree under a heavy node is a *piece*; pieces are dealt over
tasks as shards. A shard gives every digest its slot in a minimal perfect hash
table (levels of bit arrays with ranks; stored digests verify every hit),
scatters counts into flat arrays and adds children to parents through an array of
parent slots, deepest level first. What the tops of the pieces carry is summed
per heavy node, and the heavy nodes are accumulated in the same way, one level
after the other, with two levels in memory.

The ids of a node's ending conversations are hashed as one text. They are sorted
over all tasks and joined to parts of ``CHUNK`` ids there, so that a node where
very many conversations end is only streamed as a few long parts.

Defined cases: rows without conv_id belong to no conversation; null role or text
is empty; turns are ordered by turn (null first), equal ones by role and text's
hash; repeated rows are turns of their own; an empty table gives an empty result;
other columns never matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import parallelism, stage
from tablewright.llm.partenum_join import mix

BLOCK = 65_536          # turns of one conversation that one task sums
LEAST_PIECE = 1_000     # pieces may always be this large
BUFFER = 100_000        # rows of whole pieces that are put into one table
CHUNK = 8_192           # conversation ids in one part of a node's list
FEW = 200_000           # rows that may be broadcast
GAMMA = 2.0             # bits per key of a level
SHARED = 6              # the rebuilding takes crc32 % SHARED turns of another conversation
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= FEW else df


# ------------------------------------------------------------------ turns

def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, i (from 1), total, t1, t2 (of the SHA-256 of role and text) and
    size (code points of the text) of every turn. Texts are left behind here."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    long = lambda at: F.conv(F.substring(sha, at, 16), 16, -10).cast("long")
    turns = stage(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", long(1).alias("t1"), long(17).alias("t2"),
        F.char_length(text).cast("long").alias("size")), "op11", "turns")
    # ranges cut long conversations; the ranges' counts give the numbers
    order = [F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    ranged = stage(turns.repartitionByRange(parallelism(turns.sparkSession), "conv_id", *order)
                   .withColumn("block", F.spark_partition_id()), "op11", "ranged")
    whole = Window.partitionBy("conv_id")
    blocks = ranged.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "block", F.sum("n").over(whole).alias("total"),
        (F.sum("n").over(whole.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    own = Window.partitionBy("conv_id", "block").orderBy(*order)
    return ranged.join(blocks, ["conv_id", "block"]).select(
        "conv_id", (F.row_number().over(own) + F.col("before")).alias("i"), "total", "t1", "t2", "size")


def as_they_are(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and turns (conv_id, place, length, t1, t2,
    size) without any rebuilding."""
    turns = stage(numbered(conversations).withColumnRenamed("i", "place").withColumnRenamed("total", "length"),
                  "op11", "numbered")
    return turns.groupBy("conv_id").agg(F.max("length").alias("length")), turns


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations and turns after every conversation c has taken its first
    h = crc32(c) % 6 turns from conversation c - c % 100 (all if there are fewer,
    none if that is absent) in place of its own first h."""
    turns = stage(numbered(conversations), "op11", "numbered")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED))
    totals = turns.groupBy("conv_id").agg(F.max("total").alias("total")) \
        .select("conv_id", "total", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    bases = totals.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    taken = F.least(F.col("h"), F.coalesce("base_total", F.lit(0)))
    convs = stage(totals.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length")), "op11", "convs")
    # a conversation's own turns follow its own row, at most SHARED - 1 times 100
    # conversations follow a base
    own = turns.where(F.col("i") > h).join(convs, "conv_id").select(
        "conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("place"), "length", "t1", "t2", "size")
    heads = turns.where((F.col("conv_id") % 100 == 0) & (F.col("i") < SHARED)).select(
        F.col("conv_id").alias("base"), F.col("i").alias("place"), "t1", "t2", "size")
    lent = convs.where("taken > 0").join(heads, "base").where("place <= taken").select(
        "conv_id", "place", "length", "t1", "t2", "size")
    return convs.select("conv_id", "length"), own.unionByName(lent)


def paths(turns: DataFrame, seed: int) -> DataFrame:
    """``turns`` with the digests (d1, d2) of the prefix that ends at each turn and
    (p1, p2) of its parent."""
    lane = lambda k: F.xxhash64(F.lit(2 * seed + k), "place", "t1", "t2").cast("decimal(20,0)")
    own = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    t = turns.withColumn("part", F.floor((F.col("place") - 1) / BLOCK)).withColumn("e1", lane(0)).withColumn("e2", lane(1))
    t = t.withColumn("s1", F.sum("e1").over(own)).withColumn("s2", F.sum("e2").over(own))
    # sums of the parts before, for conversations of more than one part
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = t.where((F.col("place") % BLOCK == 0) & (F.col("place") < F.col("length"))).select(
        "conv_id", (F.col("part") + 1).alias("part"), F.sum("s1").over(before).alias("b1"), F.sum("s2").over(before).alias("b2"))
    wide = lambda c: c.cast("decimal(38,0)")
    t = t.join(sums, ["conv_id", "part"], "left") \
        .withColumn("s1", wide(F.col("s1") + F.coalesce("b1", F.lit(0)))) \
        .withColumn("s2", wide(F.col("s2") + F.coalesce("b2", F.lit(0))))
    parent = [F.col("place") - 1, wide(F.col("s1") - F.col("e1")), wide(F.col("s2") - F.col("e2"))]
    return t.select("conv_id", "place", "length", "t1", "t2", "size", *_digest(F.col("place"), F.col("s1"), F.col("s2")),
                    *[c.alias(n) for c, n in zip(_digest(*parent), ("p1", "p2"))])


def _digest(place: Column, s1: Column, s2: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k), place.cast("long"), s1, s2).alias(f"d{k}") for k in (1, 2)]


def _root() -> list[Column]:
    zero = F.lit(0).cast("decimal(38,0)")
    return _digest(F.lit(0), zero, zero)


# ------------------------------------------------------------------ node table

class SlotTable:
    """A minimal perfect hash table of distinct 128-bit keys: n keys have the
    slots 0 to n - 1. On each level a key that is alone in its cell has the rank
    of the cell as its slot; the others go to the next level. The stored keys
    verify what is found."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        n = len(k1)
        self.levels, self.slots, left, base = [], np.empty(n, np.int64), np.arange(n), 0
        while len(left):
            size = max(1, int(GAMMA * len(left)))
            cell = self._cell(k1[left], k2[left], len(self.levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + base
            hit = alone[cell]
            self.slots[left[hit]] = rank[cell[hit]]
            self.levels.append((size, alone, rank))
            base, left = base + int(hit.sum()), left[~hit]
            if len(self.levels) > 200:
                raise ValueError("keys are not distinct")
        self.k1, self.k2 = np.empty(n, np.int64), np.empty(n, np.int64)
        self.k1[self.slots], self.k2[self.slots] = k1, k2

    @staticmethod
    def _cell(k1, k2, level: int, size: int) -> np.ndarray:
        u = k1.astype(np.int64).view(np.uint64) + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64)
        return (mix(mix(u) ^ k2.astype(np.int64).view(np.uint64)) % np.uint64(size)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for keys that are not there."""
        out, left = np.full(len(k1), -1, np.int64), np.arange(len(k1))
        for level, (size, alone, rank) in enumerate(self.levels):
            if not len(left):
                break
            cell = self._cell(k1[left], k2[left], level, size)
            hit = alone[cell]
            slot = rank[cell[hit]]
            same = (self.k1[slot] == k1[left[hit]]) & (self.k2[slot] == k2[left[hit]])
            out[left[hit][same]] = slot[same]
            left = left[~hit]
        return out


_NODE = ["d1", "d2", "p1", "p2", "conv_id", "depth", "n_convs", "weight"]
_DONE = ("d1 long, d2 long, p1 long, p2 long, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long")


def accumulate(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """n_children, n_leaves, saved_tokens and the parent's conv_id (-1 in
    ``has_parent``'s complement) of whole subtrees, given as flat arrays."""
    table = SlotTable(c["d1"], c["d2"])
    at = table.slots
    n = len(at)
    place = lambda x: _scatter(x, at)
    depth, conv, saved = place(c["depth"]), place(c["conv_id"]), place(c["weight"])
    parent = place(table.find(c["p1"], c["p2"]))
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=n)
    leaves = (children == 0).astype(np.int64)
    order = np.argsort(-depth, kind="stable")
    order = order[inner[order]]
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):          # deepest first
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return {"n_children": children[at], "n_leaves": leaves[at], "saved_tokens": saved[at],
            "has_parent": inner[at], "parent_conv_id": np.where(inner, conv[np.maximum(parent, 0)], 0)[at]}


def _scatter(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(at), np.int64)
    out[at] = x
    return out


def _batch(c: dict, r: dict) -> pa.RecordBatch:
    cols = {k: c[k] for k in ("d1", "d2", "p1", "p2", "conv_id", "depth")}
    cols["parent_conv_id"] = pa.array(r["parent_conv_id"], pa.int64(), mask=~r["has_parent"])
    return pa.RecordBatch.from_pydict(cols | {"n_convs": c["n_convs"]} | {
        k: r[k] for k in ("n_children", "n_leaves", "saved_tokens")})


def _shards(batches) -> Iterator[pa.RecordBatch]:
    """Whole pieces (rows sorted by piece) through tables of about BUFFER rows."""
    names = [*_NODE, "u1", "u2"]
    held = None
    for batch in batches:
        new = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
        held = new if held is None else {k: np.concatenate([held[k], new[k]]) for k in names}
        if len(held["d1"]) >= BUFFER:
            last = np.flatnonzero((held["u1"] != held["u1"][-1]) | (held["u2"] != held["u2"][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                whole = {k: v[:cut] for k, v in held.items()}
                held = {k: v[cut:] for k, v in held.items()}
                yield _batch(whole, accumulate(whole))
    if held is not None and len(held["d1"]):
        yield _batch(held, accumulate(held))


def _levels(batches) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by depth, deepest first, one whole level after the other."""
    held: list[dict] = []
    for batch in batches:
        new = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in batch.schema.names}
        cuts = [0, *(np.flatnonzero(np.diff(new["depth"])) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if held and held[-1]["depth"][-1] != new["depth"][a]:
                    yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}
                    held = []
                held.append({k: v[a:b] for k, v in new.items()})
    if held:
        yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}


def _top(batches) -> Iterator[pa.RecordBatch]:
    """The heavy nodes: each level takes what the level below and the tops of the
    pieces give it, and names the parents of the level below."""
    below = None
    for c in _levels(batches):
        table = SlotTable(c["d1"], c["d2"])
        at, n = table.slots, len(c["d1"])
        children, leaves = _scatter(c["more_children"], at), _scatter(c["more_leaves"], at)
        saved = _scatter(c["weight"] + c["more_saved"], at)
        conv = _scatter(c["conv_id"], at)
        if below is not None:
            old, r = below
            parent = table.find(old["p1"], old["p2"])
            np.add.at(children, parent, 1)
            np.add.at(leaves, parent, r["n_leaves"])
            np.add.at(saved, parent, r["saved_tokens"])
            yield _batch(old, r | {"parent_conv_id": conv[parent], "has_parent": np.ones(len(parent), bool)})
        leaves = np.where(children == 0, 1, leaves)
        below = c, {"n_children": children[at], "n_leaves": leaves[at], "saved_tokens": saved[at]}
    if below is not None:
        c, r = below
        none = np.zeros(len(c["d1"]), bool)
        yield _batch(c, r | {"parent_conv_id": none.astype(np.int64), "has_parent": none})


# ------------------------------------------------------------------ ends

def _parts(batches) -> Iterator[pa.RecordBatch]:
    """Ids sorted by node and id, joined to parts of at most CHUNK ids."""
    for batch in batches:
        d1, d2, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("d1", "d2", "conv_id"))
        starts = np.flatnonzero(np.r_[True, (np.diff(d1) != 0) | (np.diff(d2) != 0)]) if len(d1) else []
        cuts = sorted({*map(int, starts), *range(0, len(d1), CHUNK), len(d1)})
        spans = list(zip(cuts, cuts[1:]))
        yield pa.RecordBatch.from_pydict({
            "d1": pa.array([int(d1[a]) for a, _ in spans], pa.int64()), "d2": pa.array([int(d2[a]) for a, _ in spans], pa.int64()),
            "first": pa.array([int(ids[a]) for a, _ in spans], pa.int64()),
            "ids": pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in spans], pa.string())})


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """One hash per node over its parts in order (rows sorted by node, first id)."""
    node, h = None, None

    def out(rows):
        return pa.RecordBatch.from_pydict({
            "d1": pa.array([n[0] for n, _ in rows], pa.int64()), "d2": pa.array([n[1] for n, _ in rows], pa.int64()),
            "ends_sha256": pa.array([x for _, x in rows], pa.string())})

    for batch in batches:
        rows = []
        for d1, d2, ids in zip(batch.column("d1").to_pylist(), batch.column("d2").to_pylist(), batch.column("ids").to_pylist()):
            if (d1, d2) != node:
                if node is not None:
                    rows.append((node, h.hexdigest()))
                node, h = (d1, d2), hashlib.sha256(ids.encode())
            else:
                h.update(("," + ids).encode())
        yield out(rows)
    if node is not None:
        yield out([(node, h.hexdigest())])


def end_hashes(ends: DataFrame) -> DataFrame:
    """d1, d2, ends_sha256 of all nodes at which conversations end."""
    n = parallelism(ends.sparkSession)
    parts = ends.repartitionByRange(n, "d1", "d2", "conv_id").sortWithinPartitions("d1", "d2", "conv_id") \
        .mapInArrow(_parts, "d1 long, d2 long, first long, ids string")
    return parts.repartition(n, "d1", "d2").sortWithinPartitions("d1", "d2", "first") \
        .mapInArrow(_hashed, "d1 long, d2 long, ends_sha256 string")


# ------------------------------------------------------------------ trie

def _nodes(convs: DataFrame, walked: DataFrame) -> DataFrame:
    """One row per digest; ``clash`` where equal digests differ in what they stand for."""
    same = lambda *cs: [F.min(c) != F.max(c) for c in cs]
    clash = same("place", "p1", "p2", "t1", "t2")
    inner = walked.groupBy("d1", "d2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        F.min("place").cast("long").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        ((F.count(F.lit(1)) - 1) * F.min("size")).alias("weight"),
        F.sum(F.col("length") - F.col("place") + 1).alias("below"),
        (clash[0] | clash[1] | clash[2] | clash[3] | clash[4]).alias("clash"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *_root(), F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"), "conv_id",
        F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("weight"),
        F.lit(None).cast("long").alias("below"), F.lit(False).alias("clash"))
    return inner.unionByName(root)


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of ``convs`` (conv_id, length) and ``turns``
    (conv_id, place, length, t1, t2, size): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    n = parallelism(spark)
    turns = stage(turns, "op11", "rebuilt")
    seed = 0
    while True:
        walked = stage(paths(turns, seed), "op11", "paths")
        nodes = stage(_nodes(convs, walked), "op11", "nodes")
        if nodes.where("clash").isEmpty():
            break
        seed += 1
    limit = max(LEAST_PIECE, math.isqrt(walked.count()))
    heavy = stage(nodes.where((F.col("depth") == 0) | (F.col("below") > limit)), "op11", "heavy")
    n_heavy = heavy.count()
    marks = heavy.where("depth > 0").select("d1", "d2", F.lit(True).alias("heavy"))
    light_rows = F.col("heavy").isNull()
    first = lambda c: F.min_by(F.when(light_rows, F.col(c)), F.when(light_rows, F.col("place")))
    tops = walked.select("conv_id", "place", "d1", "d2").join(_bounded(marks, n_heavy), ["d1", "d2"], "left") \
        .groupBy("conv_id").agg(first("d1").alias("u1"), first("d2").alias("u2")).where("u1 IS NOT NULL")
    light = nodes.where((F.col("depth") > 0) & (F.col("below") <= limit)).join(tops, "conv_id")
    done = stage(light.select(*_NODE, "u1", "u2").repartition(n, "u1", "u2").sortWithinPartitions("u1", "u2")
                 .mapInArrow(_shards, _DONE), "op11", "light")
    given = done.where("parent_conv_id IS NULL").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    more = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    top = heavy.join(given, ["d1", "d2"], "left").select(
        *_NODE, more("c", "more_children"), more("l", "more_leaves"), more("s", "more_saved"))
    top = stage(top.repartition(1).sortWithinPartitions(F.col("depth").desc()).mapInArrow(_top, _DONE), "op11", "top")
    # tops of pieces have their parent among the heavy nodes
    named = _bounded(heavy.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("up")), n_heavy)
    hung = done.where("parent_conv_id IS NULL").join(named, ["p1", "p2"]).withColumn("parent_conv_id", F.col("up")).drop("up")
    every = done.where("parent_conv_id IS NOT NULL").unionByName(hung).unionByName(top)
    ends = stage(walked.where("place = length").select("d1", "d2", "conv_id")
                 .unionByName(convs.where("length = 0").select(*_root(), "conv_id")), "op11", "ends")
    return every.join(end_hashes(ends), ["d1", "d2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    return trie(*as_they_are(conversations))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt(conversations))
