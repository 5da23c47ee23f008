"""Hard-negative mining (operator 13): inner products with LEMP-style pruning.

Anchors are a stated query set (one row in ``every``), so they go out in blocks
of at most ``ANCHORS`` vectors, each block against all rows; rows are never
shuffled. A task takes its rows batch by batch and builds a small index of each:
rows sorted by length fall into buckets of ``BUCKET``, and a bucket keeps sorted
lists of the coordinates that are asked for. Every anchor carries the score that
a row must reach to matter (its k-th best so far, or the lower end of its band):

* a bucket whose longest row cannot reach that score is skipped with all shorter
  ones;
* else the score gives a smallest cosine, and that a feasible range for each of
  the anchor's ``FOCUS`` largest coordinates. The ranges are looked up in the
  sorted lists and intersected; the rows left are verified by exact integer
  products. Where the ranges keep most of a bucket, it is verified whole.

Pruning uses a slack far above rounding, and only the exact scores decide. A task
returns at most k rows per anchor and positive; these are merged by a window.

Two passes per block: the first rows of an anchor's own label (positives), then
per positive the first rows of other labels with a score between ``LOW`` and
``HIGH`` tenths of the positive's.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a null id is never an anchor and sorts last; rows that
repeat a vec_id are separate rows (and separate anchors), but never partners of
an anchor with that id; vectors of different length are padded with zeros, an
empty one is all zeros; components beyond a long are the nearest long, and
scores, too; equal scores go by id; no anchors or an empty table give an empty
result; other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import stage
from tablewright.session import work_path

ANCHORS, BUCKET, FOCUS = 4096, 1024, 3
LOW, HIGH = 3, 9            # tenths of the positive's score
POSITIVES, NEGATIVES = 5, 10
SMALL = 1 << 20             # products of components up to this are exact in doubles
NO_ID = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min
SLACK = 1e-9


def vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label (shifted where vec_id is divisible by 7) and the integer
    vector of the rows that take part."""
    fine = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), shifted.alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))


def matrix(column) -> np.ndarray:
    """An Arrow list column as one integer matrix, short rows padded with zeros."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(arr.offsets.to_numpy())
    width = int(sizes.max()) if len(sizes) else 0
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _widen(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def _large(m: np.ndarray) -> np.ndarray:
    return (m > SMALL).any(1) | (m < -SMALL).any(1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` with all rows of ``b``."""
    la, lb = _large(a), _large(b)
    small = lambda x, y: (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if a.shape[1] * SMALL * SMALL >= 1 << 53:
        la, lb = np.ones(len(a), bool), np.ones(len(b), bool)
    if not la.any() and not lb.any():
        return small(a, b)
    out = np.empty((len(a), len(b)), np.int64)
    out[np.ix_(~la, ~lb)] = small(a[~la], b[~lb])

    def exact(x, y):
        full = x.astype(object) @ y.astype(object).T
        return np.clip(full, LEAST, NO_ID).astype(np.int64) if full.size else full.astype(np.int64)

    out[np.ix_(la, np.arange(len(b)))] = exact(a[la], b)
    out[np.ix_(~la, lb)] = exact(a[~la], b[lb])
    return out


class Bucket:
    """Rows of similar length with sorted lists of their coordinates."""

    def __init__(self, ids, labels, rows, lengths):
        self.ids, self.labels, self.rows, self.longest = ids, labels, rows, float(lengths[0])
        self.unit = rows / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def list_of(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]


def buckets(ids, labels, rows) -> Iterator[Bucket]:
    lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
    order = np.argsort(-lengths, kind="stable")
    for i in range(0, len(order), BUCKET):
        o = order[i:i + BUCKET]
        yield Bucket(ids[o], labels[o], rows[o], lengths[o])


class Anchors:
    """A block of anchors: vectors, lengths and focus coordinates."""

    def __init__(self, ids, labels, rows):
        self.ids, self.labels, self.rows = ids, labels, rows
        self._focus()

    def _focus(self):
        r = self.rows.astype(np.float64)
        self.length = np.sqrt((r ** 2).sum(1))
        self.unit = r / np.where(self.length > 0, self.length, 1.0)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]

    def widen(self, width: int) -> None:
        if self.rows.shape[1] < width:
            self.rows = _widen(self.rows, width)
            self._focus()


def candidates(q: Anchors, b: Bucket, least: np.ndarray) -> Iterator[tuple[int, np.ndarray | None, np.ndarray]]:
    """(anchor, rows of the bucket, exact scores) of all rows that can reach
    ``least`` (minus infinity: any); rows None stands for the whole bucket."""
    reach = q.length * b.longest
    active = np.flatnonzero(least <= reach * (1 + SLACK) + SLACK)
    if not len(active):
        return
    dense, picked = [], []
    bound = np.where(reach[active] > 0, np.minimum(least[active] / np.where(reach[active] > 0, reach[active], 1), 1.0), -1.0)
    ranged = (bound > 0) & (q.focus.shape[1] > 0)
    dense += active[~ranged].tolist()
    some, bound = active[ranged], bound[ranged]
    if len(some):
        # feasible range of a unit vector's coordinate when its cosine is at least `bound`
        c = np.take_along_axis(q.unit[some], q.focus[some], 1)
        cb = bound[:, None]
        spread = np.sqrt(np.maximum(0, (1 - c * c) * (1 - cb * cb)))
        low = np.where(-c >= cb, -1.0, c * cb - spread) - SLACK
        high = np.where(c >= cb, 1.0, c * cb + spread) + SLACK
        starts, ends = np.empty(c.shape, np.int64), np.empty(c.shape, np.int64)
        for f in np.unique(q.focus[some]):
            at = q.focus[some] == f
            values = b.list_of(f)[1]
            starts[at] = np.searchsorted(values, low[at], "left")
            ends[at] = np.searchsorted(values, high[at], "right")
        best = np.argmin(ends - starts, axis=1)
        for k, a in enumerate(some):
            j = best[k]
            s, e = starts[k, j], ends[k, j]
            if e - s > len(b.ids) // 4:
                dense.append(int(a))
            elif e > s:
                found = b.list_of(q.focus[a, j])[0][s:e]
                for f in range(c.shape[1]):
                    if f != j:
                        x = b.unit[found, q.focus[a, f]]
                        found = found[(x >= low[k, f]) & (x <= high[k, f])]
                if len(found):
                    picked.append((int(a), found))
    if dense:
        dense = np.array(dense)
        scores = products(q.rows[dense], b.rows)
        hit = scores >= np.maximum(least[dense], float(LEAST))[:, None] - 1
        for k in np.flatnonzero(hit.any(1)):
            yield int(dense[k]), None, scores[k]
    for a, found in picked:
        yield a, found, products(q.rows[a:a + 1], b.rows[found])[0]


def _first(k: int, scores, ids, more_scores, more_ids):
    """The first k of two lists by score, then id."""
    s, i = np.concatenate([scores, more_scores]), np.concatenate([ids, more_ids])
    if len(s) > 4 * k:                      # all that can tie with the k-th best, then the order by id
        keep = s >= np.partition(s, len(s) - k)[len(s) - k]
        s, i = s[keep], i[keep]
    o = np.lexsort((i, ~s))[:k]             # ~s reverses the order of all integers
    return s[o], i[o]


_NONE = np.empty(0, np.int64)


def _batches(batches, q: Anchors) -> Iterator[Bucket]:
    for batch in batches:
        if batch.num_rows:
            rows = matrix(batch.column("v"))
            width = max(rows.shape[1], q.rows.shape[1])
            q.widen(width)
            ids = batch.column("vec_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            yield from buckets(ids, labels, _widen(rows, width))


def _ids_out(x) -> pa.Array:
    x = np.asarray(x, np.int64)
    return pa.array(x, pa.int64(), mask=x == NO_ID)


def first_positives(rows: DataFrame, block: Anchors, k: int = POSITIVES) -> DataFrame:
    """a (anchor's place in the block), id, score: the first k rows of the
    anchor's label in each task."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        q = sent.value
        q = Anchors(q.ids, q.labels, q.rows)
        best = [(_NONE, _NONE)] * len(q.ids)
        least = np.full(len(q.ids), -np.inf)
        for b in _batches(batches, q):
            for a, at, scores in candidates(q, b, least):
                ids, labels = (b.ids, b.labels) if at is None else (b.ids[at], b.labels[at])
                ok = (labels == q.labels[a]) & (ids != q.ids[a])
                if len(best[a][0]) == k:
                    ok &= scores >= best[a][0][-1]
                if ok.any():
                    best[a] = _first(k, *best[a], scores[ok], ids[ok])
                    if len(best[a][0]) == k:
                        least[a] = float(best[a][0][-1])
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([a for a, (s, _) in enumerate(best) for _ in s], pa.int32()),
            "id": _ids_out([x for _, i in best for x in i]),
            "score": pa.array([int(x) for s, _ in best for x in s], pa.int64())})

    return rows.mapInArrow(run, "a int, id long, score long")


def first_negatives(rows: DataFrame, block: Anchors, positives: list[list[int]], k: int = NEGATIVES) -> DataFrame:
    """a, p (place of the positive), id, score: in each task the first k rows of
    other labels in the band of each positive. ``positives``: their scores."""
    bands = [[(-((-LOW * s) // 10), (HIGH * s) // 10) for s in own] for own in positives]
    sent = rows.sparkSession.sparkContext.broadcast((block, bands))

    def run(batches):
        q, bands = sent.value
        q = Anchors(q.ids, q.labels, q.rows)
        best = [[(_NONE, _NONE)] * len(own) for own in bands]

        def needed(a):  # what a row must reach to matter for any positive
            return min((float(max(lo, int(s[-1]) if len(s) == k else lo))
                        for (lo, hi), (s, _) in zip(bands[a], best[a]) if lo <= hi), default=np.inf)

        least = np.array([needed(a) for a in range(len(q.ids))])
        for b in _batches(batches, q):
            for a, at, scores in candidates(q, b, least):
                ids, labels = (b.ids, b.labels) if at is None else (b.ids[at], b.labels[at])
                other = (labels != q.labels[a]) & (ids != q.ids[a]) & (scores >= least[a] - 1)
                if not other.any():
                    continue
                s, i = scores[other], ids[other]
                for p, (lo, hi) in enumerate(bands[a]):
                    own = best[a][p]
                    ok = (s >= max(lo, int(own[0][-1]) if len(own[0]) == k else lo)) & (s <= hi)
                    if ok.any():
                        best[a][p] = _first(k, *own, s[ok], i[ok])
                least[a] = needed(a)
        flat = [(a, p, s, i) for a, own in enumerate(best) for p, (ss, ii) in enumerate(own) for s, i in zip(ss, ii)]
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([x[0] for x in flat], pa.int32()), "p": pa.array([x[1] for x in flat], pa.int32()),
            "id": _ids_out([x[3] for x in flat]), "score": pa.array([int(x[2]) for x in flat], pa.int64())})

    return rows.mapInArrow(run, "a int, p int, id long, score long")


def _ranked(df: DataFrame, k: int, *by: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


OUT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def hard_negatives(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """One row per anchor, positive and negative, as the module says. Blocks of
    anchors run one after the other; the driver holds one block at a time."""
    spark: SparkSession = embeddings.sparkSession
    rows = vectors(embeddings)
    asked = rows.where(F.col("vec_id") % every == 0)
    n = -(-asked.count() // ANCHORS)
    if not n:
        return spark.createDataFrame([], OUT)
    asked = stage(asked.repartition(n).withColumn("block", F.spark_partition_id()), "op13", "anchors",
                  partition_by=["block"])
    out, written = work_path(spark, "llm", "op13", "mined", unique=True), []
    for i in range(n):
        own = asked.where(F.col("block") == i).select("vec_id", "label", "v").toArrow()
        if not own.num_rows:
            continue
        block = Anchors(own["vec_id"].to_numpy(), own["label"].to_numpy(), matrix(own["v"]))
        found: list[list[tuple[int, int]]] = [[] for _ in block.ids]
        for r in _ranked(first_positives(rows, block), POSITIVES, "a").select("a", "rank", "id", "score").collect():
            found[r.a].append((r["rank"], r.id, r.score))
        found = [sorted(x, key=lambda y: y[0]) for x in found]
        # the block's own positives, at most POSITIVES for each of its anchors
        known = spark.createDataFrame(
            [(a, p, int(block.ids[a]), i, s) for a, own in enumerate(found) for p, (_, i, s) in enumerate(own)],
            "a int, p int, anchor_id long, positive_id long, positive_score long")
        best = _ranked(first_negatives(rows, block, [[s for _, _, s in x] for x in found]), NEGATIVES, "a", "p")
        best.join(known, ["a", "p"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("overwrite").parquet(f"{out}/block={i}")
        written.append(f"{out}/block={i}")
    return spark.read.schema(OUT).parquet(*written)
