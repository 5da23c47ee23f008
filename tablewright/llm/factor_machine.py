"""Quality classifier (operator 3): a factorisation machine.

Inputs of a score are hashed words (log counts), binned structure statistics
and binned text metadata (length, lines, alphabet); never lang, source, doc_id
or a label. With x the sparse input of a text,

    s(x) = w0 + <w, x> + 1/2 * sum_f ((<v_f, x>)^2 - <v_f^2, x^2>)

so all pairwise interactions cost time linear in the features of the text.
It is fitted by Adam on a bounded sample of labelled rows: the ``sample``
training labels with the smallest hash of their doc_id (a parameter, the same
at every input size); every document is scored, whole.

Defined cases: null and empty texts get the score of an input with no words;
labels with a null quality, a null doc_id or two different values for a doc_id
are left out; without any training label every score is 0.5; rows with a null
doc_id are scored and are held out when the remainder is 0 (null: false);
repeated rows are scored alike; an empty table gives an empty result; other
columns of the input are passed through, but for the two that it names (``into``, ``flag``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import kept

SAMPLE = 6000
BITS = 14
RANK = 8
_N_BINS = 16
_STATS = 14
DIM = (1 << BITS) + _STATS * _N_BINS
_RUNS = re.compile(r"[^\x20\x09-\x0D]+")
_MEMO_LIMIT = 200_000


def _bin(x: float) -> int:
    return min(_N_BINS - 1, max(0, int(x)))


def statistics(text: str, ws: list[str], counts: Counter) -> list[int]:
    """Bins of structure statistics and metadata of one text."""
    n, chars = max(1, len(ws)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(map(str.isupper, ws)) / n
    letters = sum(map(str.isalpha, ws)) / n
    symbols = sum(text.count(c) for c in "#*$%&|<>{}[]") / n
    marks = sum(text.count(c) for c in "!?") / n
    stops = sum(text.count(c) for c in ".,;:") / n
    pairs = len(set(zip(ws, ws[1:]))) / n
    same = sum(a == b for a, b in zip(ws, ws[1:])) / n
    return [
        _bin(np.log2(n)), _bin(np.log2(chars)), _bin(np.log2(len(lines) + 1)),
        _bin(upper * 15), _bin(letters * 15), _bin(np.log2(1 + symbols * 64)),
        _bin(np.log2(1 + marks * 64)), _bin(np.log2(1 + stops * 256)),
        _bin(len(counts) / n * 15), _bin(pairs * 15), _bin(same * 15),
        _bin((1 - len(set(lines)) / max(1, len(lines))) * 15),
        _bin(chars / n), _bin(max(counts.values(), default=0) / n * 30),
    ]


def features(text: str | None, memo: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values (unit length over words, one per statistic)."""
    text = text or ""
    ws = _RUNS.findall(text)
    counts = Counter(ws)
    if len(memo) > _MEMO_LIMIT:
        memo.clear()
    slots = np.empty(len(counts), np.int64)
    for i, w in enumerate(counts):
        s = memo.get(w)
        if s is None:
            s = memo[w] = crc32(w.lower().encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
        slots[i] = s
    tf = np.bincount(slots, np.fromiter(counts.values(), float, len(counts)), minlength=1 << BITS) if len(slots) else np.zeros(1 << BITS)
    idx = np.flatnonzero(tf)
    val = np.log1p(tf[idx])
    if len(val):
        val /= np.linalg.norm(val)
    stat = np.array([(1 << BITS) + k * _N_BINS + b for k, b in enumerate(statistics(text, ws, counts))])
    return np.concatenate([idx, stat]), np.concatenate([val, np.full(len(stat), 0.5)])


class Machine:
    """Parameters of a fitted machine: w0, w[DIM], v[DIM, RANK]; about 0.6 MB
    whatever the corpus, so it travels with the tasks."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def margins(self, idx: np.ndarray, val: np.ndarray, starts: np.ndarray):
        xv = val[:, None] * self.v[idx]
        sums = np.add.reduceat(xv, starts)
        squares = np.add.reduceat(xv * xv, starts)
        return self.w0 + np.add.reduceat(val * self.w[idx], starts) + 0.5 * (sums ** 2 - squares).sum(1), sums

    def score(self, text: str | None, memo: dict[str, int]) -> float:
        idx, val = features(text, memo)
        return float(1 / (1 + np.exp(-np.clip(self.margins(idx, val, np.array([0]))[0][0], -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 8, batch: int = 64,
        rate: float = 0.02, decay: float = 1e-5, seed: int = 7) -> Machine | None:
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(DIM), rng.normal(0, 0.02, (DIM, RANK)))
    params = [np.zeros(1), m.w, m.v]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = [rows[i] for i in order[at:at + batch]]
            idx, val = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part])
            sizes = np.array([len(r[0]) for r in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            margin, sums = m.margins(idx, val, starts)
            err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - np.array([r[2] for r in part])) / len(part)
            e = np.repeat(err, sizes)
            gw = np.bincount(idx, e * val, minlength=DIM)
            pull = (e * val)[:, None] * (np.repeat(sums, sizes, axis=0) - val[:, None] * m.v[idx])
            gv = np.stack([np.bincount(idx, pull[:, f], minlength=DIM) for f in range(RANK)], 1)
            t += 1
            for p, g, a, b in zip(params, (np.array([err.sum()]), gw + decay * m.w, gv + decay * m.v), first, second):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
            m.w0 = float(params[0][0])
    return Machine(m.w0, m.w.astype(np.float32), m.v.astype(np.float32))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """Fits on at most ``sample`` labelled rows outside the held-out fold."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("_y"))
              .where("y = _y").select("doc_id", F.col("y").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def featurise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, int] = {}
        for pdf in parts:
            made = [features(t, memo) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "idx": [a for a, _ in made],
                                "val": [b for _, b in made]})

    # at most `sample` rows of (doc_id, label): bounded, so it may be broadcast
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = picked.mapInPandas(featurise, "doc_id long, y int, idx array<bigint>, val array<double>") \
        .dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return fit([(np.asarray(i), np.asarray(v), y) for i, v, y in zip(rows["idx"], rows["val"], rows["y"])])


def score(docs: DataFrame, machine: Machine | None, threshold: float = 0.3, into: str = "score",
          flag: str = "predicted") -> DataFrame:
    """``docs`` with the columns ``into`` (score) and ``flag`` (predicted); a
    column of ``docs`` with one of these names is replaced, so name them anew to
    keep it."""
    if machine is None:
        return docs.withColumns({into: F.lit(0.5), flag: F.lit(int(0.5 >= threshold))})

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, int] = kept("word slots", dict)
        for s in texts:
            yield s.map(lambda t: machine.score(t, memo), na_action=None).astype(float)

    return (docs.withColumn(into, scored("text"))
            .withColumn(flag, (F.col(into) >= threshold).cast("int")))
