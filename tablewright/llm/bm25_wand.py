"""Benchmark decontamination (operator 5): BM25 with block-max WAND.

Test items are cut into pieces of at most ``PIECE`` words; an inverted index
holds their BM25 impacts, divided by the piece's own full score, so that a score
of 1 means every word of the piece and one threshold serves all items. Postings
are in blocks with their highest impact. Training documents are read as passages
of ``2 * PIECE`` words every ``PIECE`` words, so each run of PIECE words lies
inside one passage; every passage of every document is a query. WAND skips by
terms' highest impacts, then by block maxima, then scores what remains: every
piece above the threshold is found. A hit is verified around its passage: at
least ``overlap`` of the item's five-word shingles must occur there, and of its
question (the first two thirds of its words) and of its answer (the rest) at least
``overlap`` or all but five, which is what one changed word takes.

The index is built by DataFrame aggregations. It travels to the tasks in parts
of at most ``PART_POSTINGS`` postings each (about 64 MB); a larger benchmark is
searched part by part, each against all documents. Documents never shuffle.

Defined cases: null, empty and blank documents or items match nothing; items of
fewer than five words are compared as one whole sequence; a null item_id is
carried as null; repeated rows repeat their findings; empty tables give an empty
result; other columns of either input never matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import stage

PIECE, BLOCK, RANGE, K1, B = 64, 16, 4, 1.2, 0.75
FREQUENT, RARE_FLOOR = 0.2, 0.5
PART_POSTINGS = 4_000_000
_WORD = re.compile(r"\w+")
RESULT = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
          "first_word long, n_words long")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def item_pieces(benchmark: DataFrame) -> DataFrame:
    """item (row number by hash), item_id, words, piece number, piece words."""
    @F.pandas_udf("array<string>")
    def cut(s: pd.Series) -> pd.Series:
        return s.map(words_of, na_action=None)

    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), cut("text").alias("words"))
             .where(F.size("words") > 0)
             .withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item", "item_id", "words"]))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(PIECE))
    return (items.select("*", F.explode(starts).alias("at"))
            .withColumn("at", F.greatest(F.least(F.col("at"), F.size("words") - PIECE), F.lit(0)))
            .withColumn("piece_words", F.slice("words", F.col("at") + 1, F.lit(PIECE))))


def postings(pieces: DataFrame) -> DataFrame:
    """term, item, at, impact: BM25 impact over the piece's own full score."""
    per = pieces.select("item", "at", F.size("piece_words").alias("len"), F.explode("piece_words").alias("term"))
    tf = per.groupBy("item", "at", "len", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stats = pieces.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("piece_words")).alias("avg"))  # one row
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    raw = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg")))
    own = Window.partitionBy("item", "at")  # at most PIECE rows
    return (tf.join(df, "term").join(F.broadcast(stats)).withColumn("raw", raw)
            .select("term", "item", "at", (F.col("raw") / F.sum("raw").over(own)).alias("impact")))


class Index:
    """One part of the inverted index, with block maxima."""

    def __init__(self, rows: pd.DataFrame, items: dict[int, tuple]):
        rows = rows.sort_values(["item", "at", "term"])
        keys = rows[["item", "at"]].drop_duplicates()
        self.items, self.piece_item = items, keys["item"].tolist()
        number = {k: i for i, k in enumerate(zip(keys["item"], keys["at"]))}
        rows = rows.assign(piece=[number[k] for k in zip(rows["item"], rows["at"])])
        self.terms, self.docs, self.impacts, self.block_max = {}, [], [], []
        for term, g in rows.groupby("term", sort=True):
            self.terms[term] = len(self.docs)
            d, w = g["piece"].to_numpy(), g["impact"].to_numpy()
            self.docs.append(d.tolist())
            self.impacts.append(w.tolist())
            self.block_max.append([(int(d[i:i + BLOCK][-1]), float(w[i:i + BLOCK].max())) for i in range(0, len(d), BLOCK)])
        self.highest = np.array([max(w) for w in self.impacts] + [0.0])  # last: words of no item
        # A few terms are frequent; what they add to a piece at most is kept per
        # range, so a passage needs rarer terms for what is left of the threshold.
        often = {t for t, i in self.terms.items() if len(self.docs[i]) > max(2, FREQUENT * len(self.piece_item))}
        by_piece = rows[rows["term"].isin(often)].groupby("piece")["impact"].sum()
        everything = len(by_piece) > 0 and by_piece.max() >= RARE_FLOOR  # frequent terms alone say too much
        rare = [t for t in self.terms if everything or t not in often]
        self.rare = {t: k for k, t in enumerate(rare)}
        # Per range of RANGE pieces: what frequent terms add at most, and per
        # rare term its highest impact there.
        self.n_ranges = len(self.piece_item) // RANGE + 1
        self.rest = np.zeros(self.n_ranges)
        if not everything:
            np.maximum.at(self.rest, by_piece.index.to_numpy(dtype=np.int64) // RANGE, by_piece.to_numpy(dtype=float))
        spans = [self._ranges(self.terms[t]) for t in rare]
        self.range_at = np.concatenate([[0], np.cumsum([len(x) for x in spans])]).astype(np.int64)
        self.range_id = np.array([b for x in spans for b in x], np.int64)
        self.range_max = np.array([v for x in spans for v in x.values()])

    def _ranges(self, t: int) -> dict[int, float]:
        out: dict[int, float] = {}
        for d, w in zip(self.docs[t], self.impacts[t]):
            out[d // RANGE] = max(w, out.get(d // RANGE, 0.0))
        return out

    def search(self, tids: list[int], theta: float) -> list[tuple[int, float]]:
        """All pieces with a score of at least ``theta`` for these distinct terms."""
        high, docs, impacts, blocks = self.highest, self.docs, self.impacts, self.block_max
        cur = [[docs[t][0], t, 0] for t in tids]  # current piece, term, position
        found = []

        def advance(c, to):
            d, p = docs[c[1]], c[2]
            while p < len(d) and d[p] < to:
                skip = p // BLOCK  # whole blocks first
                p = (skip + 1) * BLOCK if blocks[c[1]][skip][0] < to else p + 1
            c[2] = p
            c[0] = d[p] if p < len(d) else 1 << 60

        while True:
            cur.sort()
            bound, pivot = 0.0, None
            for i, c in enumerate(cur):
                if c[0] == 1 << 60:
                    break
                bound += high[c[1]]
                if bound >= theta:
                    pivot = i
                    break
            if pivot is None:
                return found
            at = cur[pivot][0]
            while pivot + 1 < len(cur) and cur[pivot + 1][0] == at:
                pivot += 1
            top, upto = 0.0, 1 << 60
            for c in cur[:pivot + 1]:
                b = c[2] // BLOCK
                bl = blocks[c[1]]
                while b < len(bl) and bl[b][0] < at:
                    b += 1
                if b < len(bl):
                    top += bl[b][1]
                    upto = min(upto, bl[b][0])
            if top < theta:  # no piece of these blocks can reach theta
                nxt = upto + 1
                if pivot + 1 < len(cur):
                    nxt = min(nxt, cur[pivot + 1][0])
                nxt = max(nxt, at + 1)
                for c in cur[:pivot + 1]:
                    if c[0] < nxt:
                        advance(c, nxt)
            elif cur[0][0] == at:
                s = sum(impacts[c[1]][c[2]] for c in cur[:pivot + 1])
                if s >= theta:
                    found.append((at, s))
                for c in cur[:pivot + 1]:
                    advance(c, at + 1)
            else:
                for c in cur[:pivot]:
                    if c[0] < at:
                        advance(c, at)

    def candidates(self, ws: list[str], theta: float) -> Iterator[tuple[int, int, float]]:
        """(first word of the passage, piece, score) over all passages."""
        rare, every = self.rare, self.rest.max() >= theta - 1e-9
        at = [i for i, w in enumerate(ws) if w in rare]
        passages = max(1, -(-(len(ws) - PIECE) // PIECE))
        if not every:
            if not at:
                return
            # distinct (passage, term); a word lies in the passage of its own
            # chunk and in the one before
            chunk = np.array(at) // PIECE
            term = np.array([rare[ws[i]] for i in at])
            both = np.concatenate([chunk, chunk - 1])
            inside = (both >= 0) & (both < passages)
            key = np.unique(both[inside] * len(rare) + np.concatenate([term, term])[inside])
            p, term = key // len(rare), key % len(rare)
            n = self.range_at[term + 1] - self.range_at[term]
            flat = np.repeat(self.range_at[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            bound = np.bincount(np.repeat(p, n) * self.n_ranges + self.range_id[flat], self.range_max[flat],
                                minlength=passages * self.n_ranges).reshape(passages, self.n_ranges)
            chosen = np.flatnonzero((bound + self.rest).max(1) >= theta - 1e-9).tolist()
        else:
            chosen = range(passages)
        for k in chosen:
            a = k * PIECE
            own = {t for w in ws[a:a + 2 * PIECE] if (t := self.terms.get(w)) is not None}
            if own:
                for piece, s in self.search(sorted(own), theta):
                    yield a, piece, s


def _shingles(ws: list[str]) -> set[tuple]:
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())


def _share(part: list[str], region: list[str]) -> tuple[float, int]:
    """Share of the shingles of ``part`` that occur in ``region``, number missing."""
    own = _shingles(part)
    if not own:
        return 1.0, 0
    n = min(5, len(part))
    there = {tuple(region[i:i + n]) for i in range(len(region) - n + 1)}
    kept = len(own & there)
    return kept / len(own), len(own) - kept


def scan_text(text: str | None, index: Index, theta: float, overlap: float) -> list[tuple]:
    ws = words_of(text)
    best: dict[int, tuple] = {}
    tried: set[tuple[int, int]] = set()
    for a, piece, s in index.candidates(ws, theta) if ws else ():
        item = index.piece_item[piece]
        if (a, item) in tried:
            continue
        tried.add((a, item))
        item_id, iw = index.items[item]
        lo, hi = max(0, a - len(iw)), min(len(ws), a + 2 * PIECE + len(iw))
        region, cut = ws[lo:hi], len(iw) * 2 // 3
        if _share(iw, region)[0] < overlap:
            continue
        (q, q_lost), (ans, ans_lost) = _share(iw[:cut], region), _share(iw[cut:], region)
        if (q >= overlap or q_lost <= 5) and (ans >= overlap or ans_lost <= 5) and (item not in best or (s, -a) > (best[item][1], -best[item][4])):
            best[item] = (item_id, s, q, ans, a, len(iw))
    return [best[k] for k in sorted(best)]


def indexes(spark, benchmark: DataFrame) -> list:
    """The inverted index as broadcast parts of about PART_POSTINGS postings."""
    pieces = stage(item_pieces(benchmark), "bench-pieces")
    post = stage(postings(pieces), "bench-postings")
    parts = max(1, -(-post.count() // PART_POSTINGS))
    out = []
    for k in range(parts):
        mine = F.pmod(F.xxhash64("item"), F.lit(parts)) == k
        items = {r["item"]: (r["item_id"], r["words"]) for r in
                 pieces.where(mine).select("item", "item_id", "words").distinct().collect()}
        if items:
            out.append(spark.sparkContext.broadcast(Index(post.where(mine).toPandas(), items)))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, theta: float = 0.6, overlap: float = 0.8) -> DataFrame:
    """One row per (document row, test item found in it)."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], RESULT)
    for index in indexes(spark, benchmark):
        def run(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found = [(d, *hit) for d, t in zip(pdf["doc_id"], pdf["text"])
                         for hit in scan_text(t, index.value, theta, overlap)]
                f = pd.DataFrame(found, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap",
                                                 "first_word", "n_words"])
                yield f.astype({"doc_id": "Int64", "item_id": "Int64"})

        out = out.unionByName(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, RESULT))
    return out


def _clean_udf(index, theta: float, overlap: float):
    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda t: not scan_text(t, index.value, theta, overlap), na_action=None).astype(bool)

    return clean


def decontaminated(docs: DataFrame, benchmark: DataFrame, theta: float = 0.6, overlap: float = 0.8) -> DataFrame:
    """``docs`` without the rows in which a test item is found; a narrow filter."""
    out = docs
    for index in indexes(docs.sparkSession, benchmark):
        out = out.where(_clean_udf(index, theta, overlap)("text"))
    return out
