"""LM scoring (operator 10): a Katz back-off bigram model.

    P(w | h) = d(c) c(h, w) / (c(h) + 1)   if the pair was seen c times
             = a(h) P(w)                   otherwise

d are Good-Turing discounts for counts up to 5, from smoothed counts of counts
(``discounts``), so that they hold for any table. a(h) makes every history sum to exactly
one over the vocabulary and one unknown word; P(w) is the Good-Turing discounted
unigram, whose left-over mass is the unknown word's. Every history counts one
more occurrence than it has, which is left to back-off, so that a history with
frequent words only has mass for others, too. Texts start after a start mark and end
with an end token. Counts come from all training documents, none are pruned.

Work, all partitioned: (1) unigram counts: per-task sums, then one aggregate.
(2) Each document batch becomes (history, word, document, times), sorted and packed
per history partition, words and histories by their place in the vocabulary where it
is one part (``_pack`` lays numbers out so that they pack small); one shuffle brings all blocks of a
history together, both its training counts and all its uses. Histories with
more than a quarter of a partition's share are dealt by history and word, and
their totals (at most 4 per partition) are put together afterwards. (3) Each
partition counts pairs and resolves its tokens: seen pairs up to the discount of
their count, unseen pairs up to the weight of their history. (4) Once the counts
of counts of all partitions are known, both are filled in and added up by
document batch. A step's shuffle files are released once its result is written.

Word counts are written to the shared folder, and tasks read them from there:
at most about ``part_words`` words (12 bytes each) at a time; a larger vocabulary
is written in folders by word hash, and each is a pass over the documents that
resolves its own words only. The vocabulary never passes through the driver.

Defined cases: null, empty and blank texts are one end token; without training
documents every token is unknown (log10 P = 0); null doc_ids are training rows;
repeated rows count and are scored as rows; an empty table gives an empty
result; other columns of the input never matter.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import drop, forget, parallelism, qualified, stage, store_of
from tablewright.llm.partenum_join import mix, word_hashes
from tablewright.session import work_path

K = 5
START, END = -0x5A5A5A5A5A5A5A5B, 0x5A5A5A5A5A5A5A5A
PART_WORDS = 16_000_000
PART_TOKENS = 500_000   # tokens whose pairs one task holds
LOG_STEPS = 2.0 ** 32     # a document's sum of logarithms in a partition is rounded to such steps (1e-10)
FLATTEST = -1.1           # slope of the counts of counts, at most
_BLOCK_TOKENS = 300_000  # words that are sorted at once
_BATCH_TOKENS = 1_000_000  # words of a batch: one row per history partition
_BATCH_DOCS = 60_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def discounts(n: list[int]) -> list[float]:
    """Good-Turing discounts d[r] for counts r = 0..K from counts of counts n[r],
    r = 0..K+1. The counts of counts are smoothed first, by a line through
    (log r, log n[r]) (simple Good-Turing): N(r) ~ r ** b gives

        r* / r = (1 + 1/r) ** (b + 1),   (K + 1) N(K + 1) / N(1) = (K + 1) ** (b + 1)

    and Katz's d[r] lies between 0 and 1 for every r up to K whenever b < -1. A
    flatter line (few counts) is taken as ``FLATTEST``."""
    known = [(math.log(r), math.log(n[r])) for r in range(1, K + 2) if n[r] > 0]
    b = FLATTEST
    if len(known) > 1:
        mx, my = sum(x for x, _ in known) / len(known), sum(y for _, y in known) / len(known)
        b = min(FLATTEST, sum((x - mx) * (y - my) for x, y in known) / sum((x - mx) ** 2 for x, _ in known))
    a = (K + 1.0) ** (b + 1)
    return [1.0] + [((1 + 1 / r) ** (b + 1) - a) / (1 - a) for r in range(1, K + 1)]


class Unigram:
    """P(w) by count; count 0: the unknown word."""

    def __init__(self, n_tokens: int, n_of: list[int]):
        self.n, self.d = n_tokens, np.array(discounts(n_of) if n_tokens else [1.0] * (K + 1))
        used = sum(self.d[r] * r * n_of[r] for r in range(1, K + 1))
        self.rest = n_tokens - sum(r * n_of[r] for r in range(1, K + 1))  # tokens of words above K
        left = n_tokens - self.rest - used
        self.total = n_tokens if left > 1e-9 else n_tokens + 1
        self.unknown = (self.total - self.rest - used) / self.total if n_tokens else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        known = np.where(c <= K, self.d[np.minimum(c, K)], 1.0) * c / max(1, self.total)
        return np.where(c > 0, known, self.unknown)


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("binary").alias("text"))


def unigrams(tokens: DataFrame) -> DataFrame:
    """w, c over training documents, the end token included."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for at in range(0, len(pdf), 2000):
                part = [word_hashes(t) for t in pdf["text"].iloc[at:at + 2000]]
                w, c = np.unique(np.concatenate([*part, np.full(len(part), END)]), return_counts=True)
                yield pd.DataFrame({"w": w, "c": c})

    return tokens.where("not held_out").select("text").mapInPandas(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _part_of(w: np.ndarray, parts: int) -> np.ndarray:
    """The vocabulary part of a word, as ``_part_column`` has it."""
    return (w >> 40) % parts


def _part_column(parts: int) -> Column:
    return F.pmod(F.shiftright("w", 40), F.lit(parts).cast("long"))


def _pack(**arrays) -> bytes:
    """Integers are laid out by byte: first bytes of all, second bytes of all, ..."""
    def laid_out(x):
        if not isinstance(x, np.ndarray) or x.dtype.kind not in "iu":
            return x
        return x.dtype.str, x.shape, np.ascontiguousarray(x).reshape(-1).view(np.uint8).reshape(x.size, x.itemsize).T.tobytes()

    raw = pickle.dumps({k: laid_out(x) for k, x in arrays.items()}, 5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(b: bytes) -> dict:
    def array(x):
        if not isinstance(x, tuple):
            return x
        dtype, shape, data = np.dtype(x[0]), x[1], np.frombuffer(x[2], np.uint8)
        return data.reshape(dtype.itemsize, -1).T.copy().reshape(-1).view(dtype).reshape(shape)

    found = pickle.loads(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True))
    return {k: array(x) for k, x in found.items()}


def _blocks(pdf: pd.DataFrame) -> Iterator[tuple]:
    """(doc_ids, held, lengths, words of each) of at most _BATCH_DOCS rows, closed as soon as
    they hold _BLOCK_TOKENS words."""
    ids, held = pdf["doc_id"].astype("Int64").tolist(), pdf["held_out"].to_numpy(dtype=bool)
    start, n, found = 0, 0, []
    for i, text in enumerate(pdf["text"]):
        found.append(word_hashes(text))
        n += len(found[-1])
        if n >= _BLOCK_TOKENS or len(found) == _BATCH_DOCS or i + 1 == len(pdf):
            yield ids[start:i + 1], held[start:i + 1], np.array([len(w) for w in found], np.int64), found
            start, n, found = i + 1, 0, []


def _runs(*keys: np.ndarray) -> np.ndarray:
    """First positions of runs of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


_CACHE: dict[tuple, tuple] = {}


def _vocabulary(folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes and counts of one folder, once per Python worker."""
    if (folder,) not in _CACHE:
        from pyarrow import dataset

        store, path = store_of(folder)
        t = dataset.dataset(path, filesystem=store, format="parquet").to_table(columns=["w", "c"])
        w, c = t["w"].to_numpy(), t["c"].to_numpy().astype(np.uint32)
        order = np.argsort(w)
        _CACHE.clear()
        _CACHE[(folder,)] = w[order], c[order]
    return _CACHE[(folder,)]


class _Batch:
    """What the blocks of a batch hold: facts on the documents, and (key, word, document,
    times, count) with key = partition << 34 | far << 33 | code. A history's code is its
    place in the vocabulary over the number of partitions, which deal such places in
    turn; for far ones (hot, unknown or of another part) its place in ``far``."""

    def __init__(self):
        self.facts, self.entries, self.far = [], [], []
        self.n_docs = self.n_far = self.n_tokens = 0

    def add(self, facts: dict, entries: tuple, far: np.ndarray) -> None:
        self.facts.append(facts)
        self.entries.append(entries)
        self.far.append(far)
        self.n_docs += len(facts["ids"])
        self.n_far += len(far)
        self.n_tokens += int(facts["tokens"].sum())

    def rows(self, me: int, name: str, n_parts: int, part: int, counts: bool) -> pd.DataFrame:
        facts = {k: np.concatenate([f[k] for f in self.facts]) for k in self.facts[0] if k != "ids"}
        rows = [(me % n_parts, name, _pack(ids=[i for f in self.facts for i in f["ids"]], **facts), None)]
        key = np.concatenate([e[0] for e in self.entries])
        order = np.argsort(key)
        key, (w, d, t, c) = key[order], (np.concatenate(x)[order] for x in list(zip(*self.entries))[1:])
        far = np.concatenate(self.far)
        of = np.unique(key >> 34)
        ends = np.append(np.searchsorted(key, of << 34), len(key)).tolist()
        for p, a, b in zip(of.tolist(), ends, ends[1:]):
            code = key[a:b] & ((1 << 34) - 1)
            at = _runs(code)
            hist = code[at]
            near = hist[hist < 1 << 33]
            rows.append((p, name, None, _pack(
                near=np.diff(near, prepend=0).astype(np.uint32), far=far[hist[len(near):] - (1 << 33)],
                n=np.diff(np.append(at, b - a)).astype(np.uint32), w=w[a:b], part=part, d=d[a:b], t=t[a:b],
                c=c[a:b] if counts else None)))
        return pd.DataFrame(rows, columns=["p", "batch", "doc", "block"])


def _mapped(tokens: DataFrame, folder: str, part: int, parts: int, n_parts: int, hot: np.ndarray, smooth: float) -> DataFrame:
    """p, batch, doc (bytes or null), block (bytes or null)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, count = _vocabulary(folder)

        def places(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(vocab, words), max(0, len(vocab) - 1))
            return at, vocab[at] == words if len(vocab) else np.zeros(len(words), bool)

        me, seq, batch = TaskContext.get().partitionId(), 0, _Batch()
        for pdf in frames:
            for ids, held, sizes, flat in _blocks(pdf):
                if batch.n_docs and (batch.n_docs + len(ids) > _BATCH_DOCS or batch.n_tokens >= _BATCH_TOKENS):
                    yield batch.rows(me, f"{me}-{seq}", n_parts, part, parts > 1)
                    seq, batch = seq + 1, _Batch()
                full = np.concatenate([x for w in flat for x in ((START,), w, (END,))]).astype(np.int64)
                ends = np.cumsum(sizes + 2)
                first = np.ones(len(full), bool)
                first[ends - 1] = False  # an end token is no history
                h = full[first]
                second = np.ones(len(full), bool)
                second[np.concatenate([[0], ends[:-1]])] = False  # a start mark is no word
                w = full[second]
                doc = np.repeat(np.arange(len(ids)), sizes + 1)
                if parts > 1:
                    mine = _part_of(w, parts) == part
                    h, w, doc = h[mine], w[mine], doc[mine]
                at, known = places(w)
                c = np.where(known, count[at] if len(vocab) else 0, 0).astype(np.int64)
                facts = {"ids": ids, "held": held, "tokens": np.bincount(doc, minlength=len(ids)),
                         "known": np.bincount(doc, known, minlength=len(ids)),
                         "base": np.bincount(doc, np.log10((c + 1) / smooth), minlength=len(ids))}
                uh, inv = np.unique(h, return_inverse=True)
                ids2 = np.where(known, at, -1)
                key = (inv.astype(np.int64) << 32) + (ids2 + 1)
                order = np.argsort(key, kind="stable")  # documents stay in order inside a pair
                key, d, cw = key[order], doc[order], c[order]
                run_at = _runs(key, d)
                times = np.diff(np.append(run_at, len(key)))
                key, d, cw = key[run_at], d[run_at], cw[run_at]
                hist, word = key >> 32, key & 0xFFFFFFFF
                rank, near = places(uh)
                near &= ~np.isin(uh, hot) & (parts == 1)    # parts hold other words than their histories
                dealt = mix(uh)
                where = np.where(near, rank % n_parts, (dealt % np.uint64(n_parts)).astype(np.int64))
                code = np.where(near, rank // n_parts, (1 << 33) + batch.n_far + np.cumsum(~near) - 1)[hist]
                where = where[hist]
                if len(hot):
                    is_hot = np.isin(uh, hot)[hist]
                    where[is_hot] = (mix(dealt[hist[is_hot]] + word[is_hot].astype(np.uint64)) % np.uint64(n_parts)).astype(np.int64)
                # times: negative in held-out documents
                batch.add(facts, ((where << 34) + code, (word - 1).astype(np.int32), (d + batch.n_docs).astype(np.uint16),
                                  np.where(held[d], -times, times).astype(np.int32), cw.astype(np.uint32)), uh[~near])
        if batch.n_docs:
            yield batch.rows(me, f"{me}-{seq}", n_parts, part, parts > 1)

    return tokens.mapInPandas(run, "p int, batch string, doc binary, block binary")


def _resolved(mapped: DataFrame, folder: str, n_parts: int, unigram: Unigram, hot: np.ndarray, hot_count: np.ndarray) -> DataFrame:
    """Per partition: what is known of each batch before discounts are, counts
    of counts, and parts of the hot histories' sums. ``folder``: the vocabulary, if
    it is one part."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [("docs", b, d) for b, d in zip(pdf["batch"], pdf["doc"]) if d is not None]
        names = [b for b, x in zip(pdf["batch"], pdf["block"]) if x is not None]
        blocks = [_unpack(x) for x in pdf["block"] if x is not None]
        if not blocks:
            return pd.DataFrame(rows, columns=["kind", "batch", "data"])
        cat = lambda f: np.concatenate([f(b) for b in blocks])
        here = int(pdf["p"].iloc[0])
        h = cat(lambda b: np.repeat(np.concatenate([np.cumsum(b["near"], dtype=np.int64) * n_parts + here, b["far"]]), b["n"]))
        w = cat(lambda b: b["w"].astype(np.int64) + (b["part"] << 32))
        d, t = cat(lambda b: b["d"]), cat(lambda b: b["t"]).astype(np.int64)
        if blocks[0]["c"] is None:
            count = _vocabulary(folder)[1]
            c2 = np.where(w >= 0, count[w] if len(count) else 0, 0)
        else:
            c2 = cat(lambda b: b["c"])
        block = np.repeat(np.arange(len(blocks)), [len(b["w"]) for b in blocks])
        train, t = t > 0, np.abs(t)
        unknown = cat(lambda b: b["w"] < 0)
        order = np.lexsort((w, h))
        h, w, c2, d, t, block, train, unknown = (x[order] for x in (h, w, c2, d, t, block, train, unknown))
        pair_at = _runs(h, w)
        pair = np.repeat(np.arange(len(pair_at)), np.diff(np.append(pair_at, len(h))))
        c = np.bincount(pair, np.where(train, t, 0), minlength=len(pair_at)).astype(np.int64)
        seen = c > 0
        hist_at = _runs(h[pair_at])
        hist = np.repeat(np.arange(len(hist_at)), np.diff(np.append(hist_at, len(pair_at))))
        n_hist, hh = len(hist_at), h[pair_at][hist_at]
        total = np.bincount(hist, c, minlength=n_hist)
        low = np.stack([np.bincount(hist, np.where(c == r, c, 0), minlength=n_hist) for r in range(1, K + 1)], 1)
        mass = np.bincount(hist, np.where(seen, unigram.p(c2[pair_at].astype(np.int64)), 0.0), minlength=n_hist)
        is_hot = np.isin(hh, hot)
        if is_hot.any():
            rows.append(("hot", "", _pack(h=hh[is_hot], low=low[is_hot], mass=mass[is_hot])))
            total[is_hot] = hot_count[np.searchsorted(hot, hh[is_hot])]
        rows.append(("counts", "", _pack(n=np.bincount(np.minimum(c, K + 2), minlength=K + 3)[:K + 2])))
        ch, cc = hist[pair], c[pair]
        with np.errstate(divide="ignore"):
            log_seen = (np.log10(cc) - np.log10(total[ch] + 1)) * t
        log_uni = np.log10(unigram.p(c2.astype(np.int64))) * t
        order = np.argsort(block, kind="stable")
        bounds = np.searchsorted(block[order], np.arange(len(blocks) + 1))
        for k, name in enumerate(names):
            own = order[bounds[k]:bounds[k + 1]]
            s, u = own[seen[pair[own]]], own[~seen[pair[own]]]
            sd, si = np.unique(d[s], return_inverse=True)
            by_count = np.bincount(si * (K + 2) + np.minimum(cc[s], K + 1), t[s], minlength=len(sd) * (K + 2))
            uh, ui = np.unique(ch[u], return_inverse=True)
            rows.append(("part", name, _pack(
                sd=np.diff(sd.astype(np.int32), prepend=0).astype(np.uint16),
                ss=np.rint(np.bincount(si, log_seen[s], minlength=len(sd)) * LOG_STEPS).astype(np.int64),
                sn=by_count.reshape(-1, K + 2)[:, 1:K + 1].T.astype(np.uint32),
                h=np.where(is_hot[uh], hh[uh], 0), hot=is_hot[uh], low=low[uh].astype(np.uint32), mass=mass[uh],
                total=total[uh], ui=ui.astype(np.uint32), ud=d[u], ut=t[u].astype(np.uint32), ul=log_uni[u])))
        return pd.DataFrame(rows, columns=["kind", "batch", "data"])

    return mapped.groupBy("p").applyInPandas(run, "kind string, batch string, data binary")


def back_off(total, low, mass, d: np.ndarray) -> np.ndarray:
    """a(h): ``total`` c(h), ``low`` occurrences with words seen 1..K times,
    ``mass`` the unigram probability of all words seen after h."""
    kept = low @ d[1:] + (total - low.sum(1))
    return (1 - kept / (total + 1)) / np.maximum(1 - mass, 1e-12)


def score(docs: DataFrame, n_parts: int | None = None, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row."""
    spark = docs.sparkSession
    tokens = _tokens(docs)
    folder = qualified(spark, work_path(spark, "llm", "unigrams", unique=True))
    unigrams(tokens).write.option("compression", "zstd").parquet(folder)
    forget(spark)
    vocab = spark.read.schema("w long, c long").parquet(folder)
    # counts of counts, at most K + 2 rows
    of = {r["r"]: (r["n"], r["t"]) for r in vocab.groupBy(F.least("c", F.lit(K + 2)).alias("r")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("t")).collect()}
    n_words, n_tokens = sum(n for n, _ in of.values()), sum(t for _, t in of.values())
    unigram = Unigram(n_tokens, [of.get(r, (0, 0))[0] for r in range(K + 2)])
    n_parts = n_parts or max(parallelism(spark), -(-n_tokens // PART_TOKENS))
    least = max(1, n_tokens // (4 * n_parts))
    starts = vocab.where(F.col("w") == END).agg(F.max("c")).first()[0] or 0
    # words with more than a quarter of a partition's tokens: fewer than 4 per partition
    hot_rows = [(r["w"], r["c"]) for r in vocab.where((F.col("c") > least) & (F.col("w") != END)).collect()]
    hot_rows = sorted(hot_rows + ([(START, starts)] if starts > least else []))
    hot = np.array([w for w, _ in hot_rows], np.int64)
    hot_count = np.array([c for _, c in hot_rows], np.int64)
    smooth = n_tokens + n_words + 1
    parts = max(1, -(-n_words // part_words))
    if parts > 1:
        folder = qualified(spark, work_path(spark, "llm", "unigram-parts", unique=True))
        vocab.withColumn("part", _part_column(parts)).repartition("part").write.partitionBy("part") \
            .option("compression", "zstd").parquet(folder)
    mapped, passes = None, []
    for k in range(parts):
        one = _mapped(tokens, f"{folder}/part={k}" if parts > 1 else folder, k, parts, n_parts, hot, smooth)
        if parts > 1:  # a batch is named by its task, so every pass is a job of its own
            one = stage(one, "blocks")
            passes.append(one)
        mapped = one if mapped is None else mapped.unionByName(one)
    staged = stage(_resolved(mapped.repartition(n_parts, "p"), folder, n_parts, unigram, hot, hot_count), "resolved")
    drop(*passes)
    forget(spark)
    # a row per partition
    n_of = sum((_unpack(r["data"])["n"] for r in staged.where("kind = 'counts'").collect()), np.zeros(K + 2, np.int64))
    d = np.array(discounts(n_of.tolist()))
    sums: dict[int, tuple] = {}
    for r in staged.where("kind = 'hot'").collect():
        x = _unpack(r["data"])
        for w, low, mass in zip(x["h"].tolist(), x["low"], x["mass"]):
            a, b = sums.get(w, (0, 0.0))
            sums[w] = (a + low, b + mass)

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        info = [_unpack(x) for k, x in zip(pdf["kind"], pdf["data"]) if k == "docs"]
        n = len(info[0]["ids"])
        out = np.zeros(n)
        for x in (_unpack(x) for k, x in zip(pdf["kind"], pdf["data"]) if k == "part"):
            out += np.bincount(np.cumsum(x["sd"], dtype=np.int64), x["ss"] / LOG_STEPS + np.log10(d[1:]) @ x["sn"], minlength=n)
            low, mass = x["low"].astype(float), x["mass"].copy()
            for i in np.flatnonzero(x["hot"]):
                low[i], mass[i] = sums[int(x["h"][i])]
            weight = np.log10(back_off(x["total"].astype(float), low, mass, d))
            out += np.bincount(x["ud"], weight[x["ui"]] * x["ut"] + x["ul"], minlength=n)
        total = lambda k: sum(i[k] for i in info)
        return pd.DataFrame({"doc_id": pd.array(info[0]["ids"], "Int64"), "held_out": info[0]["held"],
                             "n_tokens": total("tokens").astype(np.int64), "n_known": total("known").astype(np.int64),
                             "train_tokens": n_tokens, "base_score": total("base"), "score": out})

    return (staged.where("kind in ('docs', 'part')").groupBy("batch").applyInPandas(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
