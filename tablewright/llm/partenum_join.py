"""N-gram Jaccard join (operator 6): PartEnum signatures, exact.

A document's set is its distinct n-word shingles, as 64-bit hashes. Sizes fall
into bands [l, r] with r = floor(l / gamma); two sets that reach the similarity
lie in one band or in two neighbouring ones, and differ in at most
k = floor(2 r (1 - gamma) / (1 + gamma)) elements. For a band, the hash domain
is cut into n1 = ceil((k + 1) / 2) parts, so one part holds at most one
difference; each part is cut into three pieces, and a signature is a hash of two
of the three pieces (for k = 0: of the whole set). So similar sets of a band
always share a signature. Sets sign for their own band and the next one.

Two empty pieces would gather unrelated sets in one signature. In their place the
set signs its part's elements E (all in the third piece) and every E without one
element: sets that differ by at most one element there share one of these. Only
the empty E could be shared by many, so it is left out. A pair loses a part by
that only if the part holds at most one element in both sets. Large bands
therefore have some spare parts: a set with at most ``spare`` such poor parts
still has n1 parts, enough for every pair that it is in. A set with more of them
signs once more with another hash seed until it has few enough; ``spare`` is two
standard deviations above the expected number, so about one set in fifty does, at
any size (for similarities from 0.8; far lower ones have too small parts).
Both sets of a pair sign with the seed at which the first of them stops.

Equal sets are one class, known by a 64-bit hash, and sign about once per task.
Pairs are verified with exact set sizes and intersections, in rounds. A round looks
at signatures whose classes still lie in different components: each class outside
the signature's leading component is compared with one class of that component
that it shares most signatures with, and links join components at once, so what
is joined is never compared again. In a group of near copies nearly all are joined
after a few rounds of one pair per class. What then remains open (classes that
share signatures but no link was found) is settled exactly. Classes that are nearly
similar enough share signatures without a link, all with all in a large group; so
the open classes are asked for more: in the order of how many open classes hold an
element, rarest first, two sets that reach the similarity share one of their first
few elements (``prefix_marks``). What a group has in common comes last in that
order. The leaders of two components that share such an element are compared, a link joins them, and where there is none their classes are compared in so
far as the triangle inequality of the Jaccard distance leaves a link open.
Components come from large-star/small-star rounds. Every step is written to the
shared folder, and dropped when its last reader is done.

Defined cases: null, empty and blank texts have an empty set and are their own
component; rows that repeat a doc_id are separate rows with that id; null
doc_ids take part in links, but never name a component unless all of it is
null; ties cannot change a result; an empty table gives an empty result; other
columns of the input never matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import drop, forget, kept, parallelism, stage

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1
_SEEN_LIMIT = 500_000
_WORD_LIMIT = 300_000
_BATCH = 256                           # sets that are signed at once
_FEW = 200_000                         # pairs whose classes are broadcast (a few MB)
_PENDING = 500_000                     # signatures that a task holds before it passes them on
ROUNDS = 6                             # rounds of one pair per class before all open pairs


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hashes of the words met before in this worker."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little", signed=True)
        return h


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a UTF-8 text, A-Z lower-cased; the blanks at which
    bytes are split are ``BLANKS``."""
    hashes = kept("word hashes", _Hashes)
    if len(hashes) > _WORD_LIMIT:
        hashes.clear()
    found = (text or b"").lower().split()
    return np.fromiter(map(hashes.__getitem__, found), np.int64, len(found))


def shingle_set(word_hashes: np.ndarray, n: int = 4) -> np.ndarray:
    """Sorted distinct hashes of all runs of n words; fewer words: of all of them."""
    w = word_hashes.astype(np.int64).view(np.uint64)
    if not len(w):
        return w
    n = min(n, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix(h * _GOLD + w[i:len(w) - n + 1 + i])
    return np.unique(h)


def shingle_sets(texts: list[np.ndarray], n: int = 4) -> list[np.ndarray]:
    """``shingle_set`` of many word lists at once."""
    out: list[np.ndarray] = [shingle_set(w, n) if len(w) < n else None for w in texts]
    long = [i for i, w in enumerate(texts) if len(w) >= n]
    if long:
        w = np.concatenate([texts[i] for i in long]).astype(np.int64).view(np.uint64)
        ends = np.cumsum([len(texts[i]) for i in long])
        h = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            h = mix(h * _GOLD + w[i:len(w) - n + 1 + i])
        for i, end in zip(long, ends.tolist()):
            out[i] = np.unique(h[end - len(texts[i]):end - n + 1])
    return out


def class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


@lru_cache(None)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest size of every band, up to sizes of 10**9."""
    low, high = [1], []
    while low[-1] < 10 ** 9:
        high.append(max(low[-1], low[-1] * 100 // percent))
        low.append(high[-1] + 1)
    return np.array(low[:-1]), np.array(high)


@lru_cache(None)
def parts(percent: int, band: int) -> tuple[int, int, int]:
    """Most differences k of a band, its number of parts and the spare ones of these."""
    low, high = bands(percent)
    k = 2 * int(high[band]) * (100 - percent) // (100 + percent)
    need, least = (k + 2) // 2, int(low[max(0, band - 1)])  # the band before signs too

    def expected(n: int) -> float:
        return n * (1 + least / n) * math.exp(-least / n)

    spare = 0
    if expected(need) > 0.05:
        while spare <= need // 4 and spare < (e := expected(need + spare)) + 2 * math.sqrt(e):
            spare = max(spare + 1, min(math.ceil(e + 2 * math.sqrt(e)), need // 4 + 1))
        if spare > need // 4:  # few parts: another seed is soon found
            spare = 0
    return k, need + spare, spare


def signatures(s: np.ndarray, percent: int = 85) -> np.ndarray:
    """Distinct signatures of a sorted hash set."""
    if not len(s):
        return np.empty(0, np.int64)
    own = int(np.searchsorted(bands(percent)[1], len(s)))
    out = []
    for band in (own, own + 1):
        k, n1, spare = parts(percent, band)
        if k == 0:
            out.append(mix(np.array([np.bitwise_xor.reduce(mix(s + _GOLD)) + np.uint64(band)], np.uint64)))
            continue
        seed = 0
        while True:
            h = mix(s + np.uint64((2 * seed + 1) * int(_GOLD) & _MASK))
            piece = ((h >> np.uint64(32)) * np.uint64(3 * n1) >> np.uint64(32)).astype(np.int64)
            value = mix(h + _GOLD)
            order = np.argsort(piece, kind="stable")
            ends = np.searchsorted(piece[order], np.arange(3 * n1 + 1))
            cum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[order], dtype=np.uint64)])
            sums, sizes = (cum[ends[1:]] - cum[ends[:-1]]).reshape(n1, 3), np.diff(ends).reshape(n1, 3)
            part = np.arange(n1, dtype=np.uint64)
            whole, held = sums.sum(1, dtype=np.uint64), sizes.sum(1)
            for a, b in ((0, 1), (0, 2), (1, 2)):
                tag = mix((part * np.uint64(3) + np.uint64(a + b)) * _GOLD + np.uint64(band * 65536 + seed))
                sig = mix(mix(sums[:, a] + tag) * _GOLD + sums[:, b])
                empty = sizes[:, a] + sizes[:, b] == 0
                out.append(sig[~empty])
                for j in np.flatnonzero(empty & (held > 0)):
                    at = ends[3 * j + 3 - a - b]  # the third piece's first element
                    less = whole[j] - value[order[at:at + held[j]]]
                    family = np.concatenate([whole[j:j + 1], less[: held[j] if held[j] > 1 else 0]])
                    out.append(mix(mix(family * _GOLD + tag[j]) + np.uint64(1)))
            if np.count_nonzero(held < 2) <= spare:
                break
            seed += 1
    return np.unique(np.concatenate(out)).view(np.int64)


def signatures_of(sets: list[np.ndarray], percent: int = 85) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, place of the set) of many non-empty sets at once: those of
    ``signatures``. Sets for which a part holds empty pairs of
    pieces, or too many parts are poor, go the single way."""
    low, high = bands(percent)
    sigs, at, single = [], [], set()
    own = np.searchsorted(high, [len(s) for s in sets])
    for shift in (0, 1):
        shape = [parts(percent, int(b) + shift) for b in own]
        many = [i for i, (k, _, _) in enumerate(shape) if k]
        single |= {i for i, (k, _, _) in enumerate(shape) if not k}
        if not many:
            continue
        n1 = np.array([shape[i][1] for i in many])
        sizes = np.array([len(sets[i]) for i in many])
        first = np.concatenate([[0], np.cumsum(n1)[:-1]])          # each set's first part
        h = mix(np.concatenate([sets[i] for i in many]) + _GOLD)
        width = np.repeat(3 * n1, sizes).astype(np.uint64)
        piece = ((h >> np.uint64(32)) * width >> np.uint64(32)).astype(np.int64) + np.repeat(3 * first, sizes)
        total = int(n1.sum())
        sums, held = np.zeros(3 * total, np.uint64), np.bincount(piece, minlength=3 * total).reshape(total, 3)
        np.add.at(sums, piece, mix(h + _GOLD))
        sums = sums.reshape(total, 3)
        of = np.repeat(np.arange(len(many)), n1)
        part = (np.arange(total) - first[of]).astype(np.uint64)
        band = (own[np.array(many)] + shift).astype(np.uint64)[of]
        whole = held.sum(1)
        poor = np.bincount(of, whole < 2, minlength=len(many))
        odd = poor > np.array([shape[i][2] for i in many])
        for a, b in ((0, 1), (0, 2), (1, 2)):
            empty = held[:, a] + held[:, b] == 0
            odd |= np.bincount(of, empty & (whole > 0), minlength=len(many)) > 0
        single |= {many[j] for j in np.flatnonzero(odd)}
        kept = ~odd[of]
        for a, b in ((0, 1), (0, 2), (1, 2)):
            tag = mix((part * np.uint64(3) + np.uint64(a + b)) * _GOLD + band * np.uint64(65536))
            sig = mix(mix(sums[:, a] + tag) * _GOLD + sums[:, b])
            use = kept & (held[:, a] + held[:, b] > 0)
            sigs.append(sig[use])
            at.append(np.array(many)[of[use]])
    if sigs:    # a set that goes the single way in one of its bands does so in both
        both, of = np.concatenate(sigs), np.concatenate(at)
        use = ~np.isin(of, sorted(single))
        sigs, at = [both[use]], [of[use]]
    for i in sorted(single):
        own_sigs = signatures(sets[i], percent).view(np.uint64)
        sigs.append(own_sigs)
        at.append(np.full(len(own_sigs), i))
    if not sigs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(sigs).view(np.int64), np.concatenate(at).astype(np.int64)


def _bytes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("binary").alias("text"))


def _set_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of rows with their shingle sets: only the texts of one slice become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            rows = batch.slice(at, _BATCH)
            yield rows, shingle_sets([word_hashes(t) for t in rows["text"].to_pylist()], n)


def _blocks(pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int, width: int) -> pd.DataFrame:
    """part, keys, nodes, counts: a row per part of the keys' range that holds some of
    the pending (keys, place of the node, nodes). A key is cut to its last ``width``
    bytes, a node stands once for its keys in a row."""
    first = np.cumsum([0] + [len(v) for _, _, v in pending])
    keys = np.concatenate([k for k, _, _ in pending]).view(np.uint64)
    at = np.concatenate([a + f for (_, a, _), f in zip(pending, first)])
    nodes = np.concatenate([v for _, _, v in pending])
    order = np.argsort(at, kind="stable")
    part = ((keys[order] >> np.uint64(48)) * np.uint64(parts) >> np.uint64(16)).astype(np.uint16)
    order = order[np.argsort(part, kind="stable")]
    ends = np.cumsum(np.bincount(part, minlength=parts))
    keys, at = keys[order], at[order]
    raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    rows = []
    for p, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
        if a < b:
            runs = np.flatnonzero(np.r_[True, at[a + 1:b] != at[a:b - 1]])
            rows.append((p, raw[a:b].tobytes(), nodes[at[a:b][runs]].astype("<i8").tobytes(),
                         np.diff(np.r_[runs, b - a]).astype("<u4").tobytes()))
    return pd.DataFrame(rows, columns=["part", "keys", "nodes", "counts"])


def _unpacked(block: tuple[int, bytes, bytes, bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and nodes of a row of ``_blocks``; cut keys get their part instead."""
    part, keys, nodes, counts = block
    whole = np.zeros((len(keys) // width, 8), np.uint8)
    whole[:, :width] = np.frombuffer(keys, np.uint8).reshape(-1, width)
    found = whole.view("<u8").ravel()
    if width < 8:
        found |= np.uint64(int(part) << 48)
    return found, np.repeat(np.frombuffer(nodes, "<i8"), np.frombuffer(counts, "<u4"))


def shared_keys(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, nodes, number of nodes) of the distinct pairs whose key has several nodes."""
    order = np.argsort(keys)
    k = keys[order]
    same = k[1:] == k[:-1]
    hit = np.zeros(len(k), bool)
    hit[1:] |= same
    hit[:-1] |= same
    k, v = k[hit], nodes[order[hit]]
    if not len(k):
        return k, v, v
    order = np.lexsort((v, k))
    k, v = k[order], v[order]
    once = np.r_[True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])]
    k, v = k[once], v[once]
    sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, k[1:] != k[:-1]]), len(k)])
    often = np.repeat(sizes, sizes)
    return k[often > 1], v[often > 1], often[often > 1]


def _parts(docs: DataFrame) -> int:
    """Number of parts of the keys' range: a task matches those of some thousand sets."""
    return min(1 << 16, max(parallelism(docs.sparkSession), docs.count() // 5000))


_ROW = "doc_id long, text_key long, n_shingles long, node long"
_BLOCK_ROW = "part int, keys binary, nodes binary, counts binary"
_SIGNED_ROW = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("keys", "nodes", "counts")),
                         *((c, pa.int64()) for c in ("doc_id", "text_key", "n_shingles", "node"))])


def sign_rows(batches: Iterator[pa.RecordBatch], percent: int, n: int, parts: int) -> Iterator[pa.RecordBatch]:
    """A row for each text and, as soon as ``_PENDING`` signatures are held, their
    ``_blocks``; what a task holds does not depend on the size of a batch."""
    seen: set[int] = set()
    pending, held, row = [], 0, 0

    def packed() -> pa.RecordBatch:
        made = _blocks(pending, parts, 6)
        none = pa.nulls(len(made), pa.int64())
        return pa.RecordBatch.from_arrays([*(pa.array(made[c], f.type) for c, f in zip(made, _SIGNED_ROW)), *[none] * 4], schema=_SIGNED_ROW)

    for rows, sets in _set_batches(batches, n):
        nodes: list[int | None] = []
        new: dict[int, np.ndarray] = {}
        for s in sets:
            c = class_id(s) if len(s) else None
            nodes.append(c)
            if c is not None and c not in seen:
                if len(seen) >= _SEEN_LIMIT:
                    seen.clear()
                seen.add(c)
                new[c] = s
        none = pa.nulls(len(sets), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array((np.arange(row, row + len(sets)) % parts).astype(np.int32)), none, none, none, rows["doc_id"], rows["text_key"],
             pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64())], schema=_SIGNED_ROW)
        row += len(sets)
        if new:
            pending.append((*signatures_of(list(new.values()), percent), np.array(list(new))))
            held += len(pending[-1][0])
        if held >= _PENDING:
            yield packed()
            pending, held = [], 0
    if pending:
        yield packed()


def _signed(docs: DataFrame, percent: int, n: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """``sets`` (doc_id, text_key, n_shingles, node: the class id, null for empty sets) and
    ``members`` (sig, node of every signature that classes share: all of its classes).

    Texts are read once. A task signs each class about once (it repeats none that it has in
    mind); signatures travel in blocks by part, cut to six bytes besides their part.
    Signatures that are equal by that cut alone make a pair more to verify."""
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:   # Arrow: null ids stay whole numbers
        out = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_key", "n_shingles", "node", "sig")])
        found = []
        for batch in batches:
            plain = pc.is_null(batch["keys"])
            own = batch.filter(plain)
            yield pa.RecordBatch.from_arrays([*(own[c] for c in out.names[:4]), pa.nulls(len(own), pa.int64())], schema=out)
            blocks = batch.filter(pc.invert(plain)).select(["part", "keys", "nodes", "counts"])
            found += [_unpacked(tuple(b.values()), 6) for b in blocks.to_pylist()]
        if found:
            keys, nodes = map(np.concatenate, zip(*found))
            found.clear()
            sig, node, _ = shared_keys(keys, nodes)
            for at in range(0, len(sig), _PENDING):
                part = slice(at, at + _PENDING)
                none = pa.nulls(len(sig[part]), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array(node[part]), pa.array(sig[part].view(np.int64))], schema=out)

    packed = _bytes(docs).mapInArrow(lambda batches: sign_rows(batches, percent, n, parts), f"{_BLOCK_ROW}, {_ROW}")
    made = stage(packed.repartitionById(parts, F.col("part")).mapInArrow(match, f"{_ROW}, sig long"), "signed")
    return (made.where("sig is null").select("doc_id", "text_key", "n_shingles", "node"),
            made.where("sig is not null").select("sig", "node"))


def sketch(s: np.ndarray) -> np.ndarray:
    """Which of 1024 places of the hash domain hold an odd number of elements, as 16
    numbers: each element that two sets differ in changes one place."""
    odd = np.bincount((mix(s) >> np.uint64(54)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _least_distance(a: str, b: str) -> Column:
    """A lower bound of the Jaccard distance of two sets with sizes ``n<a>``, ``n<b>``
    and sketches ``bits<a>``, ``bits<b>``."""
    places = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"bits{a}")[i].bitwiseXOR(F.col(f"bits{b}")[i])) for i in range(16)))
    return 2 * places / (F.col(f"n{a}") + F.col(f"n{b}") + places)


class Verifier:
    """Exact similarity of class pairs; sets come from one row of each class."""

    def __init__(self, docs: DataFrame, sets: DataFrame, involved: DataFrame, percent: int, n: int):
        rep = (sets.join(involved, "node", "left_semi").groupBy("node")
               .agg(F.min(F.struct("doc_id", "n_shingles")).alias("r"))
               .select("node", "r.doc_id", "r.n_shingles"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, sets in _set_batches(batches, n):
                made = [s for s in sets if len(s)]
                if made:
                    sizes = np.array([len(s) for s in made])
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(np.concatenate(made).view(np.int64)))
                    bits = pa.ListArray.from_arrays(pa.array(np.arange(0, 16 * len(made) + 1, 16, dtype=np.int32)), pa.array(np.concatenate([sketch(s) for s in made])))
                    yield pa.RecordBatch.from_arrays([pa.array([class_id(s) for s in made]), pa.array(sizes), lists, bits], names=["node", "n", "s", "bits"])

        chosen = _bytes(docs.join(rep.select("doc_id").distinct(), "doc_id", "left_semi")
                         .unionByName(docs.where("doc_id is null"), allowMissingColumns=True))
        self.sets = stage(chosen.mapInArrow(run, "node long, n long, s array<bigint>, bits array<bigint>")
                          .join(involved, "node", "left_semi").dropDuplicates(["node"]), "verify-sets")
        self.percent = percent

    def compared(self, pairs: DataFrame, name: str, columns: list[Column], all_sizes: bool = False, linked: bool = False) -> DataFrame:
        """``columns`` of a, b, d (Jaccard distance) of distinct pairs a < b, written once.
        Without ``all_sizes``, pairs whose sizes rule a link out are left away; with
        ``linked``, those without a link."""
        n = self.sets.select("node", "n")
        near = (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
                .join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b"))
        if not all_sizes:
            near = near.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
        near = stage(near, "near")
        few = near.count() <= _FEW

        def side(c: str) -> DataFrame:
            """The sets of one side; where they are few, the others need not travel."""
            sets = self.sets.join(F.broadcast(near.select(F.col(c).alias("node")).distinct()), "node", "left_semi") if few else self.sets
            return sets.select(F.col("node").alias(c), F.col("s").alias(f"s{c}"))

        union = F.col("na") + F.col("nb") - F.col("c")
        found = near.join(side("a"), "a").join(side("b"), "b").withColumn("c", F.size(F.array_intersect("sa", "sb")))
        if linked:
            found = found.where(F.col("c") * 100 >= union * self.percent)
        out = stage(found.select("a", "b", (1 - F.col("c") / union).alias("d")).select(*columns), name)
        drop(near)
        return out

    def links(self, pairs: DataFrame) -> DataFrame:
        """a, b of the distinct pairs that reach the similarity, written once."""
        return self.compared(pairs, "links", [F.col("a"), F.col("b")], linked=True)

    def distances(self, pairs: DataFrame) -> DataFrame:
        """b, a, d for every given pair (b, a), written once."""
        a, b, d = F.col("a"), F.col("b"), F.col("d")
        both = F.array(F.struct(a, b, d), F.struct(b.alias("a"), a.alias("b"), d))
        return self.compared(pairs, "distances", [F.inline(both)], all_sizes=True)


def components(edges: DataFrame) -> DataFrame:
    """node, comp (smallest node of its component) of all nodes with an edge, by
    alternating large-star and small-star."""
    e = stage(edges.select("a", "b"), "star")
    before = None
    while True:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct())
        up = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = up.groupBy("a").agg(F.min("b").alias("m"))
        small = (up.join(low, "a").select("m", F.col("b").alias("x"))
                 .unionByName(low.select("m", F.col("a").alias("x")))
                 .where("m <> x").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct())
        old, e = e, stage(small, "star")
        drop(old)
        mark = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            out = e.select(F.col("b").alias("node"), F.col("a").alias("comp")).unionByName(
                e.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())
            out._staged_at = e._staged_at
            return out
        before = mark


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` after further links: only components that a new link joins to
    another one are looked at again."""
    side = lambda c: comp.select(F.col("node").alias(c), F.col("comp").alias("c" + c))
    edges = stage(links.join(side("a"), "a", "left").join(side("b"), "b", "left")
                  .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
                  .where("a <> b").distinct(), "joined")
    if edges.isEmpty():
        drop(edges)
        return comp
    over = components(edges)
    known = comp.unionByName(over.select("node", F.col("node").alias("comp"))
                             .join(comp.select("node"), "node", "left_anti"))
    out = stage(known.join(over.toDF("comp", "to"), "comp", "left")
                .select("node", F.coalesce("to", "comp").alias("comp")), "comp")
    drop(edges, comp, over)
    return out


def _placed(members: DataFrame, comp: DataFrame) -> DataFrame:
    """sig, node (and more columns), comp of the signatures whose classes lie in several components."""
    placed = members.drop("comp").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = placed.groupBy("sig").agg((F.min("comp") != F.max("comp")).alias("several")).where("several").select("sig")
    return placed.join(several, "sig", "left_semi").select(*(c for c in members.columns if c != "comp"), "comp")


def _leading(open_: DataFrame) -> DataFrame:
    """sig, x: the component with most classes in the signature."""
    sizes = open_.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("m"))
    return sizes.groupBy("sig").agg(F.max_by("comp", F.struct("m", "comp")).alias("x"))


def _round(open_: DataFrame, turn: int, tried: DataFrame | None) -> DataFrame:
    """a, b: one pair for each class b outside the leading component of one of its
    signatures, with a class a of that component. A signature offers the class
    that is first in this turn's order, so most signatures of b offer the same
    one; b takes the one that is offered most and not tried yet."""
    led = open_.join(_leading(open_), "sig")
    offer = led.where("comp = x").groupBy("sig").agg(F.min_by("node", F.xxhash64(F.lit(turn), "node")).alias("a"))
    votes = led.where("comp <> x").select("sig", F.col("node").alias("b")).join(offer, "sig") \
        .groupBy("b", "a").agg(F.count(F.lit(1)).alias("n"))
    votes = votes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("b").alias("of"), "n")
    if tried is not None:
        votes = votes.join(tried, ["a", "b"], "left_anti")
    best = votes.groupBy("of").agg(F.max_by(F.struct("a", "b"), F.struct("n", "a", "b")).alias("p"))
    return best.select("p.a", "p.b").distinct()


def prefix_marks(n: int, shared: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sig, side, partner) of a set of n elements, whose last ones in the common order
    are ``shared``, for every band of sizes that a set linked to it can have. If the
    first element two linked sets share is at place i, they share n - i at most, so
    both hold it among their first n - c + 1, c the least that such sizes must share.
    Sides part the sets of a mark by band: one side is compared with the other."""
    low, high = bands(99)
    own = int(np.searchsorted(high, n))
    least, most = -(-n * percent // 100), n * 100 // percent
    sig, side = [], []
    for other in range(int(np.searchsorted(high, least)), int(np.searchsorted(high, most)) + 1):
        common = -(-(n + max(least, int(low[other]))) * percent // (100 + percent))
        first = shared[:max(0, n - common + 1 - (n - len(shared)))]
        tag = np.array([min(own, other) << 32 | max(own, other)], np.uint64)
        sig.append(mix(mix(first.view(np.uint64) + _GOLD) + mix(tag)).view(np.int64))
        side.append(np.full(len(first), np.sign(own - other)))
    sides = np.concatenate(side)
    return np.concatenate(sig), sides, -sides


def _prefixes(open_: DataFrame, check: Verifier, parts: int) -> DataFrame:
    """sig, side, partner, node: ``prefix_marks`` of the classes of ``open_``; two of
    these with a link share one at least."""
    sets = check.sets.join(open_.select("node").distinct(), "node", "left_semi")
    percent = check.percent

    def elements(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            ends = np.cumsum(pdf["s"].map(len).to_numpy())
            for group in np.split(np.arange(len(pdf)), np.searchsorted(ends, np.arange(_PENDING, ends[-1], _PENDING)) if len(pdf) else []):
                if len(group):
                    own = [np.asarray(s, np.int64) for s in pdf["s"].iloc[group]]
                    at = np.repeat(np.arange(len(group)), [len(s) for s in own])
                    yield _blocks([(np.concatenate(own), at, pdf["node"].to_numpy()[group])], parts, 8)

    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [_unpacked(b, 8) for pdf in frames for b in pdf.itertuples(index=False)]
        if found:
            e, node, often = shared_keys(*map(np.concatenate, zip(*found)))
            yield pd.DataFrame({"node": node, "f": often, "e": e.view(np.int64)})

    # an element of one class only leads to nothing, but takes its place in the order
    shared = sets.select("node", "s").mapInPandas(elements, _BLOCK_ROW).repartitionById(parts, F.col("part")) \
        .mapInPandas(match, "node long, f long, e long")
    # before its elements, each class has a row with its size
    rows = shared.unionByName(sets.select("node", F.lit(0).cast("long").alias("f"), F.col("n").alias("e"))) \
        .repartition("node").sortWithinPartitions("node", "f", "e").select("node", "e")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, e = np.empty(0, np.int64), np.empty(0, np.int64)
        for pdf in chain(frames, [None]):
            if pdf is not None:
                node, e = np.r_[node, pdf["node"].to_numpy()], np.r_[e, pdf["e"].to_numpy()]
            if not len(node):
                continue
            starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            whole = len(starts) if pdf is None else len(starts) - 1     # the last one may go on
            ends = np.r_[starts[1:], len(node)]
            for i in range(0, whole, _BATCH):
                own = list(zip(starts[i:min(whole, i + _BATCH)].tolist(), ends[i:min(whole, i + _BATCH)].tolist()))
                made = [prefix_marks(int(e[a]), e[a + 1:b], percent) for a, b in own]
                sig, side, partner = (np.concatenate(x) for x in zip(*made))
                yield pd.DataFrame({"sig": sig, "side": side, "partner": partner,
                                    "node": np.repeat(node[[a for a, _ in own]], [len(m[0]) for m in made])})
            node, e = node[starts[-1]:], e[starts[-1]:]

    return rows.mapInPandas(run, "sig long, side int, partner int, node long")


def _settled(marks: DataFrame, check: Verifier, limit: float, comp: DataFrame) -> DataFrame:
    """``comp`` after all links that are left among the classes of ``marks``: (sig,
    side, partner, node, comp), a class is compared with those of its partner side.

    The distance is a metric, and a component is led by its smallest class: for
    classes b and a of components led by c and x, d(b, a) is at least
    d(c, x) - d(b, c) - d(a, x). Leaders are compared once per pair of components
    that share a mark; classes only where this bound leaves a link open. Both are
    compared only if their sketches do not rule it out already."""
    own = check.distances(marks.where("node <> comp").select(F.col("node").alias("b"), F.col("comp").alias("a")).distinct())
    rows = stage(marks.join(own.select(F.col("b").alias("node"), F.col("a").alias("comp"), "d"), ["node", "comp"], "left")
                 .select("sig", "side", "partner", "node", "comp", F.coalesce("d", F.lit(0.0)).alias("d")), "open-distances")
    sides = rows.groupBy("sig", "side", "partner", "comp").agg(F.max("d").alias("r"))
    sides = sides.join(check.sets.select(F.col("node").alias("comp"), "n", "bits"), "comp")
    c, x = sides.select("sig", "side", "partner", F.col("comp").alias("c"), F.col("r").alias("rc"), F.col("n").alias("nc"), F.col("bits").alias("bitsc")), \
        sides.select("sig", F.col("side").alias("partner"), F.col("comp").alias("x"), F.col("r").alias("rx"), F.col("n").alias("nx"), F.col("bits").alias("bitsx"))
    meets = stage(c.join(x, ["sig", "partner"]).where("c < x").where(_least_distance("c", "x") - F.col("rc") - F.col("rx") <= limit)
                  .select("sig", "side", "partner", "c", "x", "rc", "rx", "nx", "bitsx"), "meets")
    apart = check.distances(meets.select(F.col("c").alias("b"), F.col("x").alias("a")).distinct())
    comp = merged(comp, apart.where((F.col("d") <= limit) & (F.col("b") < F.col("a"))).select("a", "b"))
    # components that are still apart, and marks under which a link is possible
    name = lambda col: comp.select(F.col("node").alias(col), F.col("comp").alias(f"now_{col}"))
    left = stage(meets.join(apart.select(F.col("b").alias("c"), F.col("a").alias("x"), F.col("d").alias("dist")), ["c", "x"])
                 .where(F.col("dist") - F.col("rc") - F.col("rx") <= limit)
                 .join(name("c"), "c", "left").join(name("x"), "x", "left")
                 .where(F.coalesce("now_c", "c") != F.coalesce("now_x", "x"))
                 .select("sig", "side", "partner", "c", "x", "rx", "nx", "bitsx", "dist"), "left")
    sized = rows.join(check.sets.select("node", "n", "bits"), "node")
    of = lambda side, col, node: sized.select("sig", F.col("side").alias(side), F.col("comp").alias(col),
                                              F.col("node").alias(node), F.col("d").alias(f"d_{node}"),
                                              F.col("n").alias(f"n{node}"), F.col("bits").alias(f"bits{node}"))
    halves = left.join(of("side", "c", "b"), ["sig", "side", "c"]) \
        .where(F.greatest(F.col("dist") - F.col("d_b"), _least_distance("b", "x")) - F.col("rx") <= limit)
    pairs = halves.join(of("partner", "x", "a"), ["sig", "partner", "x"]) \
        .where(F.col("dist") - F.col("d_b") - F.col("d_a") <= limit).where(_least_distance("a", "b") <= limit).select("a", "b")
    new = check.links(pairs)
    out = merged(comp, new)
    drop(own, rows, meets, apart, left, new)
    return out


def _rounds(open_: DataFrame, check: Verifier, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What stays open of ``open_`` after rounds of one pair per class, and ``comp``
    after the links found."""
    tried = None
    for turn in range(ROUNDS):
        was, open_ = open_, stage(_placed(open_, comp), "open")
        drop(was)
        if open_.isEmpty():
            break
        pairs = stage(_round(open_, turn, tried), "pairs")
        links = check.links(pairs)
        found, looked = links.count(), pairs.count()
        comp = merged(comp, links)
        last, tried = tried, stage(pairs if tried is None else tried.unionByName(pairs), "tried")
        drop(links, pairs, last)
        forget(comp.sparkSession)
        if found * 20 < looked:     # the rest are hardly near copies: settle them
            break
    was, open_ = open_, stage(_placed(open_, comp), "open")
    drop(was, tried)
    return open_, comp


def _no_components(spark: SparkSession) -> DataFrame:
    """node, comp without rows, made by Spark alone: an empty list would start Python
    workers of another kind, which stay beside those of the texts."""
    return spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("comp"))


def _grouped(docs: DataFrame, percent: int, n: int) -> tuple[DataFrame, DataFrame]:
    """``sets`` and the component of every class with a link."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    parts = _parts(docs)
    sets, members = _signed(docs, percent, n, parts)
    involved = stage(members.select("node").distinct(), "involved")
    check = Verifier(docs, sets, involved, percent, n)
    drop(involved)
    forget(docs.sparkSession)

    comp = _no_components(docs.sparkSession)
    open_, comp = _rounds(members, check, comp)
    if not open_.isEmpty():
        was, open_ = open_, stage(_prefixes(open_, check, parts), "marks")
        drop(was)
        open_, comp = _rounds(open_, check, comp)
    # A metric: b can only link with classes a that have d(a, x) >= d(b, x) - limit.
    if not open_.isEmpty():
        comp = _settled(open_, check, 1 - percent / 100 + 1e-9, comp)
    drop(open_, check.sets)
    return sets, comp


def _named(sets: DataFrame, comp: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key, group, node of every row."""
    names = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("d"))
    labelled = names.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    ids = labelled.groupBy("comp").agg(F.min("d").alias("component_id"))
    final = labelled.join(ids, "comp").select("node", "comp", "component_id")
    return (sets.join(final, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_key",
                    F.col("comp").alias("group"), "node"))


def jaccard_components(docs: DataFrame, percent: int = 85, n: int = 4) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, text_key (hash of
    the text), node (the class: rows with equal sets) and group (the component's
    smallest class; both null for empty sets)."""
    return _named(*_grouped(docs, percent, n))


def keep_one(docs: DataFrame, percent: int = 85, n: int = 4) -> DataFrame:
    """``docs`` with one row of every component: the one with the smallest
    (doc_id, text hash). Rows with an empty set all stay."""
    found = stage(jaccard_components(docs, percent, n), "components")
    one = (found.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
           .select("k.*", F.lit(True).alias("_op6_one")))
    blank = found.where("group is null").select("doc_id", "text_key", F.lit(False).alias("_op6_one")).distinct()
    chosen = one.unionByName(blank).select(F.col("doc_id").alias("_op6_d"), F.col("text_key").alias("_op6_k"), "_op6_one")
    keyed = docs.withColumn("_op6_key", F.xxhash64("text"))
    same = Window.partitionBy("_op6_d", "_op6_k").orderBy("_op6_k")
    return (keyed.join(chosen, keyed["doc_id"].cast("long").eqNullSafe(F.col("_op6_d")) & (F.col("_op6_key") == F.col("_op6_k")))
            .withColumn("_op6_n", F.row_number().over(same)).where("not _op6_one or _op6_n = 1").select(*docs.columns))
