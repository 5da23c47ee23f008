"""Packing along a space-filling curve (operator 2).

Every document becomes token ids plus an end id and a hashed count vector of
its ids, projected to a few dimensions by a fixed random matrix and put on a
Hilbert curve. The documents are range-sorted by (curve key, doc_id hash), so
documents with like words become neighbours and a group of copies (one key) can
still be split over tasks. Each range is cut into sequences along the curve: a
sequence is full, or, at the end of a range, the rest is split into power-of-two
lengths, which need no padding. So no token is padded, dropped or repeated.

Token ids are written once before the range sort (its sampling then reads two
narrow columns' worth of work, not the tokenizer again).

Defined cases: a null or empty text is one end id; repeated rows and repeated
or null doc_ids are separate documents; very long texts run over as many
sequences as they need; an empty table gives an empty result; other columns of
the input never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import parallelism, stage
from tablewright.llm.encode import encoder

DIMS, BITS, SLOTS = 4, 10, 4096


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Curve positions of integer points (n, dims) with ``bits`` bits each
    (Skilling, "Programming the Hilbert curve", 2004)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] ^= np.where(on, 0, swap) if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection(seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(SLOTS, DIMS))


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Projected unit vectors to curve keys; a fixed scale, so a document's key
    depends on that document alone."""
    cells = np.clip((np.tanh(vectors) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert(cells)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids (bytes, with the end id), width, curve key, tie."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, proj = encoder(tokenizer, spaced=False), _projection()
        end = np.array([end_id], enc.dtype).tobytes()
        for pdf in parts:
            ids = [b + end for b in enc.batches(pdf["text"])]
            vec = np.empty((len(ids), DIMS))
            for i, b in enumerate(ids):
                slot = (np.frombuffer(b, enc.dtype).astype(np.int64) * 2654435761 >> 7) & (SLOTS - 1)
                tf = np.sqrt(np.bincount(slot, minlength=SLOTS))
                vec[i] = tf @ proj / np.linalg.norm(tf)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "ids": ids,
                                "width": enc.dtype.itemsize, "curve": curve_keys(vec) if len(ids) else []})

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInPandas(run, "doc_id long, ids binary, width int, curve long")
            .withColumn("tie", F.xxhash64("doc_id", "ids")))


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, length: int = 2048,
         partitions: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32),
    doc_tokens, sequence_id, offset."""
    # equal rows tie in all of this but the last: any order of them is the same
    ordered = (stage(tokenised(docs, tokenizer, end_id), "packing").withColumn("chance", F.rand(5))
               .repartitionByRange(partitions or parallelism(docs.sparkSession), "curve", "tie", "chance")
               .sortWithinPartitions("curve", "tie", "doc_id"))
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, seq, fill = TaskContext.get().partitionId() << 40, 0, 0
        open_: list[tuple] = []  # pieces of the open sequence: at most `length` tokens

        def frame(rows):
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        for pdf in parts:
            rows = []
            for doc, raw, width in zip(pdf["doc_id"], pdf["ids"], pdf["width"]):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                at = 0
                while at < len(ids):
                    n = min(length - fill, len(ids) - at)
                    open_.append((doc, at, n, ids[at:at + n].tobytes(), len(ids), base + seq, fill))
                    at, fill = at + n, fill + n
                    if fill == length:
                        rows += open_
                        open_, seq, fill = [], seq + 1, 0
            if rows:
                yield frame(rows)
        rows, left = [], fill  # the rest, in sequences of power-of-two lengths
        room, used = 0, 0
        for doc, at, n, raw, total, _, _ in open_:
            done = 0
            while done < n:
                if not room:
                    room, used = 1 << (left.bit_length() - 1), 0
                take = min(room, n - done)
                rows.append((doc, at + done, take, raw[4 * done:4 * (done + take)], total, base + seq, used))
                done, room, used, left = done + take, room - take, used + take, left - take
                if not room:
                    seq += 1
        if rows:
            yield frame(rows)

    return ordered.mapInPandas(run, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                    "sequence_id long, offset long")
