"""Token-ID output with a minimal perfect hash index (operator 1).

Documents are range-sorted by doc_id, equal ids by the hash of their texts, so that
an id (or none) that a third of all rows have is spread over many ranges; each
range is one shard file of raw ids (little-endian, 16 bits where the vocabulary
allows, else 32), document after document, each closed by the end id. Rows that
repeat a doc_id are records 0, 1, ... of that key in this order, over all shards.

Index files map a key (doc_id, record) to (shard, offset, length). A file holds
the keys of one hash bucket, in blocks of about ``BLOCK`` keys. Inside a block
keys fall into small groups, and each group stores one displacement under which
all its keys land in free slots of a table with exactly as many slots as keys
(hash and displace). A lookup hashes the key, reads one displacement and one
entry, and compares a stored 32-bit fingerprint: constant time, no keys stored,
and unknown keys are refused but for one in 2**32. Keys that share a 64-bit hash
make the index take the next hash seed.

Files are written under a temporary name and renamed, so a task that runs again
(a lost executor, speculation) replaces its own file with the same bytes. Paths
are opened with ``pyarrow.fs``, so the folder can be in any store that it reads.
The driver sees one row per shard, never one per document.

Defined cases: null or empty texts are one end id; a null doc_id is a key like
any other and sorts first; an empty table writes no file and gives an empty
result; other columns of the input never matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import parallelism, qualified, stage, store_of
from tablewright.llm.encode import as_uint32, encoder
from tablewright.llm.partenum_join import mix
from tablewright.session import work_path

BLOCK, GROUP = 1000, 4
MAGIC = b"TWIX1\0\0\0"
ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])
HEAD = np.dtype([("keys", "<u8"), ("groups", "<u8")])  # first key and first group of each block


def write_file(folder: str, name: str, data) -> None:
    """``data``: bytes, or a function that is given the open file."""
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as f:
        f.write(data) if isinstance(data, bytes) else data(f)
    store.move(draft, f"{path}/{name}")


def _hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block hash, group hash and fingerprint of 64-bit key hashes."""
    u = h.astype(np.int64).view(np.uint64)
    return mix(u + np.uint64(1)), mix(u + np.uint64(2)), (mix(u + np.uint64(3)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _slot(h: np.ndarray, turn, n) -> np.ndarray:
    u = h.astype(np.int64).view(np.uint64)
    return (mix(u + np.atleast_1d(turn).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            % np.asarray(n, np.uint64)).astype(np.int64)


def _place(h: np.ndarray, groups: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Displacement of every group and slot of every key of one block."""
    n = len(h)
    free, disp, slots = np.ones(n, bool), np.zeros(m, np.uint32), np.empty(n, np.int64)
    order = np.argsort(groups, kind="stable")
    ends = np.searchsorted(groups[order], np.arange(m + 1))
    shifts = np.arange(n)
    for g in sorted(range(m), key=lambda g: ends[g] - ends[g + 1]):
        own = order[ends[g]:ends[g + 1]]
        if not len(own):
            break
        turn = 0
        while True:
            base = _slot(h[own], turn + 1, n)
            if len(own) == 1 or len(np.unique(base)) == len(own):
                ok = free[(base[0] + shifts) % n]
                for b in base[1:]:
                    ok &= free[(b + shifts) % n]
                fit = np.argmax(ok)
                if ok[fit]:
                    break
            turn += 1
        disp[g] = turn * n + fit
        slots[own] = (base + fit) % n
        free[slots[own]] = False
    return disp, slots


def build_index(h: np.ndarray, shard, offset, length) -> bytes:
    """The index file of distinct 64-bit key hashes."""
    if len(np.unique(h)) != len(h):
        raise ValueError("two keys share a 64-bit hash: build with another seed")
    hb, hg, prints = _hashes(h)
    blocks = max(1, -(-len(h) // BLOCK))
    block = (hb % np.uint64(blocks)).astype(np.int64)
    sizes = np.bincount(block, minlength=blocks)
    per = np.maximum(1, -(-sizes // GROUP))
    head = np.zeros(blocks + 1, HEAD)
    head["keys"][1:], head["groups"][1:] = np.cumsum(sizes), np.cumsum(per)
    disp, entries = np.zeros(int(per.sum()), "<u4"), np.zeros(len(h), ENTRY)
    order = np.argsort(block, kind="stable")
    for b in range(blocks):
        own = order[int(head["keys"][b]):int(head["keys"][b + 1])]
        if len(own):
            m = int(per[b])
            d, s = _place(h[own], (hg[own] % np.uint64(m)).astype(np.int64), m)
            disp[int(head["groups"][b]):int(head["groups"][b]) + m] = d
            at = s + int(head["keys"][b])
            entries["print"][at], entries["shard"][at] = prints[own], np.asarray(shard)[own]
            entries["offset"][at], entries["length"][at] = np.asarray(offset)[own], np.asarray(length)[own]
    return MAGIC + np.uint64(blocks).tobytes() + head.tobytes() + disp.tobytes() + entries.tobytes()


class IndexFile:
    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not an index file")
        blocks = int(np.frombuffer(data, "<u8", 1, 8)[0])
        self.head = np.frombuffer(data, HEAD, blocks + 1, 16)
        at = 16 + self.head.nbytes
        self.disp = np.frombuffer(data, "<u4", int(self.head["groups"][-1]), at)
        self.entries = np.frombuffer(data, ENTRY, int(self.head["keys"][-1]), at + self.disp.nbytes)

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, entries) of key hashes; entries of keys not found mean nothing."""
        hb, hg, prints = _hashes(h)
        if not len(self.entries):
            return np.zeros(len(h), bool), np.zeros(len(h), ENTRY)
        b = (hb % np.uint64(len(self.head) - 1)).astype(np.int64)
        n = (self.head["keys"][b + 1] - self.head["keys"][b]).astype(np.int64)
        m = (self.head["groups"][b + 1] - self.head["groups"][b])
        d = self.disp[(self.head["groups"][b] + hg % m).astype(np.int64)].astype(np.int64)
        some = np.maximum(n, 1)
        slot = (_slot(h, d // some + 1, some) + d % some) % some
        at = np.minimum(self.head["keys"][b].astype(np.int64) + slot, len(self.entries) - 1)
        e = self.entries[at]
        return (e["print"] == prints) & (n > 0), e


def _read(folder: str, name: str) -> bytes:
    store, path = store_of(folder)
    with store.open_input_file(f"{path}/{name}") as f:
        return f.read()


def key_hash(seed: int):
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("record"), F.lit(seed))


def write(docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
          shards: int | None = None) -> DataFrame:
    """Writes shard files; returns doc_id, record, shard, offset, n_tokens (in ids)."""
    n = shards or parallelism(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")
    # rows that are equal in all of this are parted by chance: their bytes are the same
    by = [F.col("doc_id").asc_nulls_first(), "tie", "chance"]
    ordered = keyed.withColumn("chance", F.rand(7)).repartitionByRange(n, *by).sortWithinPartitions(*by)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard = encoder(tokenizer, spaced=True), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype).tobytes()
        store, path = store_of(folder)
        name, draft, f, at = f"ids-{shard:06d}.bin", "", None, 0
        last, record = object(), 0
        for pdf in parts:
            if f is None and len(pdf):
                store.create_dir(path, recursive=True)
                draft = f"{path}/.{name}.{uuid.uuid4().hex}"
                f = store.open_output_stream(draft)
            rows = []
            ids_of = enc.batches(pdf["text"])
            for doc, ids in zip(pdf["doc_id"].astype("Int64"), ids_of):
                same = (doc is pd.NA and last is pd.NA) or (doc is not pd.NA and last is not pd.NA and doc == last)
                last, record = doc, record + 1 if same else 0
                f.write(ids)
                f.write(end)
                n_ids = len(ids) // enc.dtype.itemsize + 1
                rows.append((doc, record, shard, at, n_ids))
                at += n_ids
            out = pd.DataFrame(rows, columns=["doc_id", "record", "shard", "offset", "n_tokens"])
            yield out.astype({"doc_id": "Int64"})
        if f is not None:
            f.close()
            store.move(draft, f"{path}/{name}")

    made = stage(ordered.mapInPandas(run, "doc_id long, record long, shard int, offset long, n_tokens long"), "manifest")
    # an id that goes on in the next shard: its records there come after those before
    order = Window.partitionBy("doc_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    over = made.groupBy("doc_id", "shard").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("before", F.sum("n").over(order) - F.col("n")).where("before > 0") \
        .select(F.col("doc_id").alias("_d"), F.col("shard").alias("_s"), "before")     # at most one row per shard
    return made.join(F.broadcast(over), made["doc_id"].eqNullSafe(F.col("_d")) & (made["shard"] == F.col("_s")), "left") \
        .select("doc_id", (F.col("record") + F.coalesce("before", F.lit(0))).alias("record"), "shard", "offset", "n_tokens")


def index(manifest: DataFrame, folder: str, keys_per_file: int = 50_000) -> tuple[int, int]:
    """Writes index files; returns their number (a function of the key count) and
    the hash seed, the first one under which all keys have hashes of their own."""
    keys, seed = manifest.count(), 0
    files = max(1, -(-keys // keys_per_file))
    while manifest.select(key_hash(seed).alias("h")).distinct().count() < keys:
        seed += 1

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        name = f"index-{int(pdf['file'].iloc[0]):06d}.bin"
        write_file(folder, name, build_index(pdf["h"].to_numpy(), pdf["shard"], pdf["offset"], pdf["n_tokens"]))
        return pd.DataFrame({"file": [pdf["file"].iloc[0]], "n_keys": [len(pdf)]})

    h = key_hash(seed)
    stage(manifest.select(F.pmod(h, F.lit(files)).cast("int").alias("file"), h.alias("h"), "shard",
                          "offset", "n_tokens").groupBy("file").applyInPandas(build, "file int, n_keys long"), "index-files")
    return files, seed


def lookup(keys: DataFrame, folder: str, files: int, seed: int = 0) -> DataFrame:
    """doc_id, record of ``keys`` with shard, offset, n_tokens; keys that the
    index does not hold are absent."""
    h = key_hash(seed)

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        found, e = IndexFile(_read(folder, f"index-{int(pdf['file'].iloc[0]):06d}.bin")).lookup(pdf["h"].to_numpy())
        out = pdf.loc[found, ["doc_id", "record"]].astype({"doc_id": "Int64"}).reset_index(drop=True)
        return out.assign(shard=e["shard"][found].astype(np.int32), offset=e["offset"][found].astype(np.int64),
                          n_tokens=e["length"][found].astype(np.int64))

    return (keys.select("doc_id", "record", h.alias("h"), F.pmod(h, F.lit(files)).cast("int").alias("file"))
            .groupBy("file").applyInPandas(find, "doc_id long, record long, shard int, offset long, n_tokens long"))


def read(entries: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """``entries`` with their ids (bytes, little-endian uint32), read back from
    the shard files in offset order."""
    n = parallelism(entries.sparkSession)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = encoder(tokenizer, spaced=True).dtype
        store, path = store_of(folder)
        shard, f = None, None
        for pdf in parts:
            for a in range(0, len(pdf), 1000):
                part = pdf.iloc[a:a + 1000]
                ids = []
                for s, at, k in zip(part["shard"], part["offset"], part["n_tokens"]):
                    if s != shard:
                        if f is not None:
                            f.close()
                        shard, f = s, store.open_input_file(f"{path}/ids-{s:06d}.bin")
                    f.seek(at * width.itemsize)
                    ids.append(as_uint32(f.read(k * width.itemsize), width))
                yield part.assign(doc_id=part["doc_id"].astype("Int64"), ids=ids)
        if f is not None:
            f.close()

    return (entries.repartition(n, "shard").sortWithinPartitions("shard", "offset")
            .mapInPandas(run, "doc_id long, record long, shard int, offset long, n_tokens long, ids binary"))


def round_trip(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Encodes, writes, indexes and reads back: doc_id, record, start, n_tokens,
    ids_crc32. ``start`` counts the ids of all documents before, over all shards."""
    spark = docs.sparkSession
    folder = qualified(spark, folder or work_path(spark, "llm", "token-shards", unique=True))
    manifest = write(docs, folder, **options)
    layout = index(manifest, folder)
    totals = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # a row per file
    starts, at = [], 0
    for r in totals:
        starts.append((r["shard"], at))
        at += r["n"]
    first = spark.createDataFrame(starts, "shard int, first long")
    back = read(lookup(manifest.select("doc_id", "record"), folder, *layout), folder)
    # a row per shard file: bounded by the number of partitions
    return (back.withColumn("ids_crc32", F.crc32("ids")).drop("ids").join(F.broadcast(first), "shard")
            .select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "record", "shard"))
