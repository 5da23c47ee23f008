"""What Python workers hold: during a task of the join, and between tasks."""

import random

import numpy as np
import pyarrow as pa

from tablewright.llm import common, encode, partenum_join


def _texts(rows):
    rng = random.Random(5)
    out = [" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randint(20, 60))) for _ in range(rows)]
    return [None, "", *out, *out[:30]]


def test_a_task_passes_signatures_on_while_it_reads_a_batch(monkeypatch):
    monkeypatch.setattr(partenum_join, "_PENDING", 5000)
    texts = _texts(1500)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))),
                                        pa.array([t if t is None else t.encode() for t in texts], pa.binary())], ["doc_id", "text_key", "text"])
    found, rows, most = set(), [], 0
    for made in partenum_join.sign_rows(iter([batch]), 80, 5, 7):
        blocks = [r for r in made.to_pylist() if r["keys"] is not None]
        rows += [r for r in made.to_pylist() if r["keys"] is None]
        most = max(most, sum(len(r["keys"]) // 6 for r in blocks))
        for r in blocks:
            keys, nodes = partenum_join._unpacked((r["part"], r["keys"], r["nodes"], r["counts"]), 6)
            found |= set(zip(keys.tolist(), nodes.tolist()))
    sets = [partenum_join.shingle_set(partenum_join.word_hashes(t and t.encode()), 5) for t in texts]
    ids = [partenum_join.class_id(s) if len(s) else None for s in sets]
    assert [(r["doc_id"], r["text_key"], r["n_shingles"], r["node"]) for r in rows] == [(i, i, len(s), c) for i, (s, c) in enumerate(zip(sets, ids))]
    cut = np.uint64((1 << 48) - 1)
    parts = lambda k: (k >> np.uint64(48)) * np.uint64(7) >> np.uint64(16) << np.uint64(48)
    expected = set()
    for s, c in zip(sets, ids):
        k = partenum_join.signatures(s, 80).view(np.uint64)
        expected |= {(x, c) for x in (k & cut | parts(k)).tolist()}
    slice_ = max(sum(len(partenum_join.signatures(s, 80)) for s in sets[a:a + 256]) for a in range(0, len(sets), 256))
    assert found == expected and 5000 < most <= 5000 + slice_ < len(found) / 2


def test_a_worker_keeps_the_words_of_one_operator_only():
    kind = ("encoder", "word_bpe_49k.json", False)
    encode.encoder(*kind[1:]).encode(["some words here"])
    assert list(common._KEPT) == [kind]
    partenum_join.word_hashes(b"some words")
    assert len(common._KEPT) == 1 and kind not in common._KEPT
    words = next(iter(common._KEPT.values()))
    partenum_join.word_hashes(b"more words")
    assert next(iter(common._KEPT.values())) is words and len(words) == 3


def test_no_components_need_no_python_worker(spark):
    none = partenum_join._no_components(spark)
    assert none.dtypes == [("node", "bigint"), ("comp", "bigint")] and none.collect() == []
    assert "ExistingRDD" not in none._jdf.queryExecution().toString()
