"""Prefix trie, personal data and hard negatives against plain brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import lemp_negatives, pii_disclosure, prefix_trie

# ------------------------------------------------------------------ trie


def _convs(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in by.items()}


def _rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    return out


def _trie(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1]) if k else 0) + sum(saved[x] for x in kids[k])
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(kids[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def _got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def _rows(seed=5):
    rng = random.Random(seed)
    rows = [(None, 0, "user", "nobody's"), (7, None, None, "null turn first"), (7, 0, "user", None), (7, 1, None, None),
            (8, 3, "user", ""), (8, 3, "user", ""), (-130, 0, "user", "negative"), (-100, 0, "user", "base of it")]
    for c in (100, 101, 102, 150, 199, 205, 300, 301, 302, 303, 304):   # 200 is absent
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["ab", "c", "déf", "x" * 5])))
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1040) for t in range(3)]   # many equal conversations
    rows += [(5000, t, "user", f"long {t}") for t in range(2500)]                        # one holds most turns
    rows += [(5001, t, "user", f"long {t}" if t < 1200 else "fork") for t in range(1300)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("small", [False, True])
def test_trie_is_the_brute_force_trie(spark, monkeypatch, small):
    if small:       # many heavy nodes, several tables and parts, long conversations cut into parts
        monkeypatch.setattr(prefix_trie, "LEAST_PIECE", 20)
        monkeypatch.setattr(prefix_trie, "BLOCK", 64)
        monkeypatch.setattr(prefix_trie, "FEW", 0)
    df = spark.createDataFrame(_rows(), SCHEMA).withColumn("d1", F.lit("clash")).withColumn("size", F.lit(0)).repartition(5)
    convs = _convs(_rows())
    assert _got(prefix_trie.rebuilt_trie(df)) == _trie(_rebuilt(convs))
    if small:
        assert _got(prefix_trie.prefix_trie(df)) == _trie(convs)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.rebuilt_trie(none).collect() == []
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []


def test_colliding_digests_take_the_next_seed(spark, monkeypatch):
    whole, seeds = prefix_trie.paths, []

    def colliding(turns, seed):
        seeds.append(seed)
        out = whole(turns, seed)
        return out if seed else out.withColumn("d1", F.lit(1).cast("long")).withColumn("d2", F.lit(1).cast("long"))
    monkeypatch.setattr(prefix_trie, "paths", colliding)
    rows = [(c, t, "user", f"{c % 3}-{t}") for c in range(9) for t in range(3)]
    assert _got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == _trie(_convs(rows))
    assert seeds == [0, 1]


@pytest.mark.parametrize("n", [1, 2, 17, 5000])
def test_slot_table_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    k1, k2 = rng.integers(-2**62, 2**62, n), rng.integers(-2**62, 2**62, n)
    k1[: n // 2] = 7            # half of all keys share a lane
    table = prefix_trie.SlotTable(k1, k2)
    assert sorted(table.slots) == list(range(n))
    assert (table.find(k1, k2) == table.slots).all()
    assert (table.find(k1, k2 + 1) == -1).all()


# ------------------------------------------------------------------ personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _base(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", m) for m in EMAIL.finditer(t)]
    out += [("ip", m) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", m) for m in CARD.finditer(t) if 14 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    out += [("phone", m) for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]
    kinds = ["email", "ip", "card", "phone"]
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda x: (x[1], kinds.index(x[0])))


HOSTILE = [
    "a@b.c@d.e a@b.c_d@e.f a@b.c.@x.y @x.y a@@b.c a@b a@b. a@b.c.. .@-.-", "x%y+z@host-1.example.com, (me@here.org).",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.1 1.2.3 1..2.3.4 999999999999999999999.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111 1111  1111 1111 - 4111111111111111 0000000000000000000 00000000000000 1-2-3", "+1 (743) 555-3824 +1-- +12 345 +4412345678901234",
    "++1 555 555 5555 +1.555.555.5555- + 1 555 555 5555 +1(((((((((2", "", "٣٣٣٣٣٣٣٣٣٣٣٣٣٣٣ é@é.é ñ+1 555 555 5555",
]


@pytest.mark.parametrize("text", HOSTILE)
def test_base_spans_are_the_plain_patterns(text):
    assert pii_disclosure.base_spans(text) == _base(text)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice("a1.@+- ()%_9") for _ in range(rng.randint(0, 60)))
        assert pii_disclosure.base_spans(t) == _base(t), t


def test_base_spans_take_linear_time():
    for t in ("a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "+1" + "-" * 2_000_000, "a@" * 500_000, "1 " * 500_000):
        pii_disclosure.base_spans(t)


def _terms(t, spans):
    out = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", t):
        core = m.group().strip(pii_disclosure.PUNCTUATION)
        a = m.start() + m.group().find(core) if core else 0
        if core and not any(x < a + len(core) and a < y for _, x, y in spans):
            out.append((a, a + len(core), core.translate(pii_disclosure._LOWER)))
    return out


def _brute(docs):
    """doc index -> spans, straight from the definition."""
    texts = [t or "" for _, t in docs]
    spans = [_base(t) for t in texts]
    terms = [_terms(t, s) for t, s in zip(texts, spans)]
    n, n_c, n_ct, wins, by_text = len(texts), Counter(), Counter(), defaultdict(set), defaultdict(set)
    near = []
    for t, s, ts in zip(texts, spans, terms):
        mine = set()
        for kind, a, b in s:
            k = sum(x < a for x, _, _ in ts)
            around = [w for _, _, w in ts[max(0, k - 8):k + 8]]
            e = pii_disclosure.entity(kind, t[a:b])
            for w in around:
                mine.add((e, w))
                wins[e, w].add(tuple(around))
                by_text[e, w].add(t)
        near.append(mine)
        n_c.update({e for e, _ in mine})
        n_ct.update(mine)
    n_t = Counter(w for t in texts for w in {x.strip(pii_disclosure.PUNCTUATION).translate(pii_disclosure._LOWER)
                                             for x in re.findall(r"[^\x20\x09-\x0D]+", t)})
    tells = {p for p, k in n_ct.items() if len(by_text[p]) >= 2 and len(wins[p]) >= 2
             and k / n_t[p[1]] >= (n_c[p[0]] / n) ** 0.2}
    order = ["email", "ip", "card", "phone", "term"]
    return [sorted(s + [("term", a, b) for a, b, w in ts if any(p in tells for p in mine if p[1] == w)],
                   key=lambda x: (x[1], order.index(x[0]))) for s, ts, mine in zip(spans, terms, near)]


def _corpus():
    filler = lambda i: " ".join(f"plain{(i * 31 + k * 7) % 50}" for k in range(30))
    docs = [(i, filler(i)) for i in range(60)]
    docs += [(100 + i, f"{filler(i)} Write to Zebulon, at zeb{'@'}corp.example.com please. {filler(i + 9)} zebulon") for i in range(4)]
    docs += [(200, f"copied once with quirk +1 (743) 555-3824 {filler(1)}")] * 5                    # copies are no evidence
    docs += [(300 + i, f"{filler(i)} room{i} 12{i} server 10.0.0.7 {filler(i + 3)}") for i in range(3)]
    docs += [(400, None), (401, ""), (None, "call +1 (743) 555-3824 now"), (400, "twice 10.0.0.7")]
    return docs


def test_scan_is_the_definition(spark, monkeypatch):
    docs = _corpus()
    want = Counter((d, ",".join(f"{k}:{a}:{b}" for k, a, b in s)) for (d, _), s in zip(docs, _brute(docs)))
    df = spark.createDataFrame([(d, t, "clash", 1.0) for d, t in docs], "doc_id long, text string, term string, n_email double").repartition(4)
    got = pii_disclosure.scan(df).collect()
    assert Counter((r.doc_id, r.spans) for r in got) == want
    assert any("term:" in r.spans for r in got)
    zeb = [r for r in got if r.doc_id == 100][0]
    text = dict(docs)[100]
    named = {text[int(a):int(b)] for k, a, b in (s.split(":") for s in zeb.spans.split(",")) if k == "term"}
    assert "Zebulon" in named and "zebulon" in named
    assert all("term" not in r.spans for r in got if r.doc_id == 200 or (r.doc_id or 0) < 60)
    base = {r.doc_id: r.base_sha256 for r in got}
    assert base[100] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in _base(text)).encode()).hexdigest()
    monkeypatch.setattr(pii_disclosure, "FEW", 0)      # the way for very many terms
    assert Counter((r.doc_id, r.spans) for r in pii_disclosure.scan(df).collect()) == want


def test_sanitised_texts(spark):
    df = spark.createDataFrame([(d, t, "kept") for d, t in _corpus()], "doc_id long, text string, told string")
    out = pii_disclosure.sanitise(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(_corpus()) and all(r.told == "kept" for r in got)
    one = [r.text for r in got if r.doc_id == 101][0]
    assert "[EMAIL]" in one and "ebulon" not in one and "Write to" not in one and "plain7" in one
    assert [r.text for r in got if r.doc_id == 5] == [dict(_corpus())[5]]


def test_personal_data_of_nothing(spark):
    assert pii_disclosure.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# ------------------------------------------------------------------ hard negatives


def _negatives(rows):
    ok = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v])
          for i, label, v in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = lambda s, k: sorted(s, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
    out = []
    for a, la, va in ok:
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in ok if i != a]
        for ps, p, _ in first([s for s in scored if s[2] == la], 5):
            band = [s for s in scored if s[2] != la and 30 * ps <= 100 * s[0] <= 90 * ps]
            out += [(a, p, r, i, ps, s) for r, (s, i, _) in enumerate(first(band, 10), 1)]
    return sorted(out, key=str)


EMB = "vec_id long, label int, embedding array<float>"


def _vectors(n, dim, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dim))
    return [(i, int(i % 10), (scale * (centres[i % 10] * rng.uniform(0, 1.5) + rng.normal(size=dim) * 0.4)).astype(np.float32).tolist())
            for i in range(n)]


@pytest.mark.parametrize("dim,bucket", [(8, 16), (64, 1024), (2, 8)])
def test_hard_negatives_are_the_definition(spark, monkeypatch, dim, bucket):
    monkeypatch.setattr(lemp_negatives, "BUCKET", bucket)   # in this process; tasks import the module's own
    rows = _vectors(420, dim, dim)
    rows += [(1000 + i, 3, rows[13][2]) for i in range(30)]                       # equal vectors: ties by id
    rows += [(None, 2, rows[5][2]), (2000, None, rows[1][2]), (2001, 1, None), (2100, 1, [None] + rows[1][2][1:]),
             (2200, 1, [float("nan")] + rows[1][2][1:]), (2300, 1, [float("inf")] + rows[1][2][1:]), (2400, 4, [0.0] * dim)]
    df = spark.createDataFrame(rows, EMB).withColumn("score", F.lit("clash")).withColumn("a", F.lit(1)).repartition(4)
    got = sorted((tuple(r) for r in lemp_negatives.hard_negatives(df).collect()), key=str)
    assert got == _negatives(rows) and len(got) > 50


def test_anchor_blocks_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(lemp_negatives, "ANCHORS", 2)
    rows = _vectors(310, 6, 1) + [(i, label, [x * 1e6 for x in v]) for i, label, v in
                                  [(r[0] + 1000, r[1], r[2]) for r in _vectors(110, 6, 2)]]
    rows = [(i, label, np.float32(v).tolist()) for i, label, v in rows]
    got = sorted((tuple(r) for r in lemp_negatives.hard_negatives(spark.createDataFrame(rows, EMB)).collect()), key=str)
    assert got == _negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert lemp_negatives.hard_negatives(spark.createDataFrame([], EMB)).collect() == []
    assert lemp_negatives.hard_negatives(spark.createDataFrame([(1, 1, [1.0])], EMB)).collect() == []
    alone = spark.createDataFrame([(100, 1, [1.0]), (200, 2, [])], EMB)
    assert lemp_negatives.hard_negatives(alone).collect() == []


def test_candidates_prune_and_lose_nothing():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16)) * 300
    rows = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 25).astype(np.int64)
    q = lemp_negatives.Anchors(np.arange(20), np.zeros(20), rows[:20])
    exact = rows[:20] @ rows.T
    least = np.partition(exact, -20, axis=1)[:, -20].astype(float)      # the 20 best of each
    seen, checked = [set() for _ in range(20)], 0
    for b in lemp_negatives.buckets(np.arange(4000), np.zeros(4000), rows):
        for a, at, scores in lemp_negatives.candidates(q, b, least):
            ids = b.ids if at is None else b.ids[at]
            checked += len(ids)
            assert (scores == exact[a][ids]).all()
            seen[a] |= set(ids[scores >= least[a]].tolist())
    assert all(seen[a] == set(np.flatnonzero(exact[a] >= least[a]).tolist()) for a in range(20))
    assert checked < 0.2 * 20 * 4000
