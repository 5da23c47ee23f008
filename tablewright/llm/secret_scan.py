"""Secret scans (operator 7): fixed patterns plus character Markov models.

Two first-order Markov chains over characters are trained from labelled
samples: one on random strings, one on ordinary identifiers. A token that no
pattern covers is a secret if its log-likelihood ratio per character is above a
threshold, which is set on a labelled part that training does not see.

Texts never move: detection is one narrow pass with whole texts; models are
about 100 KB. Offsets are code points, ends exclusive.

Defined cases: null and empty texts have no spans; repeated rows repeat their
result; a null doc_id stays; an empty table gives an empty result; other
columns are passed through, but for the one that it names (``into``); spans of different kinds may overlap,
the added kind ``random`` never overlaps any base span.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")  # [0-9a-f]+ of 24 characters or more
KINDS = ("assign", "access", "hex", "random")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
_CODE = {c: i + 1 for i, c in enumerate(ALPHABET)}  # 0: start and any other character
SAMPLE_DOCS, SAMPLE_WORDS = 400, 20_000
RESULT = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base:string,spans:string,found:array<struct<kind:string,start:bigint,end:bigint>>>"


def _codes(s: str) -> np.ndarray:
    return np.array([0, *[_CODE.get(c, 0) for c in s]])


def chain(samples: list[str], smooth: float = 0.5) -> np.ndarray:
    """Log transition probabilities of a first-order chain."""
    n = len(ALPHABET) + 1
    counts = np.full((n, n), smooth)
    for s in samples:
        c = _codes(s)
        np.add.at(counts, (c[:-1], c[1:]), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


class Model:
    def __init__(self, ratio: np.ndarray, threshold: float):
        self.ratio, self.threshold = ratio, threshold

    def llr(self, s: str) -> float:
        """Log-likelihood ratio per character, random against ordinary."""
        c = _codes(s)
        return float(self.ratio[c[:-1], c[1:]].sum() / max(1, len(s)))


def train(samples: list[tuple[str, int]]) -> Model:
    """``samples``: (string, label), 1 for random strings. Every fifth string
    is kept for the threshold: midway between the ordinary strings' highest
    ratio and the random strings' first percentile, never below the former."""
    fit, held = [s for i, s in enumerate(samples) if i % 5], samples[::5]
    ratio = chain([s for s, y in fit if y]) - chain([s for s, y in fit if not y])
    m = Model(ratio, 0.0)
    low = max((m.llr(s) for s, y in held if not y), default=0.0)
    high = np.quantile([m.llr(s) for s, y in held if y] or [low + 1], 0.01)
    return Model(ratio, max(low, (low + float(high)) / 2, 0.0))


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS,
                     seed: int = 11) -> list[tuple[str, int]]:
    """Random strings over usual key alphabets (1) and ordinary identifiers (0):
    words of the ``sample_docs`` texts with the smallest hash (whole texts; at
    most ``sample_words`` distinct words, again those with the smallest hash),
    joined as identifiers are. Words that hold a base match or digits are left out.
    Texts stay in the tasks; the driver gets hashes and words."""
    rng = random.Random(seed)

    @F.pandas_udf("array<string>")
    def identifiers(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(set(re.findall(
            r"(?<![^\W_])[A-Za-z]{2,}(?![^\W_])", HEX.sub(" ", ACCESS.sub(" ", ASSIGN.sub(" ", t)))))))

    keyed = docs.where(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("o"))
    chosen = [r["o"] for r in keyed.select("o").distinct().orderBy("o").limit(sample_docs).collect()]
    found = (keyed.where(F.col("o") <= chosen[-1]).dropDuplicates(["o"]).select(F.explode(identifiers("text")).alias("w")).distinct()
             .orderBy(F.xxhash64("w"), "w").limit(sample_words).collect()) if chosen else []
    plain = sorted(r["w"] for r in found)
    plain = plain or ["the", "name", "value", "count", "first", "second", "table", "index"]
    out = []
    for _ in range(4000):
        n = rng.randint(20, 48)
        kind = rng.choice((string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
                           string.ascii_uppercase + string.digits, string.digits + "abcdef",
                           string.ascii_lowercase + string.digits))
        out.append(("".join(rng.choice(kind) for _ in range(n)), 1))
        ws = [rng.choice(plain) for _ in range(rng.randint(2, 6))]
        style = rng.randrange(5)
        s = ("_".join(ws) if style == 0 else "".join(w.capitalize() for w in ws) if style == 1
             else "-".join(ws) if style == 2 else "_".join(ws).upper() if style == 3 else "/".join(ws))
        out.append((s + rng.choice(("", "", "_2", "-01", "2024")), 0))
    return out


def find(text: str | None, model: Model | None) -> tuple[int, int, int, str, str, list]:
    text = text or ""
    base = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    n_assign = len(base)
    base += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    n_access = len(base) - n_assign
    base += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    n_hex = len(base) - n_assign - n_access
    base.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    found = list(base)
    if model is not None:
        for m in TOKEN.finditer(text):
            s = m.group()
            # an ordinary word has no digit and one case; the chains judge the rest
            if (s.isalpha() and (s.islower() or s[1:].islower() or s.isupper())) or \
                    any(a < m.end() and m.start() < b for _, a, b in base):
                continue
            if model.llr(s) > model.threshold:
                found.append(("random", m.start(), m.end()))
        found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return n_assign, n_access, n_hex, hashlib.sha256(join(base).encode()).hexdigest(), join(found), found


def scan(docs: DataFrame, model: Model | None, into: str = "secrets") -> DataFrame:
    """``docs`` with a column ``into`` (struct of ``RESULT``), which replaces a
    column of that name."""
    @F.pandas_udf(RESULT)
    def scanned(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = [find(t, model) for t in s]
            yield pd.DataFrame({
                "n_assign": [r[0] for r in rows], "n_access": [r[1] for r in rows], "n_hex": [r[2] for r in rows],
                "base": [r[3] for r in rows], "spans": [r[4] for r in rows],
                "found": [[{"kind": k, "start": a, "end": b} for k, a, b in r[5]] for r in rows]})

    return docs.withColumn(into, scanned("text"))


def redact(docs: DataFrame, model: Model | None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced in ``text``; overlapping spans go as
    one. For assignments the whole match goes. ``n_chars``, if it is there,
    follows the new text. Texts without a span are not touched."""
    @F.pandas_udf("string")
    def cleaned(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            out = []
            for t in s:
                spans = find(t, model)[5]
                if spans:
                    parts, at = [], 0
                    for _, a, b in spans:
                        if a >= at:
                            parts += [t[at:a], mark]
                        at = max(at, b)
                    t = "".join([*parts, t[at:]])
                out.append(t)
            yield pd.Series(out, dtype=object)

    out = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
