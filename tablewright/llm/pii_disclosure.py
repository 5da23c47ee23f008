"""Personal data (operator 12): fixed patterns plus information-theoretic
sanitisation of the terms that reveal them.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Their
values are the protected entities. A term (a blank-separated word without outer
punctuation, A-Z lower-cased) near an entity may give it away although the entity
itself is removed. How much it does is estimated from the corpus, with document
frequencies over all rows: N rows, n(c) with entity c, n(t) with term t anywhere,
n(c, t) with t at most ``WINDOW`` words from c. A term discloses the entity when
its pointwise mutual information reaches the entity's information content
divided by ``ALPHA``:

    log n(c,t) N / (n(c) n(t))  >=  -log(n(c) / N) / ALPHA

that is n(c,t) / n(t) >= (n(c) / N) ** (1 - 1 / ALPHA). It must also have been
seen with the entity in two different texts and two different surroundings, so a
text or passage that is only copied is no evidence. All occurrences of a
disclosing term in a text where it is near its entity become spans of kind
``term``; texts without base spans get none. A term is generalised (digits to #,
three characters, *) if its general form does not disclose the entity, else it
is removed.

Plan: one pass over the texts finds base spans and emits, per text with an
entity, its distinct (entity, term, surroundings) rows; it is written once. Counts
are aggregates with map-side combining. n(t) comes from a second pass over all
words: only terms that some entity has twice are counted, if these are at most
``FEW`` and can be sent to all tasks, else all terms are counted and joined.

Defined cases: null and empty texts have no spans; rows that repeat a doc_id or
a text are rows of their own; a null doc_id stays; an empty table gives an empty
result; ties cannot change a result; other columns never matter. Patterns and
words take time in proportion to the text, whatever it holds.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stage

# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")  # after the @ of an address
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "term")

WINDOW, ALPHA, SUPPORT, FEW, CACHED = 8, 1.25, 2, 200_000, 500_000
PUNCTUATION = ".,;:!?()[]{}<>\"'`*_|/\\«»“”„‘’…–—"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_DIGITS = str.maketrans("0123456789", "##########")
_NOT_DIGIT = re.compile(r"[^0-9]+")
CHUNK = 2_000_000  # characters of emitted rows held at once


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping. Each @ is looked at once, and the characters
    before it are walked once, so long runs without a domain cost no more."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return _ordered(out)


def _ordered(spans: list) -> list:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def entity(kind: str, value: str) -> str:
    """One id for all spellings of a value."""
    plain = value.translate(_LOWER) if kind in ("email", "ip") else _NOT_DIGIT.sub("", value)
    return hashlib.md5(f"{kind}:{plain}".encode("utf-8", "surrogatepass")).hexdigest()


def general(term: str) -> str:
    """The general form of a term."""
    return term.translate(_DIGITS)[:3] + "*"


def terms(text: str, spans: list) -> list[tuple[int, int, str]]:
    """(start, end, term) of all terms that touch no base span."""
    taken = sorted((a, b) for _, a, b in spans)
    starts, reach, most = [a for a, _ in taken], [], 0
    for _, b in taken:
        most = max(most, b)
        reach.append(most)
    out = []
    for m in _WORD.finditer(text):
        w = m.group()
        core = w.lstrip(PUNCTUATION)
        a = m.end() - len(core)
        core = core.rstrip(PUNCTUATION)
        if core:
            b = a + len(core)
            k = bisect.bisect_left(starts, b)  # spans that start before the end of the term
            if not k or reach[k - 1] <= a:
                out.append((a, b, core.translate(_LOWER)))
    return out


def surroundings(text: str, spans: list) -> Iterator[tuple[str, str, list[str]]]:
    """(entity, digest of the surrounding terms, terms) of every base span."""
    found = terms(text, spans)
    at = [a for a, _, _ in found]
    for kind, a, b in spans:
        k = bisect.bisect_left(at, a)
        near = [t for _, _, t in found[max(0, k - WINDOW):k + WINDOW]]
        digest = hashlib.md5("\n".join(near).encode("utf-8", "surrogatepass")).hexdigest()
        yield entity(kind, text[a:b]), digest, near


_FOUND = ("part string, tk string, n_email long, n_ip long, n_card long, n_phone long, base string, "
          "base_sha256 string, text string, entity string, win string, term string, is_general boolean")


def found(docs: DataFrame) -> DataFrame:
    """One pass over the texts, written once. Rows of part ``doc``: one per
    document, with its base spans (and its text if it has any); rows of part
    ``near``: the distinct (entity, surroundings, term) rows of a document."""
    # ids travel as text: pandas has no integer column with nulls
    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("tk", F.md5("text"))
    id_type = docs.schema["doc_id"].dataType

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows, near, size = [], [], 0
            for doc_id, text, tk in zip(pdf["doc_id"], pdf["text"], pdf["tk"]):
                spans = base_spans(text)
                base = joined(spans)
                n = [sum(k == kind for k, _, _ in spans) for kind in KINDS[:4]]
                rows.append((doc_id, tk, *n, base, hashlib.sha256(base.encode()).hexdigest(), text if spans else None))
                if spans:
                    seen = set()
                    for e, win, ts in surroundings(text, spans):
                        for t in ts:
                            for term, g in ((t, False), (general(t), True)):
                                if (e, win, term, g) not in seen:
                                    seen.add((e, win, term, g))
                                    near.append((tk, e, win, term, g))
                                    size += 100 + len(term)
                        if size > CHUNK:
                            yield _frame(near=near)
                            near, size = [], 0
            yield _frame(rows, near)

    out = src.mapInPandas(run, f"doc_id string, {_FOUND}").withColumn("doc_id", F.col("doc_id").cast(id_type))
    return stage(out, "op12", "found", partition_by=["part"])


_DOC = ["doc_id", "tk", "n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "text"]
_NEAR = ["tk", "entity", "win", "term", "is_general"]


def _frame(rows: list = (), near: list = ()) -> pd.DataFrame:
    """Both kinds of rows as one frame of plain objects."""
    cols = ["doc_id", *[c.split()[0] for c in _FOUND.split(", ")]]
    out: dict[str, list] = {"part": ["doc"] * len(rows) + ["near"] * len(near)}
    for names, given, before, after in ((_DOC, rows, 0, len(near)), (_NEAR, near, len(rows), 0)):
        for i, name in enumerate(names):
            own = [None] * before + [r[i] for r in given] + [None] * after
            out[name] = own if name not in out else [x if x is not None else y for x, y in zip(out[name], own)]
    return pd.DataFrame({c: pd.Series(out[c], dtype=object) for c in cols})


def term_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """term, is_general, n_term: the rows of ``docs`` that hold each wanted
    (term, is_general), whole texts, every row. Tasks count in a table that they
    empty when it is large, of the wanted terms only if these are at most ``FEW``."""
    few = None
    if wanted.count() <= FEW:
        got = wanted.collect()
        few = docs.sparkSession.sparkContext.broadcast(tuple(
            frozenset(r["term"] for r in got if r["is_general"] == g) for g in (False, True)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        known: dict[bytes, tuple[str | None, str | None]] = {}

        def both(word: bytes) -> tuple[str | None, str | None]:
            core = word.decode().strip(PUNCTUATION)
            pair = (core, general(core)) if core else (None, None)
            if few is not None:
                pair = tuple(x if x in own else None for x, own in zip(pair, few.value))
            if len(known) >= CACHED:
                known.clear()
            known[word] = pair
            return pair

        def out() -> pd.DataFrame:
            rows = [(t, g, n) for g, c in zip((False, True), counts) for t, n in c.items()]
            return pd.DataFrame({k: pd.Series([r[i] for r in rows], dtype=object) for i, k in enumerate(("term", "is_general", "n"))})

        for pdf in frames:
            for text in pdf["text"]:
                pairs = [known.get(w) or both(w) for w in set(text.encode().lower().split())]
                counts[0].update({c for c, _ in pairs if c})
                counts[1].update({g for _, g in pairs if g})
                if len(counts[0]) + len(counts[1]) >= CACHED:
                    yield out()
                    counts[0].clear()
                    counts[1].clear()
        yield out()

    return docs.where(F.col("text").isNotNull()).select("text").mapInPandas(run, "term string, is_general boolean, n long") \
        .groupBy("term", "is_general").agg(F.sum("n").alias("n_term")).join(wanted, ["term", "is_general"], "left_semi")


def _general(term: Column) -> Column:
    return F.concat(F.substring(F.translate(term, "0123456789", "##########"), 1, 3), F.lit("*"))


def disclosing(docs: DataFrame, scanned: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """entity, term, action (``generalise`` or ``remove``), and the counts n_ct,
    n_c, n_term, n_docs of every disclosing term."""
    rows, near = scanned.where("part = 'doc'"), scanned.where("part = 'near'").select(*_NEAR)
    copies = rows.where(F.col("text").isNotNull()).groupBy("tk").agg(F.count(F.lit(1)).alias("copies"))
    n_docs = rows.count()
    # one row per (entity, term, text) with its number of rows; surroundings apart
    by_text = near.groupBy("entity", "term", "is_general", "tk").agg(F.lit(1).alias("one")).join(copies, "tk")
    pairs = by_text.groupBy("entity", "term", "is_general").agg(
        F.sum("copies").alias("n_ct"), F.count(F.lit(1)).alias("n_texts"))
    wins = near.groupBy("entity", "term", "is_general", "win").agg(F.lit(1).alias("one")) \
        .groupBy("entity", "term", "is_general").agg(F.count(F.lit(1)).alias("n_wins"))
    entities = near.groupBy("entity", "tk").agg(F.lit(1).alias("one")).join(copies, "tk") \
        .groupBy("entity").agg(F.sum("copies").alias("n_c"))
    evident = pairs.where(F.col("n_texts") >= support).join(
        wins.where(F.col("n_wins") >= support), ["entity", "term", "is_general"])
    evident = stage(evident.join(entities, "entity"), "op12", "evident")
    wanted = stage(evident.select("term", "is_general").distinct(), "op12", "wanted")
    counted = evident.join(stage(term_rows(docs, wanted), "op12", "term_rows"), ["term", "is_general"])
    share = F.col("n_ct") / F.col("n_term")
    told = counted.where(share >= F.pow(F.col("n_c") / F.lit(float(n_docs)), F.lit(1 - 1 / alpha)))
    told = told.withColumn("n_docs", F.lit(n_docs).cast("long"))
    forms = told.where("is_general").select("entity", F.col("term").alias("form"), F.lit(True).alias("form_tells"))
    return (told.where("NOT is_general").withColumn("form", _general(F.col("term")))
            .join(forms, ["entity", "form"], "left")
            .select("entity", "term", F.when(F.col("form_tells"), "remove").otherwise("generalise").alias("action"),
                    "n_ct", "n_c", "n_term", "n_docs"))


def told_texts(scanned: DataFrame, told: DataFrame) -> DataFrame:
    """tk, told (array of term and action): the disclosing terms of each text.
    ``remove`` wins where a term tells several entities."""
    near = scanned.where("part = 'near' AND NOT is_general").select("tk", "entity", "term")
    own = near.join(told.select("entity", "term", "action"), ["entity", "term"]) \
        .groupBy("tk", "term").agg(F.max("action").alias("action"))
    return own.groupBy("tk").agg(F.array_sort(F.collect_list(F.struct("term", "action"))).alias("told"))


def term_spans(text: str, told) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, action) of the disclosing terms of one text."""
    actions = {x["term"]: x["action"] for x in told}
    return [("term", a, b, actions[t]) for a, b, t in terms(text, base_spans(text)) if t in actions]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all spans by
    start, then kind) of every row of ``docs``."""
    scanned = found(docs)
    told = stage(told_texts(scanned, disclosing(docs, scanned)), "op12", "told")
    rows = scanned.where("part = 'doc'").select(*_DOC)

    @F.pandas_udf("string")
    def with_terms(texts: pd.Series, told: pd.Series) -> pd.Series:
        return pd.Series([joined(_ordered(base_spans(t) + [s[:3] for s in term_spans(t, x)]))
                          for t, x in zip(texts, told)], dtype=object)

    keep = ["doc_id", *_DOC[2:6], "base_sha256"]
    plain = rows.drop("text").join(told, "tk", "left_anti").select(*keep, F.col("base").alias("spans"))
    more = rows.where(F.col("text").isNotNull()).join(told, "tk").select(*keep, with_terms("text", "told").alias("spans"))
    return plain.unionByName(more)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind in brackets and
    disclosing terms generalised or removed; other columns as they are."""
    scanned = found(docs)
    told = stage(told_texts(scanned, disclosing(docs, scanned)), "op12", "told")

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, told: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else _clean(t, x if x is not None else ()) for t, x in zip(texts, told)], dtype=object)

    names = docs.columns
    key, mine = "_op12_key", F.md5(F.coalesce("text", F.lit("")))
    joined_ = docs.select(F.struct(*names).alias("_op12_row"), mine.alias(key)) \
        .join(told.select(F.col("tk").alias(key), F.col("told").alias("_op12_told")), key, "left")
    return joined_.select(*[cleaned("_op12_row.text", "_op12_told").alias("text") if n == "text"
                            else F.col(f"_op12_row.`{n}`").alias(n) for n in names])


def _clean(text: str, told) -> str:
    spans = [(a, b, f"[{k.upper()}]") for k, a, b in base_spans(text)]
    spans += [(a, b, general(text[a:b]) if action == "generalise" else "[TERM]")
              for _, a, b, action in term_spans(text, told)]
    out, at = [], 0
    for a, b, mark in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])
