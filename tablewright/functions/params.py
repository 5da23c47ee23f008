"""Parameterised SQL (F3) and query templates.

Configuration text marks run-time values as ``{{name}}`` and stored templates
as ``t{{name}}``. Values are *bound*, never pasted into the text: each
``{{name}}`` becomes the named parameter marker ``:name`` and the value goes to
``spark.sql(..., args=...)``. A template reference becomes the name of a
temporary view holding the template's query (see ``sources.views``).

The text is first cut into pieces by what they are for Spark: plain text,
literals in single or double quotes (raw ones, too), names in back-ticks,
comments and hints. A placeholder is then bound or refused by where it is:

* plain text: a marker;
* a literal that is nothing but the placeholder: a marker (the quotes were
  written for pasting; the bound value keeps its own type);
* inside a longer literal: the literal is taken apart around the bound value;
* names in back-ticks, and hints: refused, a name cannot be bound;
* comments: replaced by a blank, whatever they hold.

A name in double quotes (``spark.sql.ansi.doubleQuotedIdentifiers``) cannot be
told from a literal; a placeholder in it is bound as in a literal.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = r"\{\{\s*(\w+)\s*\}\}"
_TEMPLATE = re.compile(r"(?<!\w)t" + _NAME)
_PARAM = re.compile(_NAME)
_OPENING = re.compile(r"""r?'|r?"|`|--|/\*""", re.IGNORECASE)


def _literal_end(text: str, at: int, quote: str, raw: bool) -> int:
    """The end of the literal whose text begins at ``at``. A backslash escapes the
    next character and a doubled quote stands for one, unless the literal is raw."""
    while at < len(text):
        if not raw and (text[at] == "\\" or text[at:at + 2] == 2 * quote):
            at += 2
        elif text[at] == quote:
            return at + 1
        else:
            at += 1
    raise ValueError(f"a literal is not closed in query: {text}")


def _comment_end(text: str, at: int) -> int:
    """The end of a bracketed comment that begins at ``at``; they nest."""
    depth = 0
    for m in re.compile(r"/\*|\*/").finditer(text, at):
        depth += 1 if m.group() == "/*" else -1
        if not depth:
            return m.end()
    raise ValueError(f"a comment is not closed in query: {text}")


def pieces(text: str) -> list[tuple[str, str]]:
    """(kind, text) of the pieces of a query in order; kind is ``plain``,
    ``literal``, ``name``, ``comment`` or ``hint``."""
    out, at, plain = [], 0, 0
    while (m := _OPENING.search(text, at)) is not None:
        mark, start = m.group().lower(), m.start()
        if mark[0] == "r" and start and (text[start - 1].isalnum() or text[start - 1] in "_}"):
            start, mark = start + 1, mark[1:]          # the r belongs to a word before the quote
        if mark[-1] in "'\"":
            kind, end = "literal", _literal_end(text, start + len(mark), mark[-1], mark[0] == "r")
        elif mark == "`":
            close = text.find("`", start + 1)
            if close < 0:
                raise ValueError(f"a name in back-ticks is not closed in query: {text}")
            kind, end = "name", close + 1
        elif mark == "--":
            stop = text.find("\n", start)
            kind, end = "comment", len(text) if stop < 0 else stop
        else:
            kind, end = "hint" if text.startswith("/*+", start) else "comment", _comment_end(text, start)
        if start > plain:
            out.append(("plain", text[plain:start]))
        out.append((kind, text[start:end]))
        at = plain = end
    if plain < len(text):
        out.append(("plain", text[plain:]))
    return out


def template_refs(query: str) -> list[str]:
    return [n for kind, t in pieces(query or "") if kind == "plain" for n in _TEMPLATE.findall(t)]


def placeholders(query: str) -> list[str]:
    """Names that need a value, in order."""
    out = []
    for kind, t in pieces(query or ""):
        if kind == "plain":
            t = _TEMPLATE.sub(" ", t)
        if kind in ("plain", "literal"):
            out += _PARAM.findall(t)
    return out


def replace_template_refs(query: str, view_names: dict[str, str]) -> str:
    def sub(m):
        name = m.group(1)
        if name not in view_names:
            raise ValueError(f"query template '{name}' is not configured")
        return view_names[name]
    return "".join(_TEMPLATE.sub(sub, t) if kind == "plain" else t for kind, t in pieces(query))


def _literal(literal: str) -> str:
    lead = literal[:1] if literal[0] in "rR" else ""
    quote = literal[len(lead)]
    parts = _PARAM.split(literal[len(lead) + 1:-1])  # text, name, text, ...
    if len(parts) == 1:
        return literal
    if len(parts) == 3 and not parts[0] and not parts[2]:
        return ":" + parts[1]
    texts = [f"cast(:{p} as string)" if i % 2 else f"{lead}{quote}{p}{quote}" for i, p in enumerate(parts) if p]
    return "concat(" + ", ".join(texts) + ")"


def to_markers(query: str, params: dict | None) -> tuple[str, dict]:
    """``{{name}}`` → ``:name``; returns the text and the arguments it uses.
    A placeholder without a value, or where no value can be bound, is an error
    (never left unexpanded)."""
    params = params or {}
    names = placeholders(query)
    missing = sorted({n for n in names if n not in params})
    if missing:
        raise KeyError(f"parameters {missing} are not provided for query: {query}")
    out = []
    for kind, t in pieces(query):
        if kind == "literal":
            t = _literal(t)
        elif kind == "comment":
            t = " "
        elif kind == "plain":
            if _TEMPLATE.search(t):
                raise ValueError(f"a query template is not resolved in query: {query}")
            t = _PARAM.sub(lambda m: ":" + m.group(1), t)
        elif _PARAM.search(t):
            raise ValueError(f"a parameter cannot be bound in {kind} {t} of query: {query}")
        out.append(t)
    return "".join(out), {n: params[n] for n in names}


def bind_sql(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Run configuration SQL with its placeholders bound as parameters."""
    text, args = to_markers(query, params)
    return spark.sql(text, args=args) if args else spark.sql(text)
