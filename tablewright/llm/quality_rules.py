"""Quality rules (operator 4): a threshold table compiled into one projection.

Every measure is a built-in column expression over the whole text and every
rule is one row of ``RULES`` (measure, lowest, highest). ``quality_rules``
turns the table into a single Spark projection; there is no shuffle, no Python
and no per-group work, so a hot source or a very long document costs only its
own length.

Defined cases: a null or empty text has no words and fails the base rules; a
rule whose measure has a zero denominator is passed (its ratio counts as 0
where a lowest value does not apply, see ``_ratio``); a null doc_id and
repeated rows are kept as they are; an empty table gives an empty result;
other columns of the input never matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import let, lower_ascii, words

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was with as be by at this from or are have "
    "de la le et les des en un une est que qui dans pour "
    "der die und den von zu das mit sich ist ein eine nicht "
    "el los las del se por con una para"
).split()

# (measure, lowest allowed, highest allowed); None: no limit on that side.
RULES: list[tuple[str, float | None, float | None]] = [
    ("n_words", 50, 1_000_000),
    ("repeat_word_ratio", None, 0.5),
    ("mean_word_chars", 2.0, 15.0),
    ("symbol_word_ratio", None, 0.25),
    ("upper_letter_ratio", None, 0.5),
    ("letter_ratio", 0.5, None),
    ("stop_word_ratio", 0.01, None),
    ("dup_line_ratio", None, 0.5),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.5),
]

SYMBOLS = "#*$%&|<>"


def _count(text: Column, keep: str) -> Column:
    """Code points of ``text`` that match the character class ``keep``."""
    return F.char_length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the array.

    Window hashes are sorted with their positions and neighbours compared, so
    the work for a text of n words is n log n; a text without any repeated
    window stops after one hash set."""

    def spread(pair: Column) -> Column:
        return F.array(*[pair + k for k in range(3)])

    def marked(g: Column) -> Column:
        keyed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(keyed, lambda s: F.size(F.array_distinct(F.flatten(F.zip_with(
            F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.concat(spread(a["i"]), spread(b["i"])))
            .otherwise(F.array().cast("array<int>")))))))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return let(ws, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(
        let(windows(w), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0))
            .otherwise(marked(g))))).cast("long")


def _ratio(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and every measure that the rules name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blank_free = F.regexp_replace(F.col("_t"), "[\\x20\\x09-\\x0D]+", "")
    base = (docs.select("doc_id", text.alias("_t"))
            .select("doc_id", "_t", words(F.col("_t")).alias("_w"),
                    F.filter(F.split(F.col("_t"), "\n"),
                             lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "").alias("_l")))
    counts = base.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(blank_free).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        _count(F.col("_t"), "\\p{L}").alias("n_letters"),
        _count(F.col("_t"), "\\p{Lu}").alias("n_upper"),
        F.size(F.filter("_w", lambda x: lower_ascii(x).isin(STOP_WORDS))).cast("long").alias("n_stop"),
        F.size(F.filter("_l", lambda x: F.ltrim(x).rlike("^[-*•]"))).cast("long").alias("n_bullet"),
        F.size(F.filter("_l", lambda x: x.rlike("(\\.\\.\\.|…)\\s*$"))).cast("long").alias("n_ellipsis"))
    return counts.select(
        "*", _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"),
        _ratio("n_symbols", "n_words").alias("symbol_word_ratio"),
        _ratio("n_upper", "n_letters").alias("upper_letter_ratio"),
        _ratio("n_letters", "word_chars").alias("letter_ratio"),
        _ratio("n_stop", "n_words").alias("stop_word_ratio"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        _ratio("n_bullet", "n_lines").alias("bullet_line_ratio"),
        _ratio("n_ellipsis", "n_lines").alias("ellipsis_line_ratio"))


def quality_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per input row: measures, ``failed_rules`` (names), ``base_failed``
    and ``kept`` (no rule failed and the base passed)."""
    def broken(name, low, high):
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(name) < low)
        if high is not None:
            bad = bad | (F.col(name) > high)
        return F.when(bad, F.lit(name))

    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_compact(F.array(*[broken(*r) for r in rules]))
    return (measures(docs).select("*", base_failed.alias("base_failed"), failed.alias("failed_rules"))
            .select("*", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept")))
