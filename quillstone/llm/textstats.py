"""Statistics of documents as Spark expressions; no Python runs on the executors.

Defined results: null text counts as empty, and empty text has zeros throughout; a text of fewer than WINDOW words has
no windows; very long texts are measured whole; repeated rows give repeated rows; an empty table gives none;
kept columns must not be named like a statistic, other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

WINDOW = 8
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _tail(a: Column) -> Column:
    return F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))


def covered(hashes: Column) -> Column:
    """Words in windows that occur twice or more: the union of [i, i + WINDOW) over their starts i.

    Sorting (hash, start) brings equal windows together; of those with an equal neighbour the starts
    are sorted again, and each covers the words up to the next one, WINDOW at most.
    """

    def same(s: Column) -> Column:
        return F.zip_with(s, _tail(s), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))

    def starts(s: Column) -> Column:
        return let(same(s), lambda e: F.sort_array(F.array_compact(F.zip_with(s, F.zip_with(e, F.concat(F.array(F.lit(False)), e), lambda x, y: F.coalesce(x, F.lit(False)) | y), lambda a, d: F.when(d, a["i"])))))

    def union(p: Column) -> Column:
        return F.aggregate(F.zip_with(p, _tail(p), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))), F.lit(0), lambda x, y: x + y)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, starts), union)


def with_stats(df: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and what the rules' features need.

    Windows are compared by 64-bit hashes within one document.
    """
    text = text_or_empty(text_col)
    d = df.select(*keep, text.alias("__text"))
    names = [c for c in d.columns if c != "__text"]
    d = d.select(*names, "__text", F.array_remove(F.split("__text", r"[\x20\x09-\x0D]+"), "").alias("__words"))
    n = F.size("__words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(F.col("__words"), i, WINDOW))))
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    t = F.col("__text")
    d = d.select(
        *names, n.cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        _without(t, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.struct((F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("dup"), F.size(a).cast("long").alias("all"))).alias("__lines"),
        _without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"), _without(t, "0123456789").cast("long").alias("n_digits"), _without(t, "!?").cast("long").alias("n_exclaim"),
        F.size(F.array_distinct("__words")).cast("long").alias("n_distinct"), windows.alias("__windows"),
    )
    w = F.col("__windows")
    repeat = F.when(w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)), F.lit(0)).otherwise(covered(w)).cast("long")
    return d.select(*names, "n_words", "word_chars", "n_symbols", F.col("__lines")["dup"].alias("n_dup_lines"), repeat.alias("n_repeat_words"), F.col("__lines")["all"].alias("n_lines"), "n_upper", "n_digits", "n_exclaim", "n_distinct")


#: The features that decision rules may test, by name.
FEATURES = {
    "n_words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "exclaims_per_word": "n_exclaim / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def features() -> list[Column]:
    return [F.expr(e).cast("double").alias(name) for name, e in FEATURES.items()]
