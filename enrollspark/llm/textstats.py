"""Statistics of whole texts as Spark column expressions; the inputs of the quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.common import SPACES, split_words, text_or_empty

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3  # words in a repeated window

# Shares and sizes derived from the counts; these are what rules test.
STATS = [
    "log_words",
    "mean_word",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "stutter_share",
    "words_per_line",
    "longest_word",
    "odd_share",
]


def _removed(text: Column, pattern: str) -> Column:
    """Characters of ``text`` in runs that match ``pattern``."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _windows(words: Column) -> Column:
    """A 64-bit key for each window of WINDOW words."""
    at = [F.slice(words, k + 1, F.size(words) - (WINDOW - 1)) for k in range(WINDOW)]
    keys = F.transform(F.arrays_zip(*[a.alias(f"w{k}") for k, a in enumerate(at)]), lambda x: F.xxhash64(x["w0"], x["w1"], x["w2"]))
    return F.when(F.size(words) >= WINDOW, keys).otherwise(F.array().cast("array<bigint>"))


def _by_key(keys: Column) -> Column:
    """(key, place) pairs in order, or null if no key comes twice."""
    pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), pairs)


def _repeated(pairs: Column) -> Column:
    """The places, in order, whose key stands next to an equal one."""
    hit = F.filter(
        F.transform(
            pairs,
            lambda x, j: F.when((x["k"] == F.get(pairs, j - 1)["k"]) | (x["k"] == F.get(pairs, j + 1)["k"]), x["i"]),
        ),
        lambda i: i.isNotNull(),
    )
    return F.sort_array(hit)


def _covered(places: Column) -> Column:
    """Words in the windows that begin at ``places`` (null: none)."""
    own = F.transform(places, lambda p, j: F.least(F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.coalesce(F.aggregate(own, F.lit(0), lambda a, x: a + x), F.lit(0))


COUNTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_plain",
    "n_stutter",
    "longest",
]


def free_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` begins with, in any letter case."""
    p = "st_"
    while any(c.lower().startswith(p) for c in df.columns):
        p = f"{p}_"
    return p


def with_counts(df: DataFrame, prefix: str, text: str = "text") -> DataFrame:
    """Add the COUNTS of the whole text (null: empty) as long columns, their names behind ``prefix``.

    n_repeat_words counts the words in three-word windows found twice or more,
    the first included; windows are compared by a 64-bit key. Words, lines and
    windows are columns of their own, each made once. A filter on these columns that follows would be
    pushed below them and make them anew for each use: use ``filter_above``, or write the result first.
    """
    c = lambda n: F.col(prefix + n)
    d = df.select("*", text_or_empty(F.col(text)).alias(prefix + "t"), split_words(F.col(text)).alias(prefix + "w"))
    lines = F.filter(F.split(c("t"), "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    d = d.select("*", lines.alias(prefix + "l"), F.array_join(c("w"), "").alias(prefix + "j"), _windows(c("w")).alias(prefix + "k"))
    d = d.withColumn(prefix + "k", _by_key(c("k")))
    d = d.withColumn(prefix + "k", _repeated(c("k")))
    w, ln, j = c("w"), c("l"), c("j")
    n = F.size(w)
    after = F.slice(w, 2, F.greatest(n - 1, F.lit(0)))
    out = {
        "n_words": n,
        "word_chars": F.length(j),
        "n_symbols": _removed(j, SYMBOLS + "+"),
        "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)),
        "n_repeat_words": _covered(c("k")),
        "n_lines": F.size(ln),
        "n_distinct": F.size(F.array_distinct(w)),
        "n_upper": _removed(j, r"\p{Lu}+"),
        "n_digits": _removed(j, "[0-9]+"),
        "n_marks": _removed(j, "[.,;:!?]+"),
        "n_plain": _removed(j, r"[\p{L}0-9.,;:!?'\"#*$%&|<>()-]+"),
        "n_stutter": F.size(F.filter(F.zip_with(w, after, lambda a, b: a == b), lambda x: x)),
        "longest": F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0)),
    }
    d = d.select("*", *[v.cast("long").alias(prefix + m) for m, v in out.items()])
    return d.drop(*[prefix + m for m in "twljk"])


def stat_columns(prefix: str) -> list[Column]:
    """The STATS as doubles, from the counts; an empty text gives zeros."""
    g = lambda n: F.col(prefix + n).cast("double")
    per = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    words, chars = g("n_words"), g("word_chars")
    out = {
        "log_words": F.log1p(words),
        "mean_word": per(chars, words),
        "symbol_share": per(g("n_symbols"), words),
        "dup_line_share": per(g("n_dup_lines"), g("n_lines")),
        "repeat_share": per(g("n_repeat_words"), words),
        "distinct_share": per(g("n_distinct"), words),
        "upper_share": per(g("n_upper"), chars),
        "digit_share": per(g("n_digits"), chars),
        "mark_share": per(g("n_marks"), words),
        "stutter_share": per(g("n_stutter"), words),
        "words_per_line": per(words, g("n_lines")),
        "longest_word": g("longest"),
        "odd_share": per(chars - g("n_plain"), chars),
    }
    return [out[s].alias(s) for s in STATS]
