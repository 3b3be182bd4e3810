"""Statistics of whole texts from DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once, words

#: Words of a window of ``n_repeat_words``.
WINDOW = 8


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, made from ``names``."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def _count(text: Column, keep: str) -> Column:
    """Characters of a class, as what is left when all others are removed."""
    return F.char_length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def with_text_stats(df: DataFrame, out: str, text: str = "text", windows: bool = True) -> DataFrame:
    """``df`` with a struct ``out`` of counts over the whole text (null: no text):

    n_words, word_chars (code points in words), n_symbols (``#*$%&|<>``),
    n_dup_lines (lines with a word equal to an earlier line), n_lines (lines with
    a word), n_distinct (distinct words), n_upper, n_digits, n_punct
    (``.,;:?``), n_excl (``!``) and, if ``windows``, n_repeat_words: words
    inside 8-word windows found twice or more in the text, the first included.

    Windows are first compared by hash; only a text in which a hash occurs
    twice has its windows sorted as text, so the count is exact.
    """
    w, wh, h, srt, pos = fresh(df, "_w", "_wh", "_h", "_srt", "_pos")
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    df = df.select(*kept, words(t).alias(w))
    W = F.col(w)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    repeat = F.lit(None).cast("long")
    if windows:
        n = F.size(W)
        df = df.withColumn(wh, F.transform(W, lambda x: F.xxhash64(x)))
        df = df.withColumn(h, F.when(n >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(F.col(wh), i + k) for k in range(WINDOW)])))).drop(wh)
        found = F.size(F.array_distinct(h)) < F.size(h)
        df = df.withColumn(srt, F.when(found, F.array_sort(F.transform(
            F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
            lambda i: F.struct(F.array_join(F.array(*[F.get(W, i + k) for k in range(WINDOW)]), " ").alias("s"),
                               i.alias("p")))))).drop(h)
        s = F.col(srt)
        same = lambda a, b: F.coalesce(a["s"] == b["s"], F.lit(False))
        df = df.withColumn(pos, F.array_sort(F.transform(F.filter(
            s, lambda x, i: same(F.get(s, i - 1), x) | same(F.get(s, i + 1), x)), lambda x: x["p"]))).drop(srt)
        p = F.col(pos)
        covered = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        repeat = F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    joined = F.array_join(W, "")
    df = df.withColumn(out, once(F.struct(
        F.size(W).cast("long").alias("n_words"), F.char_length(joined).cast("long").alias("word_chars"),
        _count(t, "#*$%&|<>").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(W)).cast("long").alias("n_distinct"),
        _count(t, "\\p{Lu}").alias("n_upper"), _count(t, "0-9").alias("n_digits"),
        _count(t, ".,;:?").alias("n_punct"), _count(t, "!").alias("n_excl"),
        repeat.alias("n_repeat_words"))))
    return df.select(*kept, out)
