"""Degenerate repeated-word text: A5 word counts, M4 flag, F4 filter.

Each text is one row, so the per-text word histogram never needs a shuffle:
M4 sorts the row's word array and measures the longest run of equal words
inside the row (a map-only stage). ``word_frequencies`` (A5) is the explicit
per-(text, word) count table for callers who want the counts themselves; it
aggregates map-side before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from babelframe import constants as C
from babelframe.functions.text import words_lower


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def longest_equal_run(sorted_words: Column) -> Column:
    """Length of the longest run of equal neighbours in a sorted array."""
    init = F.struct(
        F.lit(None).cast("string").alias("prev"),
        F.lit(0).alias("run"),
        F.lit(0).alias("best"),
    )

    def step(acc: Column, w: Column) -> Column:
        run = F.when(w == acc["prev"], acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(w.alias("prev"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(sorted_words, init, step, lambda acc: acc["best"])


def adaptive_threshold(n_words: Column) -> Column:
    """``clamp(0.8 * exp(-0.05 n) + 0.3, 0.3, 0.8)``."""
    raw = F.lit(C.REPEAT_MAX_THRESHOLD) * F.exp(F.lit(-C.REPEAT_DECAY) * n_words) + F.lit(C.REPEAT_MIN_THRESHOLD)
    return F.least(F.greatest(raw, F.lit(C.REPEAT_MIN_THRESHOLD)), F.lit(C.REPEAT_MAX_THRESHOLD))


def repeat_stats(text: Column | str) -> tuple[Column, Column, Column]:
    """(n_words, max_count, has_repeated_words) column expressions (M9, A5, M4)."""
    words = words_lower(text)
    n = F.size(words).cast("bigint")
    max_count = longest_equal_run(F.sort_array(words)).cast("bigint")
    flag = (
        F.when(n == 0, F.lit(False))
        .when(n == 2, F.element_at(words, 1) == F.element_at(words, 2))
        .otherwise((max_count / n) > adaptive_threshold(n))
    )
    return n, max_count, flag


def check_repeated_words(
    df: DataFrame, text_col: str, new_column_name: str = "has_repeated_words", with_counts: bool = False
) -> DataFrame:
    """M4: add the degenerate-repeat flag (and optionally the counts)."""
    n, max_count, flag = repeat_stats(text_col)
    out = df.withColumn(new_column_name, flag)
    if with_counts:
        out = out.withColumn("n_words", n).withColumn("max_count", max_count)
    return out


def drop_repeated_words(df: DataFrame, text_col: str) -> DataFrame:
    """keep rows whose text is not degenerate."""
    _, _, flag = repeat_stats(text_col)
    return df.filter(~flag)


def word_frequencies(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """A5: ``(key, word, count)`` for every word of every text.

    Partial aggregation runs before the shuffle, so at most one row per
    distinct word per text and task crosses the network.
    """
    return (
        df.select(_c(key_col).alias(key_col), F.explode(words_lower(text_col)).alias("word"))
        .groupBy(key_col, "word")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_word_counts(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """A5 via the frequency table: ``(key, n_words, max_count)`` per text."""
    return (
        word_frequencies(df, key_col, text_col)
        .groupBy(key_col)
        .agg(F.sum("count").alias("n_words"), F.max("count").alias("max_count"))
    )
