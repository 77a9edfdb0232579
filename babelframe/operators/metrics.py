"""Quality metrics on DataFrames: readability and complexity (M1-M3, A6),
repeated tokens (M5, W5), BLEU (M6), chrF (M7, A1) and the chrF flag (F5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from babelframe import constants as C
from babelframe.functions import ngrams as NG
from babelframe.functions.readability import counts as readability_counts
from babelframe.functions.readability import formulas as readability_formulas
from babelframe.functions.text import TOKEN, char_length
from babelframe.session import stage


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ------------------------------------------------------------- M1 - M3, A6
def add_readability(df: DataFrame, text_col: str) -> DataFrame:
    """M1 + M2: ``fk_grade``, ``f_ease`` and ``length``.

    W, S and Y are projected once and the formulas read those columns
    (the optimizer does not re-inline expensive expressions)."""
    w, s, y = readability_counts(text_col)
    staged = df.withColumn("__w", w).withColumn("__s", s).withColumn("__y", y)
    g, e = readability_formulas(F.col(text_col), F.col("__w"), F.col("__s"), F.col("__y"))
    return (
        staged.withColumn("fk_grade", g)
        .withColumn("f_ease", e)
        .withColumn("length", char_length(text_col))
        .drop("__w", "__s", "__y")
    )


def min_max_scale(df: DataFrame, cols: list[str], suffix: str = "_norm") -> DataFrame:
    """Global min-max scaling; a constant column scales to 0.

    The global min/max is a 1-row aggregate (partial per task, then one
    tiny merge) brought to the driver and applied as literals - no
    un-partitioned window, no join.
    """
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"__min_{c}"), F.max(c).cast("double").alias(f"__max_{c}")]
    bounds = df.agg(*aggs).first()
    out = df
    for c in cols:
        lo, hi = bounds[f"__min_{c}"], bounds[f"__max_{c}"]
        if lo is None or hi is None or not hi > lo:
            out = out.withColumn(c + suffix, F.lit(0.0))
        else:
            out = out.withColumn(c + suffix, (F.col(c) - F.lit(lo)) / (F.lit(hi) - F.lit(lo)))
    return out


def add_complexity(
    df: DataFrame, text_col: str | None = None, keep: list[str] | None = None, staged: bool = True
) -> DataFrame:
    """M3: readability (added when ``text_col`` is given), min-max
    normalised over all rows (A6), ``complexity = (g + (1 - e)) / 2``.

    The global min/max needs a pass of its own; ``staged`` writes the scored
    rows once (only ``keep`` + the metrics when ``keep`` is given) so the
    per-row readability is not computed twice.
    """
    scored = add_readability(df, text_col) if text_col else df
    if keep is not None:
        scored = scored.select(*keep, "fk_grade", "f_ease", "length")
    if staged:
        scored = stage(scored, "readability")
    normed = min_max_scale(scored, ["fk_grade", "f_ease"])
    return normed.withColumn("complexity", (F.col("fk_grade_norm") + (F.lit(1.0) - F.col("f_ease_norm"))) / 2)


# ------------------------------------------------------------- M5 / W5
def tokens(col: Column | str, pattern: str = TOKEN) -> Column:
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(pattern), 0)


def repeated_tokens(prediction: Column | str, reference: Column | str, pattern: str = TOKEN) -> Column:
    """M5: some neighbouring equal tokens in the prediction whose token is
    absent from the reference. NULL inputs -> false."""
    # tokens that equal their right neighbour (usually few), then one
    # hash-based set difference against the reference tokens: O(n + m)
    def doubled(t: Column) -> Column:
        m = F.greatest(F.size(t) - 1, F.lit(0))
        return F.filter(F.zip_with(F.slice(t, 1, m), F.slice(t, 2, m), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())

    # a text without such tokens needs none of its reference
    def missing(t: Column) -> Column:
        return F.when(F.size(t) > 0, F.size(F.array_except(t, tokens(reference, pattern))) > 0).otherwise(F.lit(False))

    # arrays of one: what is found once is there for all that reads it
    flag = F.transform(F.transform(F.array(tokens(prediction, pattern)), doubled), missing)[0]
    return F.when(_c(prediction).isNull() | _c(reference).isNull(), F.lit(False)).otherwise(flag)


# ------------------------------------------------------------- M6 / M7 / A1
def sentence_bleu(df: DataFrame, hyp: str, ref: str, out_col: str = "bleu", tokenize: str = "words") -> DataFrame:
    """M6 per row. ``tokenize="char"`` scores characters instead of words, so
    that texts written without spaces score above 0."""
    return (
        df.withColumn("__bleu_st", NG.bleu_counts(hyp, ref, tokenize))
        .withColumn(out_col, NG.bleu_from_counts(F.col("__bleu_st")))
        .drop("__bleu_st")
    )


def sentence_chrf(df: DataFrame, hyp: str, ref: str, out_col: str = "chrf", lowercase: bool = False) -> DataFrame:
    """M7 per row (0-100)."""
    # the counts are a column first: the score formula folds over them
    return (
        df.withColumn("__chrf_st", NG.chrf_counts(hyp, ref, lowercase))
        .withColumn(out_col, NG.chrf_from_counts(F.col("__chrf_st")))
        .drop("__chrf_st")
    )


def sentence_chrf_many(df: DataFrame, specs: list[tuple[str, str, str, bool]]) -> DataFrame:
    """M7 for several (hyp, ref, out_col, lowercase) pairs per row, counted in
    one Arrow pass."""
    out = df.withColumn("__chrf_many", NG.chrf_counts_many([(h, r, lc) for h, r, _, lc in specs]))
    # each pair's counts are a column first: the score formula folds over them
    parts = [f"__chrf_{j}" for j in range(len(specs))]
    out = out.withColumns({p: NG.chrf_of(F.col("__chrf_many"), j) for j, p in enumerate(parts)})
    for j, (_, _, name, _) in enumerate(specs):
        out = out.withColumn(name, NG.chrf_from_counts(F.col(f"__chrf_{j}")))
    return out.drop("__chrf_many", *parts)


def corpus_chrf(df: DataFrame, hyp: str, ref: str, lowercase: bool = False, out_col: str = "chrf") -> DataFrame:
    """A1: corpus chrF - the 24 sufficient statistics are summed over all
    rows (a partial aggregate per task, merged once) before the F-score."""
    return corpus_chrf_many(df, [(hyp, ref, out_col, lowercase)])


def corpus_chrf_many(df: DataFrame, specs: list[tuple[str, str, str, bool]]) -> DataFrame:
    """A1 for several (hyp, ref, out_col, lowercase) pairs in one pass: one
    aggregate sums every count array, then each score is a formula."""
    n = NG.CHRF_COUNTS
    stats = df.select(NG.chrf_counts_many([(h, r, lc) for h, r, _, lc in specs]).alias("__many"))
    sums = [F.count(F.lit(1)).alias("n_rows")]
    for j in range(len(specs)):
        sums += [F.sum(F.col("__many")[j * n + i]).alias(f"__s{j}_{i}") for i in range(n)]
    agg = stats.agg(*sums)
    scores = [
        NG.chrf_from_counts(F.array(*[F.col(f"__s{j}_{i}") for i in range(n)])).alias(out)
        for j, (_, _, out, _) in enumerate(specs)
    ]
    return agg.select("n_rows", *scores)


def chrf_flag(score: Column | str, threshold: float = C.CHRF_FLAG_THRESHOLD) -> Column:
    """0 when ``score >= threshold`` else 1 (1 = bad). The threshold is
    in score units (0-100): the default 0.5 keeps parity, 50 is useful (D8)."""
    return F.when(_c(score) >= threshold, F.lit(0)).otherwise(F.lit(1))
