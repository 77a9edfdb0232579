"""Binning and exact stratified sampling.

Everything that is global - quantile edges, min/max, strata counts - is a
small result (a few numbers, at most ``n_bins**2`` strata) computed by
distributed jobs and brought to the driver; nothing per row is.

* W3 exact quantiles come from counts (``operators.quantiles``), without a
  sort.
* L2 exact sample: per stratum the ``quota`` rows with the smallest hash key
  are taken. The job that counts the strata also counts their keys by the
  leading bits, which gives the key below which a stratum's rows are all
  taken; only the few rows that share the leading bits with the last of them
  are ranked. No window sees a whole stratum.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from babelframe import constants as C
from babelframe.operators.quantiles import exact_quantiles, exact_quantiles_many
from babelframe.session import stage

log = logging.getLogger(__name__)

EDGE_DECIMALS = 9


# --------------------------------------------------------------- quantiles
def _edges(qs: list[float | None]) -> list[float]:
    if not qs or qs[0] is None:
        return []
    return sorted({round(q, EDGE_DECIMALS) for q in qs})


def quantile_edges(df: DataFrame, col: str, n_bins: int) -> list[float]:
    """W3 edges: ``n_bins`` equal-frequency intervals, rounded to 9 decimals
    (trap D10), duplicates dropped."""
    return _edges(exact_quantiles(df, col, [i / n_bins for i in range(n_bins + 1)]))


def bin_by_edges(value: Column, edges: list[float]) -> Column:
    """Right-closed bins over ``edges`` (lowest included): the label is the
    number of inner edges strictly below the value."""
    v = F.round(value.cast("double"), EDGE_DECIMALS)
    inner = edges[1:-1]
    label = F.lit(0)
    for e in inner:
        label = label + F.when(v > F.lit(e), F.lit(1)).otherwise(F.lit(0))
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(None)).otherwise(label).cast("int")


def quantile_bins(df: DataFrame, col: str, n_bins: int, out_col: str) -> DataFrame:
    """Equal-frequency bin labels 0.. (``qcut(labels=False, duplicates='drop')``)."""
    return df.withColumn(out_col, bin_by_edges(F.col(col), quantile_edges(df, col, n_bins)))


def width_bins(df: DataFrame, col: str, n_bins: int, out_col: str) -> DataFrame:
    """``n_bins`` equal-width right-closed bins between min and max
    (minimum included). Bounds come from a 1-row aggregate applied as
    literals. NULL and NaN get no label; infinities do not stretch the bins
    and fall into the outer ones."""
    v = F.col(col).cast("double")
    finite = F.when(F.abs(v) < F.lit(math.inf), v)
    b = df.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    if lo is None or hi is None or not hi > lo:
        label = F.lit(0)
    else:
        w = (F.lit(hi) - F.lit(lo)) / n_bins
        raw = F.ceil(F.round((finite - F.lit(lo)) / w, EDGE_DECIMALS)) - 1
        label = F.least(F.lit(n_bins - 1), F.greatest(F.lit(0), raw))
    label = F.when(v == F.lit(-math.inf), F.lit(0)).when(v == F.lit(math.inf), F.lit(n_bins - 1)).otherwise(label)
    return df.withColumn(out_col, F.when(v.isNull() | F.isnan(v), F.lit(None)).otherwise(label).cast("int"))


def create_bins(df: DataFrame, col: str, n_bins: int, out_col: str, use_qcut: bool = True) -> DataFrame:
    return quantile_bins(df, col, n_bins, out_col) if use_qcut else width_bins(df, col, n_bins, out_col)


# ----------------------------------------------------------------- strata
def strata_counts(df: DataFrame, strata_col: str = "strata") -> dict[str, int]:
    """Rows per stratum (at most n_bins**2 rows to the driver)."""
    return {r[0]: r[1] for r in df.groupBy(strata_col).agg(F.count(F.lit(1))).collect()}


def strata_warnings(counts: dict[str, int], n_samples: int, n_bins: int) -> list[str]:
    """A7 + A8 checks (warn only)."""
    out = []
    if len(counts) < n_bins**2:
        out.append(f"{n_bins**2 - len(counts)} of {n_bins**2} strata have no rows")
    few = sorted(s for s, c in counts.items() if c < n_samples / n_bins**2)
    if few:
        out.append(f"strata with fewer rows than their even share: {few}")
    return out


def strata_report(binned: DataFrame, n_samples: int, n_bins: int, strata_col: str = "strata") -> DataFrame:
    """A7 + A8 as rows: (strata, n, warning) of every possible stratum and of
    those that occur besides (rows without a bin). ``warning``: ``empty``,
    ``few`` (fewer rows than an even share of the sample) or NULL. A lazy
    plan: an aggregate, joined with the list of possible strata."""
    spark = binned.sparkSession
    possible = spark.createDataFrame([(f"{i}_{j}",) for i in range(n_bins) for j in range(n_bins)], f"{strata_col} string")
    counts = binned.groupBy(strata_col).agg(F.count(F.lit(1)).alias("n"))
    told = possible.join(counts, strata_col, "full").withColumn("n", F.coalesce("n", F.lit(0)))
    warning = F.when(F.col("n") == 0, F.lit("empty")).when(F.col("n") < F.lit(n_samples / n_bins**2), F.lit("few"))
    return told.select(strata_col, "n", warning.alias("warning"))


def allocate(counts: dict[str, int], n_samples: int) -> dict[str, int]:
    """Exact proportional allocation by largest remainder.

    ``q_s = floor(N c_s / C)``; the rest goes one each to the largest
    fractions (ties by stratum label); never above ``c_s``; all rows when
    ``N >= C``.
    """
    total = sum(counts.values())
    if n_samples >= total:
        return dict(counts)
    base = {s: (n_samples * c) // total for s, c in counts.items()}
    rem = {s: (n_samples * c) % total for s, c in counts.items()}
    left = n_samples - sum(base.values())
    for s in sorted(counts, key=lambda s: (-rem[s], s))[:left]:
        base[s] += 1
    return {s: min(q, counts[s]) for s, q in base.items()}


def sample_key(id_col: str, seed: int = C.SAMPLE_SEED) -> Column:
    """Deterministic row key: ``md5('<seed>|<id>')`` (same hex in any engine)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


#: The leading hexadecimal digits of a key as a number; parts of an interval
#: of them counted at a time; rows of a stratum that may be ranked.
_DIGITS = 15
_PARTS = 1024
_RANKED_ROWS = 100_000
#: Rows to rank are first ranked in so many shares.
_SHARES = 64


def _keyed(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    key = sample_key(id_col, seed)
    return df.withColumn("__key", key).withColumn("__h", F.conv(F.substring(key, 1, _DIGITS), 16, 10).cast("long"))


def _cuts(keyed: DataFrame, strata_col: str, wanted) -> tuple[dict[str, int], dict[str, tuple[int, int, int]]]:
    """(rows per stratum, (low, high, need) per stratum): a stratum's sample
    is all its rows of keys below ``low`` and ``need`` more of those from
    ``low`` to below ``high``. ``wanted``: counts -> quotas. The first count
    gives the strata too; others follow only where more than _RANKED_ROWS
    rows share the leading bits of the last key."""
    top = 16**_DIGITS
    part = F.floor(F.col("__h") / F.lit(top // _PARTS)).cast("long")
    rows = keyed.groupBy(strata_col, part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # _PARTS a stratum
    counts: dict[str, int] = {}
    for r in rows:
        counts[r[0]] = counts.get(r[0], 0) + r["n"]
    quotas = {s: q for s, q in wanted(counts).items() if q > 0}
    cuts: dict[str, tuple[int, int, int]] = {}
    crowded = {s: (0, top // _PARTS, q) for s, q in quotas.items()}  # low, width, need
    while crowded:
        by: dict[str, list[tuple[int, int]]] = {}
        for r in rows:
            by.setdefault(r[0], []).append((r["part"], r["n"]))
        again = {}
        for s, (low, width, need) in crowded.items():
            for p, n in sorted(by[s]):
                if need <= n:
                    if need < n and n > _RANKED_ROWS and width > 1:
                        again[s] = (low + p * width, max(1, width // _PARTS), need, low + (p + 1) * width)
                    elif need == n:
                        cuts[s] = (low + (p + 1) * width, low + (p + 1) * width, 0)
                    else:
                        cuts[s] = (low + p * width, low + (p + 1) * width, need)
                    break
                need -= n
        crowded = {s: (low, width, need) for s, (low, width, need, _) in again.items()}
        if crowded:
            spark = keyed.sparkSession
            ends = spark.createDataFrame([(s, low, high, width) for s, (low, width, _, high) in again.items()], f"{strata_col} string, __low long, __high long, __width long")
            inside = keyed.join(F.broadcast(ends), strata_col).filter("__h >= __low AND __h < __high")
            part = F.floor((F.col("__h") - F.col("__low")) / F.col("__width")).cast("long")
            rows = inside.groupBy(strata_col, part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    return counts, cuts


def pick_per_stratum(df: DataFrame, wanted, id_col: str, strata_col: str = "strata", seed: int = C.SAMPLE_SEED) -> tuple[DataFrame, dict[str, int]]:
    """L2 row pick: per stratum the ``quota`` rows with the smallest key, and
    the rows per stratum. ``wanted`` makes quotas of counts. Rows that share
    an id share a key; the other columns decide among them."""
    keyed = _keyed(df, id_col, seed)
    counts, cuts = _cuts(keyed, strata_col, wanted)
    if not cuts:
        return df.limit(0), counts
    spark = df.sparkSession
    bounds = spark.createDataFrame([(s, *x) for s, x in cuts.items()], f"{strata_col} string, __low long, __high long, __need long")
    near = keyed.join(F.broadcast(bounds), strata_col).filter("__h < __high OR __h < __low")
    sure = near.filter("__h < __low")
    order = ["__key", *[c for c in df.columns if c != strata_col]]
    edge = near.filter("__h >= __low").withColumn("__share", F.monotonically_increasing_id() % _SHARES)
    first = Window.partitionBy(strata_col, "__share").orderBy(*order)
    edge = edge.withColumn("__rn", F.row_number().over(first)).filter("__rn <= __need")
    edge = edge.withColumn("__rn", F.row_number().over(Window.partitionBy(strata_col).orderBy(*order))).filter("__rn <= __need")
    return sure.select(*df.columns).unionByName(edge.select(*df.columns)), counts


def strata_of(df: DataFrame, n_bins: int, use_qcut: bool = True) -> DataFrame:
    """``df`` with ``complexity_bin``, ``length_bin`` and ``strata``; the
    label always keeps its separator (trap D11)."""
    if use_qcut:  # the edges of both columns share the counting rounds
        qs = exact_quantiles_many(df, ["complexity", "length"], [i / n_bins for i in range(n_bins + 1)])
        binned = df.withColumn("complexity_bin", bin_by_edges(F.col("complexity"), _edges(qs["complexity"])))
        binned = binned.withColumn("length_bin", bin_by_edges(F.col("length"), _edges(qs["length"])))
    else:
        binned = width_bins(df, "complexity", n_bins, "complexity_bin")
        binned = width_bins(binned, "length", n_bins, "length_bin")
    label = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("complexity_bin", "length_bin")]
    return binned.withColumn("strata", F.concat(label[0], F.lit("_"), label[1]))


#: Tells apart rows that share an id: a hash of the text.
TEXT_MARK = "__text_mark"


def sample_rows(
    df: DataFrame,
    id_col: str,
    n_samples: int = 20,
    n_bins: int = 5,
    use_qcut: bool = True,
    seed: int = C.SAMPLE_SEED,
    keep: list[str] | None = None,
    staged: bool = False,
) -> DataFrame:
    """L2: exactly ``n_samples`` rows allocated to complexity x length
    strata proportionally (no text needed); ids may repeat.

    ``df`` carries ``id_col``, ``complexity``, ``length``, ``fk_grade`` and
    ``f_ease`` (see ``metrics.add_complexity``), and TEXT_MARK if the text is
    to be attached. The bins, the strata counts and the pick all read one
    staged copy of these narrow columns.
    """
    cols = list(dict.fromkeys([id_col, *C.SAMPLE_COLUMNS, *(keep or []), *[c for c in df.columns if c == TEXT_MARK]]))
    base = df.select(*cols)
    if not staged:
        base = stage(base, "sample-input", spread=False)
    out, counts = pick_per_stratum(strata_of(base, n_bins, use_qcut), lambda c: allocate(c, n_samples), id_col, "strata", seed)
    for msg in strata_warnings(counts, n_samples, n_bins):
        log.warning(msg)
    return out


def attach_text(sample: DataFrame, source: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The sampled rows with their text, each once: rows are told apart by id
    and TEXT_MARK, and rows that share both share the text. The sample is
    stored, so the planner knows its size and decides how to join."""
    kept = stage(sample, "sample", spread=False)
    keys = kept.select(F.col(id_col).alias("__id"), F.col(TEXT_MARK).alias("__mark")).distinct()
    texts = source.select(F.col(id_col).alias("__own"), F.col(text_col), F.xxhash64(text_col).alias("__hash"))
    same = F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__mark"))
    texts = texts.join(keys, same, "left_semi").groupBy("__own", "__hash").agg(F.first(text_col).alias(text_col))
    mine = F.col(id_col).eqNullSafe(F.col("__own")) & (F.col(TEXT_MARK) == F.col("__hash"))
    return kept.drop(*[c for c in kept.columns if c == text_col]).join(texts, mine).drop("__own", "__hash", TEXT_MARK)


def sample_texts(
    df: DataFrame,
    text_col: str,
    id_col: str,
    n_samples: int = 20,
    n_bins: int = 5,
    use_qcut: bool = True,
    seed: int = C.SAMPLE_SEED,
) -> DataFrame:
    """L2 + L1 with the text: ``(text, complexity, length, fk_grade,
    f_ease)`` plus the id, sorted by complexity."""
    sample = sample_rows(df.withColumn(TEXT_MARK, F.xxhash64(text_col)), id_col, n_samples, n_bins, use_qcut, seed)
    out = attach_text(sample, df, id_col, text_col)
    return out.select(id_col, text_col, *C.SAMPLE_COLUMNS).orderBy("complexity", id_col)


def ranked_by_complexity(sample: DataFrame, id_col: str) -> DataFrame:
    """L1: ``place`` (from 1) by ascending complexity, then id. The sample is
    small by contract (``n_samples`` rows); for whole tables see
    ``assemble.add_row_index``."""
    return sample.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("complexity", id_col)).cast("bigint"))
