"""N-gram sufficient statistics for BLEU (M6) and chrF (M7, A1).

Counting clipped n-gram matches needs a per-row multiset intersection,
which Catalyst has no built-in for; the counts come from Arrow UDFs. They work on whole batches: the characters (or tokens) of all
hypotheses and references are numbered in one array, an n-gram's number is
made from its characters, and the longest n-grams of all rows are sorted at
once, packed with their row, which sorts the shorter ones too. Runs of equal
numbers give the counts on either side, and the smaller of both is the match.
The score formulas are native column expressions over the counts, so
corpus-level scores are plain ``sum`` aggregates over the same arrays.

Specs (public papers): BLEU - Papineni et al. 2002, one reference,
whitespace tokens (or characters), n = 1..4. chrF - Popovic 2015/2017:
character n-grams 1..6 with whitespace removed, word n-grams 1..2 with one
leading or trailing ASCII punctuation mark split off each token, beta = 2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from babelframe import constants as C

CHRF_COUNTS = 3 * (C.CHRF_CHAR_ORDER + C.CHRF_WORD_ORDER)
#: Characters worked on at a time; only memory depends on it.
BATCH_CHARS = 1 << 18
#: N-gram numbers and rows are packed below this.
_PACKED = 1 << 62

_SPACE = np.zeros(0x110000, bool)
_SPACE[[c for c in range(0x3001) if chr(c).isspace()]] = True
_PUNCT = np.zeros(0x110000, bool)
_PUNCT[[ord(c) for c in C.ASCII_PUNCTUATION]] = True


class Batch:
    """The characters without whitespace of several texts: ``codes``, their
    ``row``, and where words begin."""

    def __init__(self, texts: list[str]):
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        row = np.repeat(np.arange(len(texts)), size)
        solid = ~_SPACE[codes]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | (row[1:] != row[:-1])
        self.codes, self.row, self.word = codes[solid], row[solid], begins[solid]
        self.rows = len(texts)

    def characters(self) -> tuple[np.ndarray, np.ndarray, int]:
        """(row, number, how many numbers) of every character."""
        there = np.zeros(int(self.codes.max(initial=0)) + 1, bool)
        there[self.codes] = True
        return self.row, (np.cumsum(there) - 1)[self.codes], int(there.sum())

    def words(self, split_punctuation: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """The same of every word; ``split_punctuation`` makes a final
        punctuation mark, or else a leading one, a word of its own."""
        begins = self.word
        if split_punctuation and len(begins):
            begins = begins.copy()
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(begins)) - 1
            longer, mark = last > first, _PUNCT[self.codes]
            begins[last[longer & mark[last]]] = True
            begins[first[longer & ~mark[last] & mark[first]] + 1] = True
        first = np.flatnonzero(begins)
        offsets = np.append(first, len(self.codes)).astype(np.int64) * 4
        spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(self.codes.tobytes())])
        coded = spans.dictionary_encode()
        return self.row[first], coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.diff(np.append(first, len(keys)))


def match_counts(units: tuple[np.ndarray, np.ndarray, int], pairs: int, order: int) -> np.ndarray:
    """(pairs, order, 3): n-grams of the hypothesis, of the reference, and
    clipped matches. Rows below ``pairs`` are hypotheses, the others their
    references."""
    row, unit, base = units
    out = np.zeros((pairs, order, 3), np.int64)
    length = np.bincount(row, minlength=2 * pairs)
    for n in range(order):
        total = np.maximum(length - n, 0)
        out[:, n, 0], out[:, n, 1] = total[:pairs], total[pairs:]
    fits = 2 * pairs * (base + 1) ** order < _PACKED
    out[:, :, 2] = (_matches if fits else _matches_by_order)(row, unit, base, pairs, order)
    return out


def _matches(row: np.ndarray, unit: np.ndarray, base: int, pairs: int, order: int) -> np.ndarray:
    """(pairs, order): clipped matches. The longest n-grams are numbers to
    the base ``base + 1`` (0: the row has ended), so one sort of them, packed
    with their pair, also sorts the shorter ones, their first digits."""
    out = np.zeros((pairs, order), np.int64)
    if not len(unit):
        return out
    place = np.arange(len(unit)) + row * (order - 1)
    digits = np.zeros(int(place[-1]) + order, np.int64)
    digits[place] = unit + 1
    ends = len(digits) - order + 1
    key = digits[:ends]
    for n in range(1, order):
        key = key * (base + 1) + digits[n : n + ends]
    key = (key[place] + (row % pairs) * (base + 1) ** order) * 2 + (row < pairs)
    key.sort()
    gram, mine, size = key >> 1, key & 1, np.ones(len(key), np.int64)
    for n in range(order, 0, -1):
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        gram, mine, size = gram[first], np.add.reduceat(mine, first), np.add.reduceat(size, first)
        shorter = gram // (base + 1)
        whole = gram > shorter * (base + 1)
        match = np.minimum(mine, size - mine)
        some = np.flatnonzero(whole & (match > 0))
        out[:, n - 1] = np.bincount(gram[some] // (base + 1) ** n, weights=match[some], minlength=pairs)
        gram = shorter
    return out


def _matches_by_order(row: np.ndarray, unit: np.ndarray, base: int, pairs: int, order: int) -> np.ndarray:
    """``_matches`` for so many kinds of characters that the longest n-grams
    do not fit one number: each order is sorted on its own."""
    out = np.zeros((pairs, order), np.int64)
    start, gram, kinds = np.arange(len(unit)), unit, base
    for n in range(order):
        if n:
            if kinds * base * pairs >= _PACKED:  # number anew those that occur
                distinct, gram = np.unique(gram, return_inverse=True)
                kinds = len(distinct)
            ends = start + n
            keep = ends < len(unit)
            keep[keep] = row[ends[keep]] == row[start[keep]]
            start, gram = start[keep], gram[keep]
            gram, kinds = gram * base + unit[start + n], kinds * base
        mine = row[start] < pairs
        h, hn = _runs(row[start[mine]] * kinds + gram[mine])
        r, rn = _runs((row[start[~mine]] - pairs) * kinds + gram[~mine])
        if len(h) and len(r):
            at = np.minimum(np.searchsorted(r, h), len(r) - 1)
            same = r[at] == h
            out[:, n] = np.bincount(h[same] // kinds, weights=np.minimum(hn[same], rn[at[same]]), minlength=pairs)
    return out


def _slices(hyp: list[str], ref: list[str]) -> Iterator[slice]:
    """Rows cut so that their characters stay within BATCH_CHARS (a row at least)."""
    size = np.fromiter(map(len, hyp), np.int64, len(hyp)) + np.fromiter(map(len, ref), np.int64, len(ref))
    ends, at, done = np.cumsum(size), 0, 0
    while at < len(hyp):
        to = max(at + 1, int(np.searchsorted(ends, done + BATCH_CHARS, "right")))
        yield slice(at, to)
        at, done = to, int(ends[to - 1])


def _texts(values) -> list[str]:
    return pd.Series(values, dtype=object).fillna("").tolist()


def chrf_batch(
    hyp,
    ref,
    lowercase: bool = False,
    char_order: int = C.CHRF_CHAR_ORDER,
    word_order: int = C.CHRF_WORD_ORDER,
) -> np.ndarray:
    """3 counts (hyp, ref, match) per row and order: chars 1..6, then words
    1..2. An order that the reference has no n-gram of counts none of the
    hypothesis. NULLs are empty texts."""
    hyp, ref = _texts(hyp), _texts(ref)
    out = np.zeros((len(hyp), char_order + word_order, 3), np.int64)
    for part in _slices(hyp, ref):
        texts = hyp[part] + ref[part]
        pairs = len(texts) // 2
        b = Batch(list(map(str.lower, texts)) if lowercase else texts)
        out[part, :char_order] = match_counts(b.characters(), pairs, char_order)
        out[part, char_order:] = match_counts(b.words(True), pairs, word_order)
    out[:, :, 0][out[:, :, 1] == 0] = 0
    return out.reshape(len(hyp), -1)


def bleu_batch(hyp, ref, tokenize: str = "words", max_order: int = C.BLEU_MAX_ORDER) -> np.ndarray:
    """[hyp_len, ref_len, m_1..m_N] of each row with clipped matches m_n.
    ``tokenize``: ``words`` (parted by whitespace) or ``char`` (each character
    but whitespace), for scripts written without spaces."""
    if tokenize not in ("words", "char"):
        raise ValueError(f"tokenize is 'words' or 'char', not {tokenize!r}")
    hyp, ref = _texts(hyp), _texts(ref)
    out = np.zeros((len(hyp), 2 + max_order), np.int64)
    for part in _slices(hyp, ref):
        b = Batch(hyp[part] + ref[part])
        counts = match_counts(b.words(False) if tokenize == "words" else b.characters(), b.rows // 2, max_order)
        out[part, :2] = counts[:, 0, :2]
        out[part, 2:] = counts[:, :, 2]
    return out


def chrf_stats(hyp: str | None, ref: str | None, lowercase: bool = False) -> list[int]:
    """``chrf_batch`` of one pair."""
    return chrf_batch([hyp], [ref], lowercase)[0].tolist()


def bleu_stats(hyp: str | None, ref: str | None, tokenize: str = "words") -> list[int]:
    """``bleu_batch`` of one pair."""
    return bleu_batch([hyp], [ref], tokenize)[0].tolist()


# ------------------------------------------------------ Arrow-batched UDFs
def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lists(texts: tuple[pa.Array, ...], counts: Callable[..., np.ndarray]) -> pa.Array:
    """The lines of ``counts`` as a list column. Texts become Python strings
    a slice of about BATCH_CHARS bytes at a time."""
    size = sum(pc.fill_null(pc.binary_length(t), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
    ends, at, done, found = np.cumsum(size), 0, 0, []
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, done + BATCH_CHARS, "right")))
        found.append(counts(*(t.slice(at, to - at).to_pylist() for t in texts)))
        at, done = to, int(ends[to - 1])
    if not found:
        return pa.array([], pa.list_(pa.int64()))
    lines = np.concatenate(found)
    return pa.ListArray.from_arrays(np.arange(len(lines) + 1, dtype=np.int32) * lines.shape[1], lines.ravel())


def chrf_counts_many(specs: list[tuple[Column | str, Column | str, bool]]) -> Column:
    """Counts for several (hyp, ref, lowercase) pairs of one row in a single
    Arrow pass: one array with CHRF_COUNTS numbers a pair (see ``chrf_of``)."""
    flags = [bool(lc) for _, _, lc in specs]

    def found(*texts: list[str]) -> np.ndarray:
        return np.concatenate([chrf_batch(texts[2 * j], texts[2 * j + 1], lc) for j, lc in enumerate(flags)], 1)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def counts(*texts: pa.Array) -> pa.Array:
        return _lists(texts, found)

    return counts(*[_column(c) for h, r, _ in specs for c in (h, r)])


def chrf_of(many: Column, j: int) -> Column:
    """The counts of pair ``j`` of ``chrf_counts_many``."""
    return F.slice(many, j * CHRF_COUNTS + 1, CHRF_COUNTS)


def chrf_counts(hyp: Column | str, ref: Column | str, lowercase: bool = False) -> Column:
    return chrf_counts_many([(hyp, ref, lowercase)])


def bleu_counts(hyp: Column | str, ref: Column | str, tokenize: str = "words") -> Column:
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def counts(h: pa.Array, r: pa.Array) -> pa.Array:
        return _lists((h, r), lambda h, r: bleu_batch(h, r, tokenize))

    return counts(_column(hyp), _column(ref))


# ----------------------------------------------------- native score formulas
def chrf_from_counts(stats: Column, n_orders: int = C.CHRF_CHAR_ORDER + C.CHRF_WORD_ORDER, beta: float = C.CHRF_BETA) -> Column:
    """chrF (0-100) from the 3-per-order counts: precision and recall
    averaged over the orders where both hypothesis and reference have
    n-grams, then the F-beta score. The per-order sums are a left fold over
    the orders (same summation order as a loop), which keeps the generated
    code small when several scores share one projection."""
    factor = float(beta) ** 2

    def term(i: Column, pick: int) -> Column:
        h = F.element_at(stats, i * 3 + 1)
        r = F.element_at(stats, i * 3 + 2)
        m = F.element_at(stats, i * 3 + 3)
        ok = (h > 0) & (r > 0)
        if pick == 0:
            return F.when(ok, m / h).otherwise(F.lit(0.0))
        if pick == 1:
            return F.when(ok, m / r).otherwise(F.lit(0.0))
        return F.when(ok, F.lit(1)).otherwise(F.lit(0))

    orders = F.sequence(F.lit(0), F.lit(n_orders - 1))
    acc0 = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("r"), F.lit(0).alias("e"))
    folded = F.aggregate(
        orders,
        acc0,
        lambda acc, i: F.struct(
            (acc["p"] + term(i, 0)).alias("p"), (acc["r"] + term(i, 1)).alias("r"), (acc["e"] + term(i, 2)).alias("e")
        ),
    )
    eff = folded["e"]
    p = F.when(eff > 0, folded["p"] / eff).otherwise(F.lit(0.0))
    r = F.when(eff > 0, folded["r"] / eff).otherwise(F.lit(0.0))
    score = F.lit(1.0 + factor) * p * r / (F.lit(factor) * p + r)
    return F.when(p + r > 0, F.lit(100.0) * score).otherwise(F.lit(0.0))


def bleu_from_counts(stats: Column, max_order: int = C.BLEU_MAX_ORDER) -> Column:
    """Sentence BLEU from [c, r, m_1..m_N]: uniform weights, no smoothing (a
    zero precision counts as the smallest normal double), brevity penalty."""
    c, r = stats[0], stats[1]
    w = 1.0 / max_order
    logsum = F.lit(0.0)
    for n in range(1, max_order + 1):
        m = stats[1 + n]
        total = F.greatest(F.lit(1), c - n + 1)
        p = F.when(m > 0, m / total).otherwise(F.lit(C.SMALLEST_NORMAL_DOUBLE))
        logsum = logsum + F.lit(w) * F.log(p)
    bp = F.when(c > r, F.lit(1.0)).when(c == 0, F.lit(0.0)).otherwise(F.exp(F.lit(1.0) - r / c))
    return F.when((c == 0) | (stats[2] == 0), F.lit(0.0)).otherwise(bp * F.exp(logsum))
