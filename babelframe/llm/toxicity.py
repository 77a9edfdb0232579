"""Toxicity by noisy-channel deobfuscation.

A writer who hides a word replaces letters by look-alikes, repeats letters or
puts characters between them. Each suspicious token becomes a character
lattice: a look-alike may stand for its letters or be noise, a repeated letter
may be one letter, a separator may be nothing (inside a run of single
characters also a word end). A character trigram model, counted over the
whole corpus, is the source model; a Viterbi search finds the most probable
text. Look-alikes at either end of a token are in its lattice too; '(' or
'¡' in front and '!' behind a word are common punctuation and dropped at a
low cost. Tokens without such characters have one path and stay as they are.
Restored words, with repeated letters squeezed, and their beginnings are
scored by a logistic model.

The trigram counts cover all texts. The logistic model is fitted on about
SAMPLE_ROWS labelled rows; its features are the words with the largest
log-odds of the label, at most FEATURES of them.

Edge cases: NULL and empty texts have no words and get the model's base
score; labels other than 0 and 1 are not learned from; without any label all
scores are 0; words of scripts outside the model's alphabet pass unchanged.
"""

from __future__ import annotations

import array
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C

#: Labelled rows the logistic model is fitted on, about; its features, at most.
SAMPLE_ROWS, FEATURES, SUPPORT, LOG_ODDS = 12_000, 4000, 3, 2.0
CACHE_TOKENS = 200_000
#: Word beginnings of these lengths are features as well.
STEMS = (5, 7)

# Letters of the source model: a-z and the lower-case letters U+00DF-U+017F.
ALPHABET = [chr(c) for c in [*range(97, 123), *range(0xDF, 0x180)] if chr(c).isalpha() and chr(c).islower()]
PLACE = {c: i + 1 for i, c in enumerate(ALPHABET)}  # 0: word boundary
K = len(ALPHABET) + 1
_LUT = np.zeros(0x110000, np.int16)
for _c, _i in PLACE.items():
    _LUT[ord(_c)] = _i

# Look-alikes of letters (fixed values).
LOOK = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "¡": "i",
}
#: Those that are common punctuation in front of a word or behind it; there
#: they may be noise at the cost MARK.
OPENING, CLOSING = "(¡", "!"
#: Channel costs in nats.
AS_LETTER, AS_NOISE, GAP, BREAK, SPLIT, SECOND, FURTHER, MARK = 1.0, 9.0, 0.3, 2.0, 5.0, 2.5, 0.2, 1.0
_JOIN = "\x1f"  # stands for the space between single characters
# A token without the characters around it that can be no letters.
_END = f"(?:[^\\W_]|[{re.escape(''.join(LOOK))}])"
_CORE = re.compile(f"{_END}(?:.*{_END})?", re.DOTALL)
_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1\1")
_SQUEEZE = re.compile(r"(.)\1+", re.DOTALL)


def trigram_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    x = _LUT[points].astype(np.int64)
    x = x[np.append(True, (x[1:] > 0) | (x[:-1] > 0))]
    code = (x[:-2] * K + x[1:-1]) * K + x[2:]
    return np.bincount(code, minlength=K**3)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(K**3, np.int64)
    for b in C.slices(batches, "text"):
        total += trigram_counts("  " + "  ".join(b.column(0).to_pylist()).lower() + "  ")
    code = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], names=["code", "n"])


def source_model(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probability of a letter after two others (K x K x K, flat), from
    the trigrams of all texts; smoothed by the bigram and letter shares."""
    counts = df.select(F.col(text_col).alias("text")).mapInArrow(_count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    n = np.zeros(K**3)
    for r in counts.collect():  # at most K**3 trigrams of a fixed alphabet
        n[r["code"]] = r["n"]
    n = n.reshape(K, K, K)
    one = n.sum((0, 1)) + 1
    two = n.sum(0)
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (n + 5 * p2[None]) / (n.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32).ravel()


def lattice(token: str) -> list[list[tuple[int, float]]]:
    """For each character its readings (letter, 0: word end, -1: nothing) and costs."""
    out, before, again = [], "", 0
    inner = [i for i, c in enumerate(token) if c.isalnum()]
    first, last = (inner[0], inner[-1]) if inner else (0, len(token))
    for i, c in enumerate(token):
        again = again + 1 if c == before else 0
        before = c
        if c in PLACE:
            options = [(PLACE[c], 0.0)]
            if again:
                options.append((-1, SECOND if again == 1 else FURTHER))
        elif c in LOOK:
            mark = i < first and c in OPENING or i > last and c in CLOSING
            options = [(PLACE[x], AS_LETTER) for x in LOOK[c]] + [(-1, FURTHER if again else MARK if mark else AS_NOISE)]
        elif c == _JOIN:
            options = [(-1, 0.0), (0, BREAK)]
        elif c.isalnum():
            options = [(0, 0.0)]
        else:
            options = [(-1, GAP), (0, SPLIT)]
        out.append(options)
    return out


def restore(token: str, model: array.array) -> list[str]:
    """The words of the most probable reading of a token."""
    states = {(0, 0): (0.0, None)}
    for options in lattice(token):
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (s, path) in states.items():
            base = (a * K + b) * K
            for c, cost in options:
                if c < 0 or (c == 0 and b == 0):
                    key, x = (a, b), (s - cost, path)
                else:
                    key, x = (b, c), (s - cost + model[base + c], (c, path))
                if key not in new or new[key][0] < x[0]:
                    new[key] = x
        states = new
    _, path = max(((s + (model[(a * K + b) * K] if b else 0.0), p) for (a, b), (s, p) in states.items()), key=lambda x: x[0])
    letters = []
    while path is not None:
        letters.append(ALPHABET[path[0] - 1] if path[0] else " ")
        path = path[1]
    return "".join(reversed(letters)).split()


class Reader:
    """Restored, squeezed words of texts; frequent tokens are looked up."""

    def __init__(self, model: np.ndarray, wanted: dict[str, int] | None = None):
        self.model = array.array("f", model.tobytes())
        self.wanted = wanted
        self.known: dict[str, tuple] = {}

    def token(self, raw: str) -> tuple:
        core = _CORE.search(raw)
        if core is None:
            return ()
        word = core.group()
        if _PLAIN.fullmatch(word) and not _RUN.search(word):
            words = [word]
        elif not any(c.isalpha() for c in word):
            words = []
        else:
            words = restore(word, self.model) or _PLAIN.findall(word)
        if len(words) > 1:
            words.append("".join(words))
        words = [_SQUEEZE.sub(r"\1", w) for w in words]
        words += [f"{w[:n]}*" for w in words for n in STEMS if len(w) > n]
        if self.wanted is None:
            return tuple(words)
        return tuple(self.wanted[w] for w in words if w in self.wanted)

    def words(self, text: str) -> set:
        known = self.known
        tokens = text.lower().split()
        out = set()
        for t in set(tokens):
            found = known.get(t)
            if found is None:
                if len(known) > CACHE_TOKENS:
                    known.clear()
                found = known[t] = self.token(t)
            out.update(found)
        single = [i for i, t in enumerate(tokens) if len(t) == 1 or (len(t) == 2 and not t[1].isalnum())]
        at = 0
        while at < len(single):  # runs of single characters
            to = at
            while to + 1 < len(single) and single[to + 1] == single[to] + 1:
                to += 1
            if to - at >= 2:
                out.update(self.token(_JOIN.join(tokens[single[at] : single[to] + 1])))
            at = to + 1
        return out


def _words(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held.value)
        for b in C.slices(batches, "text"):
            found = [list(reader.words(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], names=["id", "y", "words"])

    return run


def logistic(rows: list[list[int]], y: np.ndarray, n: int, l2: float = 0.002, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic model on sets of features."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], np.int64)
    w, b = np.zeros(n), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    mw, vw, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for t in range(1, steps + 1):
        z = b + np.bincount(row, w[col], len(rows))
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(rows)
        gw, gb = np.bincount(col, err[row], n) + l2 / len(rows) * w, err.sum()
        mw, vw, mb, vb = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw * gw, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w = w - 0.1 * (mw / (1 - 0.9**t)) / (np.sqrt(vw / (1 - 0.999**t)) + 1e-9)
        b = b - 0.1 * (mb / (1 - 0.9**t)) / (math.sqrt(vb / (1 - 0.999**t)) + 1e-9)
    return w, b


def learn(
    labelled: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS
) -> tuple[dict[str, int], np.ndarray, float]:
    """(word -> feature, weights, offset)."""
    held = C.broadcast(labelled.sparkSession, model)
    sample = C.some_rows(labelled.filter(F.col(label_col).isin(0, 1)), id_col, rows).select(
        F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("y"), F.col(text_col).alias("text")
    )
    read = C.staged(sample.mapInArrow(_words(held), "id string, y int, words array<string>"), "words")
    n1, n = read.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count("*")).first()
    if not 0 < n1 < n:
        return {}, np.zeros(0), 30.0 if n and n1 == n else -30.0
    counts = read.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("y").alias("n1"), F.count("*").alias("n"))
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n") - F.col("n1") + 0.5) / (n - n1 + 1))
    top = (
        counts.filter(F.col("n1") >= SUPPORT)
        .withColumn("odds", odds)
        .filter(F.col("odds") >= LOG_ODDS)
        .orderBy(F.desc("odds"), "word")
        .limit(FEATURES)  # the model's size
        .collect()
    )
    wanted = {r["word"]: i for i, r in enumerate(top)}
    keep = F.array_intersect("words", F.lit(list(wanted)) if wanted else F.array().cast("array<string>"))
    sets = sorted((r["id"] or "", r["y"], sorted(wanted[w] for w in r["w"])) for r in read.select("id", "y", keep.alias("w")).collect())
    w, b = logistic([s[2] for s in sets], np.array([s[1] for s in sets], float), len(wanted))
    return wanted, w, b


def _score(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, wanted, w, b = held.value
        reader = Reader(model, wanted)
        for batch in C.slices(batches, "text"):
            z = [b + sum(w[i] for i in sorted(reader.words(t))) for t in batch.column(1).to_pylist()]
            p = [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) if b > -30 else 0.0 for x in z]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=[batch.schema.names[0], "score"])

    return run


def score(df: DataFrame, model: np.ndarray, fitted: tuple[dict[str, int], np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the probability that the whole restored text is toxic."""
    held = C.broadcast(df.sparkSession, (model, *fitted))
    return df.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(_score(held), f"`{id_col}` {dict(df.dtypes)[id_col]}, score double")
