"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1, derived from its code
point. A trigram binds (multiplies) its three letter vectors, the earlier
ones permuted (rolled) once more each, so order counts. A document bundles
(adds) the vectors of all its trigrams; a language's prototype bundles the
unit vectors of its documents. The predicted language has the prototype with
the largest cosine, which is the score (negative: 0).

Letters are folded to lower case; every run of other characters is one
separator with a vector of its own, also at both ends, so the whole text
counts whatever its length.

Edge cases: NULL texts and texts without letters get ``und`` and score 0, as
does everything if no language was learned; ties go to the alphabetically
first language; labels that are NULL are not learned from.

``keep_known`` adds up the cosines of a text's trigrams, which is cheap for
prototypes of many dimensions (``learn_wide``): the fewer there are, the more
texts of unknown languages reach a bound by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C

DIMENSIONS = 512
UNKNOWN = "und"
#: Labelled rows that profiles are learned from, about.
SAMPLE_ROWS = 20_000
#: Dimensions that tell known from unknown languages: a text without a learned
#: trigram has cosine 0 with standard deviation 1 / sqrt(WIDE) = 0.0055.
WIDE = 32_768
#: Distinct trigrams whose cosines a task keeps; letters' signs it keeps, bytes.
CACHE_TRIGRAMS, CACHE_SIGNS = 400_000, 64 << 20
#: Trigram vectors held at once, bytes.
BLOCK = 32 << 20
_LETTER = np.array([chr(i).isalpha() for i in range(0x110000)])
_VECTORS: dict[int, np.ndarray] = {}
_SIGNS: dict[tuple[int, int], np.ndarray] = {}


def letter(code: int) -> np.ndarray:
    if code not in _VECTORS:
        if len(_VECTORS) > 50_000:
            _VECTORS.clear()
        _VECTORS[code] = np.random.default_rng([17, code]).choice(np.array([-1, 1], np.float32), DIMENSIONS)
    return _VECTORS[code]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code) pairs with counts; a code packs three code points (0:
    separator). Rows without letters have none."""
    joined = "".join(f" {t.lower()} " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    size = np.array([len(t.lower()) + 2 for t in texts])
    row = np.repeat(np.arange(len(texts)), size)
    points[~_LETTER[points]] = 0
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] > 0) | (points[:-1] > 0) | (row[1:] != row[:-1])
    points, row = points[keep], row[keep]
    # compact codes: the few distinct code points of a slice
    alphabet, small = np.unique(points, return_inverse=True)
    k = len(alphabet)
    code = (small[:-2] * k + small[1:-1]) * k + small[2:]
    ok = (row[:-2] == row[2:]) & ((points[:-2] > 0) | (points[1:-1] > 0) | (points[2:] > 0))
    code, row = code[ok], row[:-2][ok]
    key, count = np.unique(row * k**3 + code, return_counts=True)
    row, code = key // k**3, key % k**3
    packed = (alphabet[code // (k * k)] << 42) | (alphabet[code // k % k] << 21) | alphabet[code % k]
    return row, packed, count


def bundles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The vector of each text, and whether it has letters."""
    row, code, count = trigrams(texts)
    distinct, at = np.unique(code, return_inverse=True)
    table = np.empty((len(distinct), DIMENSIONS), np.float32)
    for i, c in enumerate(distinct.tolist()):
        table[i] = np.roll(letter(c >> 42), 2) * np.roll(letter(c >> 21 & 0x1FFFFF), 1) * letter(c & 0x1FFFFF)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i in range(0, len(texts), 128):
        for j in range(0, len(distinct), 8192):
            part = (row >= i) & (row < i + 128) & (at >= j) & (at < j + 8192)
            dense = np.zeros((min(128, len(texts) - i), min(8192, len(distinct) - j)), np.float32)
            dense[row[part] - i, at[part] - j] = count[part]
            out[i : i + 128] += dense @ table[j : j + 8192]
    return out, np.bincount(row, minlength=len(texts)) > 0


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for b in C.slices(batches, "text"):
        vectors, lettered = bundles(b.column(0).to_pylist())
        unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
        for lang in set(names := np.array(b.column(1).to_pylist(), object)):
            total[lang] = total.get(lang, 0) + unit[(names == lang) & lettered].sum(0, dtype=np.float64)
    if total:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k in total for _ in range(DIMENSIONS)]),
                pa.array(list(range(DIMENSIONS)) * len(total), pa.int32()),
                pa.array(np.concatenate(list(total.values()))),
            ],
            names=["lang", "place", "value"],
        )


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Unit prototypes of the languages, from about ``rows`` labelled rows
    chosen by a hash of their id (all, if there are fewer)."""
    labelled = C.some_rows(df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()), id_col, rows).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    sums = labelled.mapInArrow(_profiles, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():  # languages x dimensions
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["place"]] = r["value"]
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(out.items()) if np.linalg.norm(v) > 0}


def _predict(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(held.value)
        prototypes = np.array(list(held.value.values()), np.float32).reshape(len(names), DIMENSIONS)
        for b in C.slices(batches, "text"):
            at = b.schema.get_field_index("text")
            vectors, lettered = bundles(b.column(at).to_pylist())
            cosine = vectors @ prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
            known = lettered & bool(names)
            best = cosine.argmax(1) if names else np.zeros(b.num_rows, int)
            lang = [names[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
            score = np.where(known, np.clip(cosine.max(1) if names else 0, 0, 1), 0).astype(np.float64)
            rest = [c for c in range(b.num_columns) if c != at]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array(lang, pa.string()), pa.array(score)],
                names=[*(b.schema.names[c] for c in rest), "lang_pred", "score"],
            )

    return run


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    held = C.broadcast(df.sparkSession, prototypes)
    return df.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(
        _predict(held), f"`{id_col}` {dict(df.dtypes)[id_col]}, lang_pred string, score double"
    )


def _signs(code: int, n: int) -> np.ndarray:
    """``letter`` in ``n`` dimensions, as bytes."""
    if (code, n) not in _SIGNS:
        if len(_SIGNS) * n > CACHE_SIGNS:
            _SIGNS.clear()
        _SIGNS[code, n] = np.random.default_rng([17, code]).choice(np.array([-1, 1], np.int8), n)
    return _SIGNS[code, n]


def _vectors(codes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, vectors) of trigrams in ``n`` dimensions, block by block."""
    step = max(1, BLOCK // (4 * n))
    for at in range(0, len(codes), step):
        part = codes[at : at + step].tolist()
        out = np.empty((len(part), n), np.float32)
        for i, c in enumerate(part):
            a, b = _signs(c >> 42, n), _signs(c >> 21 & 0x1FFFFF, n)
            pair = np.concatenate((a[-2:], a[:-2])) * np.concatenate((b[-1:], b[:-1]))
            np.multiply(pair, _signs(c & 0x1FFFFF, n), out=out[i], casting="unsafe")
        yield at, out


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in C.slices(batches, "text", C.SMALL_SLICE_BYTES):
        row, code, count = trigrams(b.column(0).to_pylist())
        norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, b.num_rows))
        names, lang = np.unique(np.array(b.column(1).to_pylist(), str), return_inverse=True)
        distinct, at = np.unique(code, return_inverse=True)
        total = np.bincount(lang[row] * len(distinct) + at, count / norm[row], len(names) * len(distinct))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[some // max(1, len(distinct))].tolist(), pa.string()), pa.array(distinct[some % max(1, len(distinct))]), pa.array(total[some])],
            names=["lang", "code", "weight"],
        )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for b in batches:
        lang, code, weight = np.array(b.column(0).to_pylist(), object), b.column(1).to_numpy(), b.column(2).to_numpy()
        distinct, at = np.unique(code, return_inverse=True)
        names = sorted(set(lang))
        share = np.zeros((len(names), len(distinct)), np.float32)
        for i, name in enumerate(names):
            share[i] = np.bincount(at[lang == name], weight[lang == name], len(distinct))
        for place, vectors in _vectors(distinct, WIDE):
            for name, x in zip(names, share[:, place : place + len(vectors)] @ vectors, strict=True):
                total[name] = total.get(name, 0) + x.astype(np.float64)
    if total:
        values = [pa.array([v.astype(np.float32) for v in total.values()], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays([pa.array(list(total)), *values], names=["lang", "value"])


def learn_wide(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """``learn`` in WIDE dimensions, for ``keep_known``: the trigrams of the
    sample are summed first, then each distinct one is made a vector once."""
    labelled = C.some_rows(df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()), id_col, rows).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    weights = labelled.mapInArrow(_weights, "lang string, code long, weight double").groupBy("lang", "code").agg(F.sum("weight").alias("weight"))
    sums = C.staged(weights, "weights").coalesce(8).mapInArrow(_sums, "lang string, value array<float>")
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():  # at most 8 vectors for each language
        out[r["lang"]] = out.get(r["lang"], 0) + np.array(r["value"])
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(out.items()) if np.linalg.norm(v) > 0}


class Cosines:
    """The best cosine of texts with prototypes of any number of dimensions.
    A trigram's cosines are computed once; its text adds them up."""

    def __init__(self, prototypes: dict[str, np.ndarray]):
        self.p = np.array(list(prototypes.values()), np.float32)
        self.code, self.cosine = np.zeros(0, np.int64), np.zeros((0, len(self.p)), np.float32)

    def best(self, texts: list[str]) -> np.ndarray:
        """One value for each text; NaN without letters or prototypes."""
        row, code, count = trigrams(texts)
        if not len(self.p) or not len(row):
            return np.full(len(texts), np.nan)
        n = self.p.shape[1]
        distinct, at = np.unique(code, return_inverse=True)
        new = np.setdiff1d(distinct, self.code, True)
        made = [vectors @ self.p.T / n**0.5 for _, vectors in _vectors(new, n)]
        codes = np.concatenate((self.code, new))
        order = np.argsort(codes)
        self.code, self.cosine = codes[order], np.concatenate((self.cosine, *made))[order]
        own = self.cosine[np.searchsorted(self.code, distinct)][at]
        norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, len(texts)))
        sums = [np.bincount(row, count * own[:, i], len(texts)) for i in range(len(self.p))]
        if len(self.code) > CACHE_TRIGRAMS:
            self.code, self.cosine = self.code[:0], self.cosine[:0]
        return np.where(norm > 0, np.maximum(np.max(sums, 0), 0) / np.maximum(norm, 1e-9), np.nan)


def _known(held, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cosines = Cosines(held.value)
        for batch in batches:
            for b in C.slices(iter([batch.append_column("__row", pa.array(range(batch.num_rows)))]), "text", C.SMALL_SLICE_BYTES):
                best = cosines.best(b.column(b.schema.get_field_index("text")).to_pylist())
                keep = b.column(b.num_columns - 1).to_numpy()[best >= least]
                if len(keep):
                    yield batch.take(pa.array(keep))

    return run


def keep_known(df: DataFrame, prototypes: dict[str, np.ndarray], least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, as they are, whose text has a known language with
    a score of ``least`` or more; prototypes may have any dimension."""
    named = df.toDF(*["text" if c == text_col else f"c{i}" for i, c in enumerate(df.columns)])
    out = named.mapInArrow(_known(C.broadcast(df.sparkSession, prototypes), least), named.schema)
    return out.toDF(*df.columns)
