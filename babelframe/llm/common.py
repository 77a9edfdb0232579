"""Shared helpers: staged tables, bounded broadcasts and vectorised words.

Word work is done on the bytes of a whole Arrow slice at once: word
boundaries, word hashes and hashes of word runs are numpy passes over the
slice, with no Python loop per document.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from babelframe.session import work_path

#: Text bytes handled by one numpy pass; only memory depends on it.
SLICE_BYTES = 2 << 20
#: The same where numpy holds many numbers for each byte at once.
SMALL_SLICE_BYTES = 512 << 10
#: Largest object that may be broadcast.
BROADCAST_BYTES = 64 << 20
#: Keys of more rows than CROWDED_ROWS, and so many that there are at most
#: CROWDED_KEYS of them, are joined in SALTS shares.
CROWDED_ROWS, CROWDED_KEYS, SALTS = 1000, 100_000, 64

U64 = np.uint64
_BASE, _BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_RUN, _RUN_INV = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts the
    lineage, and several readers share one computation."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast(spark: SparkSession, value):
    """Broadcast ``value`` after checking its pickled size."""
    n = len(pickle.dumps(value, protocol=5))
    if n > BROADCAST_BYTES:
        raise ValueError(f"{n} bytes are too many to broadcast ({BROADCAST_BYTES} at most)")
    return spark.sparkContext.broadcast(value)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL id: NULL)."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(modulus)


def some_rows(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, chosen by a hash of their id (all, if
    there are fewer): the bounded sample that classifiers are fitted on."""
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int((1 << 30) * rows / n))


def attach(left: DataFrame, right: DataFrame, keys: list[str], count: str, by: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row a key and in
    ``count`` the key's rows in ``left``. A key may hold any share of
    ``left``: the rows of crowded keys are dealt over SALTS sub-keys by a hash
    of ``by``, and ``right``'s rows of just those keys are repeated for each.
    ``right`` should be stored, as it is read three times."""
    total = right.agg(F.sum(count).alias("n")).first()["n"] or 0
    # so at most CROWDED_KEYS keys are crowded: the bound of the broadcast
    crowded = right.filter(F.col(count) > max(CROWDED_ROWS, total // CROWDED_KEYS))
    flag = F.broadcast(crowded.select(*keys, F.lit(True).alias("__crowded")))
    salt = F.when(F.col("__crowded"), F.pmod(F.xxhash64(*by), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    dealt = left.join(flag, keys, "left").withColumn("__salt", salt).drop("__crowded")
    salts = F.sequence(F.lit(0), F.when(F.col(count) > max(CROWDED_ROWS, total // CROWDED_KEYS), SALTS - 1).otherwise(0))
    spread = right.withColumn("__salt", F.explode(salts)).drop(count)
    return dealt.join(spread, [*keys, "__salt"], how).drop("__salt")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` bytes of ``column`` (one
    row at least), with NULL texts as empty ones."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        i = batch.schema.get_field_index(column)
        text = pc.fill_null(batch.column(i), "").cast(pa.string())
        batch = batch.set_column(i, column, text)
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without NULLs, and the offset of each row."""
    _, offsets, data = text.buffers()
    offs = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, U64)
        out[0] = 1
        have = _POWERS[base] = np.cumprod(out, dtype=U64)
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x + U64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of several rows, in order. ``first``: index of each row's first word."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    char: np.ndarray | None


def words(text: pa.Array, lower: bool = False, chars: bool = False) -> Words:
    """Words (runs without \\x20 and \\x09-\\x0D) of every row, with 64-bit
    hashes; ``lower`` folds A-Z. ``chars``: also the number of code points
    before each byte of the slice."""
    raw, offs = text_bytes(text)
    n = len(raw)
    solid = ~_SPACE[raw]
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    stop[:-1] &= ~solid[1:]
    edge = offs[:-1][offs[:-1] < offs[1:]]
    begin[edge] = solid[edge]
    edge = offs[1:][offs[:-1] < offs[1:]] - 1
    stop[edge] = solid[edge]
    s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = np.searchsorted(offs, s, "right") - 1
    total = np.zeros(n + 1, U64)
    np.cumsum((LOWER[raw] if lower else raw).astype(U64) * powers(_BASE, n) + powers(_BASE, n), out=total[1:])
    h = mix((total[e] - total[s]) * powers(_BASE_INV, n + 1)[s], 1) if len(s) else np.zeros(0, U64)
    char = None
    if chars:
        char = np.zeros(n + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=char[1:])
        base = char[offs[:-1]]
        char = (char, base)
    return Words(row, s, e, h, np.searchsorted(row, np.arange(len(text) + 1)), char)


def runs(w: Words, k: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each position that has ``k`` words in its
    row. Returns (positions, hashes); ``at`` limits the positions tried."""
    total = np.zeros(len(w.hash) + 1, U64)
    np.cumsum(w.hash * powers(_RUN, len(w.hash)), out=total[1:])
    if at is None:
        at = np.arange(len(w.hash))
    at = at[at + k <= len(w.hash)]
    if len(at):
        at = at[w.row[at] == w.row[at + k - 1]]
    return at, mix((total[at + k] - total[at]) * powers(_RUN_INV, len(w.hash) + 1)[at], k + 1)


def distinct_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct byte strings among the spans of ``raw`` (in order, not
    overlapping), and which of them each span is."""
    size = end - start
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    held = raw[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    spans = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(held.tobytes())])
    coded = spans.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def joined(values: list[bytes], which: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The bytes ``values[which[0]] + values[which[1]] + ...``, and where each
    of them begins (and the last ends)."""
    picked = pa.array(values, pa.binary()).take(pa.array(which))
    _, offsets, data = picked.buffers()
    return memoryview(data if data is not None else b""), np.frombuffer(offsets, np.int32)[: len(which) + 1].astype(np.int64)


class Cache:
    """What a worker process has computed, by key, in two generations bounded
    by bytes: when the young one is full it becomes the old one, and the old
    one goes. An entry that is used again moves to the young one. Only speed
    depends on it."""

    def __init__(self, limit: int, size):
        self.limit, self.size = limit // 2, size
        self.young: dict = {}
        self.old: dict = {}
        self.held = 0

    def split(self, keys: list) -> list:
        """The keys that are not held; held ones are made young."""
        young, old, missing = self.young, self.old, []
        for k in keys:
            if k not in young:
                found = old.get(k)
                if found is None:
                    missing.append(k)
                else:
                    young[k] = found
                    self.held += self.size(k, found)
        return missing

    def put(self, keys: list, values: list) -> None:
        self.young.update(zip(keys, values, strict=True))
        self.held += sum(map(self.size, keys, values))

    def turn(self) -> None:
        """Between two batches: lets the generations move on."""
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, 0


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of them in each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
