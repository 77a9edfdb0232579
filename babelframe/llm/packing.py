"""Best-fit decreasing packing of tokenised documents into sequences.

``pack(df)`` tokenises whole texts, ends each with one id, cuts only what is
longer than a sequence, and packs the pieces into sequences of at most
``capacity`` ids: longest first, each into the open sequence with the
tightest sufficient room, found by descending a segment tree over remaining
capacities.

Pieces of one length are alike, so the packing is planned on the histogram of
lengths (at most ``capacity`` rows, whatever the corpus size): a run of open
sequences with the same room takes as many pieces of a length as fit before
the next run is asked for, which is what piece-by-piece best fit does. The
plan, whose size depends on ``capacity`` alone, maps ranks within a length to
(sequence, offset). Ranks come from counts per (length, bucket), so no length
is ranked in one task; the number of buckets grows with the rows of a length.

Edge cases: a NULL or empty text is the end id alone; repeated rows are
packed each; a row without doc_id is packed as well; an empty table gives no
rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from babelframe.llm import common as C

CAPACITY = 4096
END_ID = 1
#: Ranks within a length are dealt over buckets of about so many pieces.
BUCKET_ROWS = 1000
#: Bytes of a worker's cache of parts, and of a batch of texts; only speed and
#: memory depend on them.
CACHE_BYTES, BATCH_BYTES = 160 << 20, 4 << 20
CACHED_LENGTH = 64

# Texts are cut only where the vocabulary's own normaliser makes a single
# space, which its word pattern never crosses, and between a letter and a sign
# that is no apostrophe, which that pattern always parts; here for the letters
# and signs of Latin-1, as UTF-8 bytes.
_BLANK, _LETTER, _SIGN = (np.zeros(256, bool) for _ in range(3))
_BLANK[[0x20, 9, 10, 13]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN[[x for x in range(33, 127) if not _LETTER[x] and x != 39 and not 48 <= x <= 57]] = True
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LATIN_LEAD, _NOT_LETTERS = 0xC3, (0x97, 0xB7)  # U+00D7 and U+00F7 are signs


def part_spans(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of several texts in one buffer; ``rows``:
    where each text begins, and the end of the last."""
    n = len(raw)
    blank = _BLANK[raw]
    letter, sign = _LETTER[raw], _SIGN[raw]
    tail = np.zeros(n, bool)  # the last byte of a letter of Latin-1
    tail[1:] = (raw[:-1] == _LATIN_LEAD) & (raw[1:] != _NOT_LETTERS[0]) & (raw[1:] != _NOT_LETTERS[1])
    lead = np.zeros(n, bool)
    lead[:-1] = tail[1:]
    cut = np.zeros(n + 1, bool)
    cut[1:-1] = (letter | tail)[:-1] & sign[1:] | sign[:-1] & (letter | lead)[1:]
    whole = raw.tobytes()
    at = whole.find(b"<|")
    if at >= 0:  # special tokens would be cut apart: words with their mark stay whole
        word = np.cumsum(blank)
        marked = []
        while at >= 0:
            marked.append(word[at])
            at = whole.find(b"<|", at + 1)
        cut[1:-1] &= ~np.isin(word[1:], marked)
    cut[rows] = True
    cut[1:-1] |= blank[1:] != blank[:-1]
    edges = np.flatnonzero(cut)
    start, end = edges[:-1], edges[1:]
    solid = ~blank[start] if n else np.zeros(0, bool)
    return start[solid], end[solid]


class Encoder:
    """Token ids of texts as little-endian uint32 bytes.

    The ids of a text are those of its parts in order. The parts of a whole
    batch are found and counted apart in one go; those seen before are looked
    up, and new parts of letters are encoded together, as each of them is one
    word of the vocabulary.
    """

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        # a bytes object, a dict entry and the ids
        self.cache = C.Cache(CACHE_BYTES, lambda k, v: 170 + len(k) + len(v))

    def learn(self, parts: list[bytes]) -> list[bytes]:
        texts = [p.decode() for p in parts]
        letters = [i for i, t in enumerate(texts) if _LETTERS.fullmatch(t)]
        out: list = [None] * len(parts)
        for at in range(0, len(letters), 5000):
            some = letters[at : at + 5000]
            found = self.tokenizer.encode(" ".join([texts[i] for i in some]), add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            ends = (4 * np.searchsorted(found.word_ids, np.arange(len(some) + 1))).tolist()
            for i, a, b in zip(some, ends, ends[1:], strict=False):
                out[i] = ids[a:b]
        others = [i for i, x in enumerate(out) if x is None]
        for at in range(0, len(others), 1000):
            some = others[at : at + 1000]
            found = self.tokenizer.encode_batch([texts[i] for i in some], add_special_tokens=False)
            for i, e in zip(some, found, strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def ids(self, parts: list[bytes]) -> list[bytes]:
        """The ids of distinct parts."""
        cache = self.cache
        cache.turn()
        new = cache.split(parts)
        found = self.learn(new)
        short = [i for i, p in enumerate(new) if len(p) <= CACHED_LENGTH]
        cache.put([new[i] for i in short], [found[i] for i in short])
        if len(short) == len(new):
            return list(map(cache.young.__getitem__, parts))
        own = dict(zip(new, found, strict=True))
        return [own[p] if p in own else cache.young[p] for p in parts]

    def encode(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The ids of all texts in a row, and where those of each begin (and
        the last end), in bytes."""
        raw, rows = C.text_bytes(texts)
        # a lower-case letter has the ids of its capital, but where a mark
        # follows that joins one of them only, and in special tokens
        if not ((raw == 0xCC) | (raw == 0xCD)).any() and b"<|" not in raw.tobytes():
            raw = C.LOWER[raw]
        start, end = part_spans(raw, rows)
        parts, which = C.distinct_spans(raw, start, end)
        flat, ends = C.joined(self.ids(parts), which)
        return flat, ends[np.searchsorted(start, rows)]


#: The encoder of each vocabulary that this worker process has used.
_ENCODERS: dict[int, Encoder] = {}


def encoder_of(vocabulary: bytes) -> Encoder:
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def _pieces(vocabulary, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary.value)
        for b in C.slices(batches, "text", BATCH_BYTES):
            raw, ends = encoder.encode(b.column(1))
            ids = [bytes(raw[i:j]) + end for i, j in pairwise(ends.tolist())]
            rows = [(i, p, x[at : at + 4 * capacity]) for i, x in enumerate(ids) for p, at in enumerate(range(0, len(x), 4 * capacity))]
            row, piece, part = zip(*rows, strict=True)
            piece = np.array(piece, np.int32)
            columns = [
                b.column(0).take(pa.array(row)),
                pa.array(piece),
                pa.array(piece.astype(np.int64) * capacity),
                pa.array([len(x) // 4 for x in part], pa.int64()),
                pa.array([zlib.crc32(x) for x in part], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(part, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def token_pieces(
    df: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]); ``ids`` as
    little-endian uint32 bytes."""
    held = C.broadcast(df.sparkSession, Path(vocabulary).read_bytes())
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.mapInArrow(_pieces(held, capacity, end_id, with_ids), schema)


class RoomTree:
    """Segment tree over remaining capacities: which of them have open
    sequences. ``tightest(n)`` is the smallest room of at least n, or -1."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, room: int, is_open: bool) -> None:
        i = room + self.leaves
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, n: int) -> int:
        i = n + self.leaves
        if self.open[i]:
            return n
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return -1


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing of ``lengths`` (length -> pieces). Rows (length,
    first rank, sequence, pieces of a sequence, offset): the pieces of a
    length from that rank on fill sequence after sequence from that offset."""
    tree, runs = RoomTree(capacity), {}  # runs: room -> [(first sequence, sequences)]
    used, rows = 0, []

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            runs.setdefault(room, []).append((first, count))
            if len(runs[room]) == 1:
                tree.mark(room, True)

    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            room = tree.tightest(length)
            if room < 0:
                room = capacity
                first, count = used, -(-left // (capacity // length))
                used += count
            else:
                first, count = runs[room].pop()
                if not runs[room]:
                    tree.mark(room, False)
            each = room // length
            full = min(count, left // each)
            rows.append((length, rank, first, each, capacity - room))
            put(room - each * length, first, full)
            rank, left, spare = rank + full * each, left - full * each, count - full
            if left and spare:  # the last sequence takes fewer
                put(room - left * length, first + full, 1)
                full, left, spare = full + 1, 0, spare - 1
            if spare:
                put(room, first + full, spare)
    return np.array(rows, np.int64).reshape(-1, 5)


def _place(held):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = held.value
        keys = rows[:, 0] << 45 | rows[:, 1]
        for f in frames:
            n, rank = f["length"].to_numpy(), f["rank"].to_numpy()
            row = rows[np.searchsorted(keys, n << 45 | rank, "right") - 1]
            at = rank - row[:, 1]
            f["sequence_id"] = row[:, 2] + at // row[:, 3]
            f["offset"] = row[:, 4] + at % row[:, 3] * n
            yield f.drop(columns="rank")

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, ...), stored already so
    that they read alike each time, with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n"))
    lengths = {r["length"]: r["n"] for r in histogram.collect()}  # at most ``capacity`` rows
    shares = spark.createDataFrame([(k, -(-n // BUCKET_ROWS)) for k, n in lengths.items()], "length long, buckets long")
    dealt = pieces.join(F.broadcast(shares), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "buckets"))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    rows = plan(lengths, capacity)
    held = C.broadcast(spark, rows[np.lexsort((rows[:, 1], rows[:, 0]))])
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("within", F.row_number().over(within) - 1)
        .join(counts, ["length", "bucket"])
        .select(*pieces.columns, (F.col("before") + F.col("within")).alias("rank"))
    )
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInPandas(_place(held), schema)


def pack(df: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False, **columns) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset)."""
    pieces = C.staged(token_pieces(df, vocabulary, capacity=capacity, with_ids=with_ids, **columns), "pieces")
    return pack_pieces(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from ``pack(..., with_ids=True)``:
    (sequence_id, length, ids)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # bounded by the capacity
    ids = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
