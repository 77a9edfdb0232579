"""Repeated passages by a sparse suffix array.

``repeated_passages(df)`` finds every run of words that lies in windows of
``MIN_WORDS`` words which also occur, word for word, in another document.

1. Retain suffixes at minimisers: the position of the smallest ``GRAM``-word
   hash of every ``WINDOW`` consecutive ones. The choice depends on content
   only, so equal passages retain the same suffixes; a passage of MIN_WORDS
   words retains one in its first WINDOW words, with at least ``PREFIX``
   words of the passage after it.
2. Sort and compare neighbours: the suffixes are range-partitioned and sorted
   by the hash of their first PREFIX words, then by document. Suffixes of one
   prefix are neighbours then; a run of neighbours stays if it holds two
   documents.
3. Extend left and right: a suffix that stays is extended to the left word by
   word, as far as it is the one that a passage beginning there would have
   retained, and to the right to MIN_WORDS words. The extended suffixes are
   sorted and their neighbours compared in the same way: equal ones of two
   documents are a repeated window. Windows that overlap join to a maximal
   passage. This leaves no partner out: equal windows have retained the same
   suffix, so it is exact for the definition above.

The sort deals the suffixes of a crowded prefix to as many tasks as they need.
Only the first and the last run of a partition may go on in another one: what
each partition knows of those two (its smallest and largest document) goes
to the driver, two rows a partition, and back to all tasks.

Documents with equal texts are worked on once; each of them is a repeated
passage as a whole (if it has MIN_WORDS words).

Words are runs without \\x20 and \\x09-\\x0D, compared in their own case. NULL,
empty and short texts have no passages; repeats inside one document alone do
not count; a row without doc_id takes no part; repeated rows count as one
document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C

#: A passage of over 50 words stays findable if its rim words are fused with
#: their neighbours.
MIN_WORDS = 48
GRAM, WINDOW = 8, 25
PREFIX = MIN_WORDS - WINDOW + 1


def anchors(w: C.Words, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(begin, word): for each word that begins ``window`` grams of its row,
    the word of the leftmost smallest of them."""
    at, h = C.runs(w, gram)
    if len(at) < window:
        return at[:0], at[:0]
    views = np.lib.stride_tricks.sliding_window_view(h, window)
    pick = np.concatenate([np.argmin(views[i : i + 65536], 1) + np.arange(i, min(i + 65536, len(views))) for i in range(0, len(views), 65536)])
    one_row = w.row[at[: len(pick)]] == w.row[at[window - 1 :]]
    return at[: len(pick)][one_row], at[pick[one_row]]


def minimisers(w: C.Words, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """Word positions of the leftmost smallest gram in each window of grams."""
    return np.unique(anchors(w, gram, window)[1])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in C.slices(batches, "text", C.SMALL_SLICE_BYTES):
        w = C.words(b.column(2), chars=True)
        at, key = C.runs(w, PREFIX, minimisers(w))
        n = np.diff(w.first)
        some = np.flatnonzero(n)
        edge = np.zeros((2, b.num_rows), np.int64)
        if len(some):
            char, base = w.char
            edge[0, some] = char[w.start[w.first[some]]] - base[some]
            edge[1, some] = char[w.end[w.first[some + 1] - 1]] - base[some]
        count = np.bincount(w.row[at], minlength=b.num_rows)
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                b.column(1),
                pa.array(n, pa.int64()),
                pa.array(edge[0]),
                pa.array(edge[1]),
                C.lists(key.view(np.int64), count, pa.int64()),
                C.lists(at - w.first[w.row[at]], count, pa.int32()),
            ],
            names=["id", "digest", "n", "from", "to", "keys", "places"],
        )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    """(at a border, rows) of a partition sorted by ``key``: whole runs of
    equal keys; the first and the last run may have more rows elsewhere."""
    held: list[pa.RecordBatch] = []  # the last run so far
    last, first = None, True
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("key").to_numpy()
        if held and key[0] == last == key[-1]:
            held.append(b)
            continue
        rows = pa.Table.from_batches([*held, b]).combine_chunks()
        key = rows.column("key").to_numpy()
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        at = 0
        if len(cuts):
            if first:
                at, first = int(cuts[0]), False
                yield True, rows.slice(0, at)
            if cuts[-1] > at:
                yield False, rows.slice(at, int(cuts[-1]) - at)
            at = int(cuts[-1])
        held, last = rows.slice(at).to_batches(), key[-1]
    if held:
        yield True, pa.Table.from_batches(held).combine_chunks()


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of runs that hold two documents, with ``first``, the smallest of
    them; and all rows of runs at a border, whose ``first`` is not known."""
    for border, rows in _neighbours(batches):
        id_, key = rows.column("id").to_numpy(), rows.column("key").to_numpy()
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(head, len(key)))
        low, high = id_[head], id_[head + size - 1]  # sorted by document within a run
        first = pa.array(np.repeat(low, size), mask=np.full(len(key), border))
        some = rows.append_column("first", first).filter(pa.array(np.repeat(border | (low != high), size)))
        if len(some):
            yield from some.combine_chunks().to_batches()


def _told(held):
    """The rows of runs that hold two documents; those at a border are looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, low, high = held.value
        for b in batches:
            first = b.column(b.num_columns - 1)
            unknown = first.is_null().to_numpy(zero_copy_only=False)
            if unknown.any():
                at = np.searchsorted(key, b.column("key").to_numpy()[unknown])
                known = first.fill_null(0).to_numpy().copy()
                known[unknown] = low[at]
                keep = ~unknown
                keep[unknown] = low[at] != high[at]
                b = pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(known)], names=b.schema.names).filter(pa.array(keep))
            yield b

    return run


def _compared(df: DataFrame, name: str) -> DataFrame:
    """The sparse suffix array of ``df`` (key, id, word, ...), range-partitioned
    and sorted, and its neighbours compared: the rows of keys that two
    documents hold, with ``first``, the smallest of them."""
    order = ["key", "id", "word"]
    kinds = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", first long"
    array = df.repartitionByRange(*order).sortWithinPartitions(*order)
    array = C.staged(array.mapInArrow(_several, kinds), name)
    border = array.filter("first IS NULL").groupBy("key").agg(F.min("id"), F.max("id")).collect()  # two keys a partition
    edges = np.array(sorted(map(tuple, border)), np.int64).reshape(-1, 3)
    held = C.broadcast(df.sparkSession, tuple(np.ascontiguousarray(x) for x in edges.T))
    return array.mapInArrow(_told(held), kinds)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, [words of suffixes], text) -> the windows that have retained one
    of the suffixes: hash, first word, characters from and to."""
    for b in C.slices(batches, "text", C.SMALL_SLICE_BYTES):
        w = C.words(b.column(2), chars=True)
        words = b.column(1)
        row = np.repeat(np.arange(b.num_rows), np.diff(words.offsets.to_numpy()))
        kept = np.zeros(len(w.row) + 1, bool)
        place = words.flatten().to_numpy()
        inside = place < np.diff(w.first)[row]
        kept[(w.first[row] + place)[inside]] = True
        begin, pick = anchors(w)
        at, h = C.runs(w, MIN_WORDS, begin[kept[pick]])
        char, base = w.char
        r = w.row[at]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(h.view(np.int64)),
                b.column(0).take(pa.array(r)),
                pa.array((at - w.first[r]).astype(np.int32)),
                pa.array((char[w.start[at]] - base[r]).astype(np.int32)),
                pa.array((char[w.end[at + MIN_WORDS - 1]] - base[r]).astype(np.int32)),
            ],
            names=["key", "id", "word", "from", "to"],
        )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, [windows]) -> maximal runs of each document."""
    for b in batches:
        col = b.column(1)
        count = np.diff(col.offsets.to_numpy())
        id_ = np.repeat(b.column(0).to_numpy(), count)
        word, start, end, first = (x.to_numpy() for x in col.flatten().flatten())
        if not len(id_):
            continue
        order = np.lexsort((word, id_))
        id_, word, start, end, first = id_[order], word[order], start[order], end[order], first[order]
        new = np.ones(len(id_), bool)
        new[1:] = (id_[1:] != id_[:-1]) | (word[1:] > word[:-1] + MIN_WORDS)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(id_)) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(id_[at]),
                pa.array(start[at].astype(np.int64)),
                pa.array(end[last].astype(np.int64)),
                pa.array((word[last] - word[at] + MIN_WORDS).astype(np.int64)),
                pa.array(np.minimum.reduceat(first, at)),
            ],
            names=["id", "span_start", "span_end", "n_words", "first_doc_id"],
        )


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", later_only: bool = False) -> DataFrame:
    """Maximal repeated passages: (doc_id, span_start, span_end, n_words,
    first_doc_id); spans in code points, end exclusive; ``first_doc_id`` is
    the smallest doc_id that has one of the passage's windows.

    ``later_only``: only windows that a document with a smaller doc_id has,
    i.e. what to cut so that one occurrence of every passage stays.
    """
    docs = df.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"),
        F.col(text_col).alias("text"),
    )
    schema = "id long, digest binary, n long, from long, to long, keys array<long>, places array<int>"
    found = C.staged(docs.mapInArrow(_suffixes, schema).filter(f"n >= {MIN_WORDS}"), "suffixes")
    groups = C.staged(
        found.groupBy("digest")
        .agg(F.min(F.struct("id", "keys", "places")).alias("x"), F.max("id").alias("hi"))
        .select("digest", F.col("x.id").alias("id"), "hi", F.arrays_zip("x.keys", "x.places").alias("suffixes")),
        "texts",
    )
    suffix = groups.select("id", F.explode("suffixes").alias("s")).select(F.col("s.keys").alias("key"), "id", F.col("s.places").alias("word"))
    kept = _compared(suffix, "suffix-array").groupBy("id").agg(F.collect_list("word").alias("words"))
    kept = kept.join(groups.select("id", "digest"), "id")
    around = docs.dropDuplicates(["id", "digest"]).join(kept, ["id", "digest"]).select("id", "words", "text")
    windows = C.staged(around.mapInArrow(_windows, "key long, id long, word int, from int, to int"), "windows")
    repeated = _compared(windows, "window-array")
    if later_only:
        repeated = repeated.filter("first < id")
    repeated = C.staged(repeated.select("id", "word", "from", "to", "first"), "repeated")
    spans = (
        repeated.groupBy("id")
        .agg(F.collect_list(F.struct("word", "from", "to", "first")).alias("w"))
        .mapInArrow(_merge, "id long, span_start long, span_end long, n_words long, first_doc_id long")
    )
    # equal texts: the whole text is one passage, of all documents of the group (or all but the first)
    copied = groups.filter("id < hi").select("digest", F.col("id").alias("first"))
    whole = found.join(copied, "digest")
    if later_only:
        whole = whole.filter("first < id")
    else:
        spans = spans.join(copied.select(F.col("first").alias("id")), "id", "left_anti")
    lowest = (repeated.groupBy("id").agg(F.min("first").alias("lowest"))).withColumnRenamed("id", "first")
    whole = whole.select("id", "from", "to", "n", "first").distinct().join(lowest, "first", "left").select(
        "id",
        F.col("from").alias("span_start"),
        F.col("to").alias("span_end"),
        F.col("n").alias("n_words"),
        F.coalesce(F.least("lowest", "first"), "first").alias("first_doc_id"),
    )
    return spans.unionByName(whole).withColumnRenamed("id", "doc_id")


def cut_passages(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the spans removed from its texts; other rows and columns
    stay as they are. A text left without words becomes empty."""
    cuts = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("span_start", "span_end"))).alias("__cuts")).withColumnRenamed("doc_id", "__id")
    text = F.col(text_col)
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))
    rest = F.aggregate(
        "__cuts",
        start,
        lambda a, x: F.struct(
            F.concat(a["text"], F.substring(text, (a["at"] + 1).cast("int"), (x["span_start"] - a["at"]).cast("int"))).alias("text"),
            x["span_end"].alias("at"),
        ),
        lambda a: F.concat(a["text"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))),
    )
    rest = F.when(F.length(F.btrim(rest, F.lit(" \t\n\x0b\x0c\r"))) == 0, F.lit("")).otherwise(rest)
    return (
        df.join(cuts, F.col(id_col) == F.col("__id"), "left")
        .withColumn(text_col, F.when(F.col("__cuts").isNull(), text).otherwise(rest))
        .select(*df.columns)
    )
