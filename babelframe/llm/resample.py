"""Importance resampling towards a target distribution of hashed n-grams.

Both the corpus and the target texts are counted as bags of word n-grams
hashed into buckets. A bucket's gain is the log ratio of its smoothed shares
in the target and in the corpus, a document's weight the mean gain of its
n-grams. Adding Gumbel noise that depends on the seed and the doc_id alone
turns "the highest scores" into a draw without replacement in proportion to
the weights' exponentials, repeatable at every number of tasks.

Counting works on whole batches: the texts of a batch are joined with a
separator that no word holds, one regex pass finds the words of all of them,
``searchsorted`` against the offsets of the texts tells each word's document,
n-grams whose ends lie in two documents are masked, and ``bincount`` does the
rest. A batch is cut at ``SLICE_BYTES``; a longer text is a batch of its own.

What leaves a task in the first pass is one count a bucket; the table of
gains (``buckets`` whole numbers) is what is broadcast. Ranks come from a
range-partitioned sort of four numbers a document, so no task sees all of
them.

Edge cases: a NULL text has no words; a document without n-grams has weight
0; repeated rows are documents each (the corpus counts all of them); a row
without doc_id has a weight but no score, and is not drawn; ties go to the
smaller doc_id; an empty corpus or target gives no rows or smoothed gains.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C

BUCKETS, MAX_N, MIN_WORDS, PER_CENT, SEED = 10_000, 1, 20, 10, 2024

#: Words of lower-cased UTF-8: ASCII digits and letters, and every byte of a
#: character beyond ASCII.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SEPARATOR = b"\n"


def ngram_buckets(texts: list[bytes], max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every n-gram of up to ``max_n`` words of several
    UTF-8 texts, and the number of words of each."""
    joined = _SEPARATOR.join(texts).lower()
    ends = np.cumsum([len(t) + len(_SEPARATOR) for t in texts])
    if max_n == 1:
        found = _WORD.findall(joined)
        starts = _starts(joined)
    else:
        spans = [m.span() for m in _WORD.finditer(joined)]
        found = [joined[a:b] for a, b in spans]
        starts = np.array([a for a, _ in spans], np.int64)
    doc = np.searchsorted(ends, starts, "right")
    rows, features = [doc], [found]
    for n in range(2, max_n + 1):
        inside = doc[n - 1 :] == doc[: len(doc) - n + 1]
        rows.append(doc[: len(doc) - n + 1][inside])
        features.append([b" ".join(found[i : i + n]) for i in np.flatnonzero(inside).tolist()])
    flat = [f for some in features for f in some]
    bucket = np.fromiter(map(zlib.crc32, flat), np.int64, len(flat)) % buckets
    return np.concatenate(rows), bucket, np.bincount(doc, minlength=len(texts))


#: Bytes that words consist of.
_IN_WORD = np.array([_WORD.match(bytes([b])) is not None for b in range(256)])


def _starts(joined: bytes) -> np.ndarray:
    """Where the regex's words begin: bytes of a word after one of none."""
    inside = _IN_WORD[np.frombuffer(joined, np.uint8)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    return np.flatnonzero(begins)


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _counted(max_n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in C.slices(batches, "text"):
            total += np.bincount(ngram_buckets(_texts(b.column(0)), max_n, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return run


def bucket_counts(df: DataFrame, text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""
    found = df.select(F.col(text_col).alias("text")).mapInArrow(_counted(max_n, buckets), "bucket int, n long")
    counts = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        counts[r["bucket"]] = r["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(target share / corpus share)) of each bucket, smoothed
    by one n-gram a bucket."""
    n = len(corpus)
    ratio = (target + 1.0) * float(corpus.sum() + n) / ((corpus + 1.0) * float(target.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(held, max_n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for b in C.slices(batches, "text"):
            doc, bucket, words = ngram_buckets(_texts(b.column(1)), max_n, len(table))
            n = np.bincount(doc, minlength=b.num_rows)
            # whole numbers below 2**53: the float sums of bincount are exact
            total = np.bincount(doc, weights=table[bucket], minlength=b.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(words, pa.int64()), pa.array(total // np.maximum(n, 1))],
                names=["doc_id", "n_features", "n_words", "weight"],
            )

    return run


def weights(
    df: DataFrame, table: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = MAX_N
) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of every row."""
    held = C.broadcast(df.sparkSession, table)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_weighed(held, max_n), "doc_id long, n_features long, n_words long, weight long")


def noise(seed: int):
    """floor(1000 * Gumbel noise) of a doc_id: the same for one seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``rank`` (from 1) in the given order, for any number of
    rows: a range-partitioned sort, stored once, whose partitions are then
    offset by the sizes of those before them."""
    place = F.monotonically_increasing_id()  # partition in the upper bits, row within it in the lower 33
    kept = C.staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", place), "ranked")
    part = F.shiftright("__place", 33)
    sizes = sorted((r["part"], r["count"]) for r in kept.groupBy(part.alias("part")).count().collect())  # a row a partition
    if not sizes:
        return kept.select(*df.columns, F.lit(None).cast("long").alias("rank"))
    before = np.cumsum([0] + [n for _, n in sizes])
    starts = df.sparkSession.createDataFrame([(int(p), int(b)) for (p, _), b in zip(sizes, before, strict=False)], "__part long, __before long")
    numbered = kept.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return numbered.select(*df.columns, (F.col("__before") + F.col("__place").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    per_cent: int = PER_CENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank) of every row of
    ``df``; ``rank`` is NULL for rows that are not drawn. Of the N documents
    of at least ``min_words`` words, floor(per_cent * N / 100) are drawn."""
    table = gains(bucket_counts(df, text_col, max_n, buckets), bucket_counts(target, target_col, max_n, buckets))
    scored = weights(df, table, id_col, text_col, max_n).withColumn("score", F.col("weight") + noise(seed))
    scored = C.staged(scored, "scored")
    may = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    placed = C.staged(ranked(scored.filter(may), F.desc("score"), F.asc("doc_id")), "placed")
    drawn = per_cent * placed.count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.filter(~may).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).unionByName(rest)


def drawn_rows(df: DataFrame, resampled: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that were drawn, with all their columns."""
    ids = resampled.filter("rank IS NOT NULL").select(F.col("doc_id").alias("__id")).distinct()
    return df.join(ids, F.col(id_col) == F.col("__id"), "left_semi")
