"""MinHash near-duplicates: one-permutation hashing, optimal densification,
banded buckets and star-shaped candidate edges.

``near_duplicates(df)`` gives each document the smallest doc_id that it can
reach through links; a link joins two documents whose sets of distinct
``shingle``-word shingles meet 100 * intersection >= similarity * union.

One hash of each shingle feeds all bins: the bin is taken from the high bits,
the value is the hash, so one sort gives both the distinct shingles and the
minimum of every bin. An empty bin takes the value of the first non-empty bin
in its own fixed random order of all bins. A band is a hash of ``ROWS`` bins.

Rows with equal sets are one node. In a bucket every member is compared with
one centre (a star, not all pairs): the member that shares most buckets with
others, which in a group of near copies is the text they were made from.
Members that are not connected with their centre then could have links among
each other and with the rest of the star; an exact bound on what they must
share finds those (``_rest_links``), so no candidate of the bands is lost to
the stars. Candidate pairs are confirmed on their full sets.

Edge cases: a NULL, empty or blank text has no shingles and no links; fewer
words than a shingle has are one shingle. Repeated rows get equal results; rows that
share a doc_id but not a text share that id's links. A row without doc_id
takes no part and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C

SHINGLE = 3
BANDS, ROWS = 31, 4
BINS = BANDS * ROWS
SIMILARITY = 85  # per cent; at this similarity a link misses all bands once in 10**10

#: Each bin's own random order of all bins, itself first.
_ORDER = np.array([[b, *(x for x in np.random.default_rng(1000 + b).permutation(BINS) if x != b)] for b in range(BINS)])


def shingle_sets(text: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row, sorted."""
    w = C.words(text, lower=True)
    at, h = C.runs(w, k)
    rows, hashes = [w.row[at]], [h]
    count = np.diff(w.first)
    for n in range(1, k):
        at, h = C.runs(w, n, w.first[:-1][count == n])
        rows.append(w.row[at])
        hashes.append(h)
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def signatures(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """Densified signatures, one line of ``BINS`` values for each row that has shingles."""
    bins = (((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (bins[1:] != bins[:-1])
    own = np.zeros((n_rows, BINS), np.uint64)
    full = np.zeros((n_rows, BINS), bool)
    own[row[new], bins[new]] = h[new]
    full[row[new], bins[new]] = True
    sig = own.copy()
    r, b = np.nonzero(~full & full.any(1)[:, None])
    for step in range(1, BINS):
        if not len(r):
            break
        source = _ORDER[b, step]
        hit = full[r, source]
        sig[r[hit], b[hit]] = own[r[hit], source[hit]]
        r, b = r[~hit], b[~hit]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sig), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sig), band, np.uint64)
        for i in range(band * ROWS, (band + 1) * ROWS):
            key = C.mix(key ^ sig[:, i], 7)
        keys[:, band] = key
    return keys


def _sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in C.slices(batches, "text", C.SMALL_SLICE_BYTES):
        row, h = shingle_sets(b.column(1), k)
        n = np.bincount(row, minlength=b.num_rows)
        some = np.flatnonzero(n)
        first = np.searchsorted(row, some)
        marks = np.zeros((2, b.num_rows), np.uint64)
        if len(some):
            marks[0, some] = np.add.reduceat(C.mix(h, 3), first)
            marks[1, some] = np.bitwise_xor.reduceat(C.mix(h, 4), first)
        keys = band_keys(signatures(row, h, b.num_rows))[some]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array(n, pa.int64()),
                pa.array(marks[0].view(np.int64)),
                pa.array(marks[1].view(np.int64)),
                C.lists(keys.ravel().view(np.int64), (n > 0) * BANDS, pa.int64()),
            ],
            names=["id", "n", "m1", "m2", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in C.slices(batches, "text", C.SMALL_SLICE_BYTES):
        row, h = shingle_sets(b.column(1), k)
        n = np.bincount(row, minlength=b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), C.lists(h.view(np.int64), n, pa.int64())], names=["id", "shingles"])


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(id, label): the smallest id reachable from each end of ``links`` (a, b).

    Each round takes the smallest label among the neighbours, then the label
    of that label, so chains shrink by halves.
    """
    both = C.staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = C.staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = (
            labels.join(near, labels["id"] == near["a"])
            .select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        )
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = C.staged(
            step.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("far", "label")).alias("label")),
            "labels",
        )
        labels = new.select("id", "label")
        if new.filter("label <> old").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(b, "b").join(a, "a").filter(F.least(F.size("sa"), F.size("sb")) * 100 >= F.greatest(F.size("sa"), F.size("sb")) * similarity)
    both = both.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return both.filter(F.col("common") * 100 >= union * similarity).select("a", "b")


def _rest_links(pairs: DataFrame, labels: DataFrame, sets: DataFrame, similarity: int) -> DataFrame | None:
    """Links among the members of a star that its centre did not connect.

    Let D(y) be the shingles in which y differs from the centre c. Two members
    x, y are similar enough if |D(x) - D(y)| + |D(y) - D(x)| <= k (|x| + |y|)
    with k = (1 - s) / (1 + s). If x is apart from the centre, then |D(x)| >
    k (|x| + |c|), so D(x) and D(y) share more than v = (|D(y)| + k (|c| -
    |y|)) / 2 shingles. With the shingles of D(y) in one order for the whole
    star, rarest first, one of the shared ones is among the first |D(y)| -
    floor(v). So x is compared with y only if D(x) holds one of those; chance
    edits are rare and meet nowhere.
    """
    la = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    member = pairs.join(la, "a", "left").join(lb, "b", "left").select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("label"))
    member = member.select("a", "b", "label", (F.col("la") != F.col("label")).alias("apart"))
    stars = member.groupBy("a").agg(F.max("apart").alias("some"), F.count("*").alias("size")).filter("some AND size > 1").select("a")
    member = C.staged(member.join(stars, "a", "left_semi"), "members")
    if member.isEmpty():
        return None
    sa = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    differ = F.concat(F.array_except("sb", "sa"), F.transform(F.array_except("sa", "sb"), lambda h: F.bitwise_not(h)))
    k = (100 - similarity) / (100 + similarity)
    edits = member.join(sb, "b").join(sa, "a").select("a", "b", "label", "apart", differ.alias("d"), F.size("sa").alias("na"), F.size("sb").alias("nb"))
    # 1e-6: rounding may only lengthen what is compared
    first = F.size("d") - F.floor((F.size("d") + k * (F.col("na") - F.col("nb"))) / 2 - 1e-6)
    own = ["a", "b", "label", "apart", "nb", "nd", "first"]
    edits = C.staged(edits.select("a", "b", "label", "apart", "nb", "d", F.size("d").alias("nd"), first.cast("int").alias("first")), "edits")
    each = edits.select(*own, F.explode("d").alias("t"))
    shared = each.groupBy("a", "t").agg(F.count("*").alias("n")).filter("n > 1")
    # shingles that one member alone has come first in its order and meet nobody
    seen = each.join(shared, ["a", "t"]).groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("n", "t"))).alias("d"))  # one text
    seen = C.staged(seen.withColumn("size", F.size("d")), "shared")
    left = F.greatest(F.col("first") - (F.col("nd") - F.col("size")), F.lit(0))

    def side(rows: DataFrame, name: str, tokens: Column) -> DataFrame:
        out = rows.select("a", F.col("b").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("label", "nb", "nd", "size")], F.explode(tokens).alias("e"))
        return out.withColumn("t", F.col("e.t")).drop("e")

    x = side(seen.filter("apart"), "x", F.col("d"))
    y = side(seen, "y", F.slice("d", F.lit(1), left))
    # they can share no more than the fewer of their shared shingles
    enough = 2 * F.least("size_x", "size_y") >= F.col("nd_x") + F.col("nd_y") - k * (F.col("nb_x") + F.col("nb_y")) - 1e-6
    found = x.join(y, ["a", "t"]).filter((F.col("label_x") != F.col("label_y")) & enough).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return C.staged(_confirmed(found, sets, similarity), "found")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY, shingle: int = SHINGLE
) -> DataFrame:
    """One row per row of ``df``: (id, n_shingles, component_id, kept)."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketch = C.staged(docs.mapInArrow(partial(_sketch, k=shingle), "id long, n long, m1 long, m2 long, bands array<long>"), "sketch")
    marks = ["m1", "m2", "n"]
    nodes = C.staged(
        sketch.filter("n > 0 AND id IS NOT NULL")
        .groupBy(*marks)
        .agg(F.min(F.struct("id", "bands")).alias("x"))
        .select(*marks, F.col("x.id").alias("node"), F.col("x.bands").alias("bands")),
        "nodes",
    )
    members = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("rows")).filter("lo < hi")
    shared = C.staged(shared.select("key", "rows"), "shared")
    bucket = C.staged(C.attach(members, shared, ["key"], "rows", by=["node"]).select("node", "n", "key"), "buckets")
    wanted = bucket.select(F.col("node").alias("id")).distinct()
    sets = C.staged(
        docs.join(wanted, "id", "left_semi").mapInArrow(partial(_sets, k=shingle), "id long, shingles array<long>"), "sets"
    )
    # a star for each bucket; its centre is the member with the most company, the same one in most buckets of a group
    sizes = bucket.groupBy("key").agg(F.count("*").alias("size"))
    company = bucket.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("company"))
    star = bucket.join(company, "node").groupBy("key").agg(F.max(F.struct("company", F.negative("node").alias("a"))).alias("x"))
    star = star.select("key", F.negative("x.a").alias("a"))
    pairs = star.join(bucket, "key").filter("a <> node").select(F.col("a"), F.col("node").alias("b")).distinct()
    pairs = C.staged(pairs, "pairs")
    links = C.staged(_confirmed(pairs, sets, similarity), "found")
    labels = components(links)
    more = _rest_links(pairs, labels, sets, similarity)
    labels = components(links.union(more)) if more is not None else labels
    out = (
        sketch.select("id", "n", "m1", "m2")
        .join(nodes.select(*marks, "node"), marks, "left")
        .join(labels.select(F.col("id").alias("node"), "label"), "node", "left")
    )
    component = F.when(F.col("n") > 0, F.coalesce("label", "node")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        (F.col("id").isNull() | F.col("id").eqNullSafe(component)).alias("kept"),
    )


def keep_one(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``found = near_duplicates(df)`` keeps; of
    repeated rows (one id, or none, and one text) one stays."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("#"), F.sha2(F.coalesce(text_col, F.lit("")), 256)))
    gone = found.filter("NOT kept").select(F.col("doc_id").cast("string").alias("__key")).distinct()
    keyed = df.withColumn("__key", key).withColumn("__digest", F.sha2(text_col, 256))
    return keyed.join(gone, "__key", "left_anti").dropDuplicates(["__key", "__digest"]).select(*df.columns)
