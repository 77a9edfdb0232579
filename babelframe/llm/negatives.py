"""Hard negatives from an STR-packed R-tree.

An anchor's positives are its nearest rows of the same label by inner
product; the hard negatives of an (anchor, positive) are the nearest rows of
other labels whose score lies in a window below the positive's. Components
are integers, floor(SCALE * x), so scores are exact.

Rows are dealt into tiles by planes fitted on a bounded sample; large tiles
are dealt on. In each such group the rows are packed into an R-tree by
sort-tile-recursive order: by label, then by slabs of the widest coordinates.
Every box holds the range of the labels and, per coordinate, the least and
the largest value. With an anchor q, coordinate i of a box contributes
between min(q_i lo_i, q_i hi_i) and max(q_i lo_i, q_i hi_i), and the sums of
these intervals bound the score of every row in the box. A best-first queue
opens the box of the largest bound first. It prunes boxes without a fitting
label, boxes outside every window that can still gain, and, once k rows are
found, boxes strictly below the k-th (an equal one may hold a smaller id).
Whole tiles are pruned the same way before an anchor is sent to them, with
the k-th score among the sample as the first bound. Bounds are proven, so
results are exact; on vectors without structure they prune little.

Copies: equal vectors of a label are one candidate with as many of their
smallest ids as can be asked for, and equal anchors are searched once.

Edge cases: rows whose label, id or vector is NULL or whose vector holds NULL
or non-finite components or is empty take no part, nor do vectors whose
length is not the most frequent one; repeated rows of an id, label and vector
are one row; ties go to the smaller id; anchors without positives, and
positives without rows in their window, give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from babelframe.llm import common as C
from babelframe.llm import vectors as V

POSITIVES, NEGATIVES, SCALE, SAMPLE = 5, 3, 256, 2048
#: A negative's score is at least LOW and at most HIGH per cent of the positive's.
LOW, HIGH = 50, 95
#: Rows of a leaf, boxes of an inner box, coordinates that slabs are cut by.
LEAF, FANOUT, SLAB_AXES = 64, 16, 3
#: Slabs of each of the SLAB_AXES coordinates that make the tiles.
SLABS = 4


def str_order(x: np.ndarray, axes: list[int], leaf: int = LEAF) -> np.ndarray:
    """Sort-tile-recursive order of the rows: sorted by the first axis, cut
    into slabs, each of them ordered by the other axes."""
    order = np.argsort(x[:, axes[0]], kind="stable")
    if len(axes) == 1 or len(x) <= leaf:
        return order
    leaves = -(-len(x) // leaf)
    slabs = max(1, round(leaves ** (1 / len(axes))))
    size = -(-leaves // slabs) * leaf
    return np.concatenate([order[i : i + size][str_order(x[order[i : i + size]], axes[1:], leaf)] for i in range(0, len(x), size)])


@dataclass
class Level:
    """Boxes of one level; children are ``first[i]:first[i + 1]`` of the
    level below (rows, for the leaves)."""

    first: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray


class RTree:
    """Levels from the leaves to the root, over rows in STR order by label,
    then by the widest coordinates."""

    def __init__(self, x: np.ndarray, label: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        axes = np.argsort(-x.var(0), kind="stable")[:SLAB_AXES].tolist()
        by_label = np.argsort(label, kind="stable")
        cut = np.flatnonzero(np.diff(label[by_label])) + 1
        self.order = np.concatenate([rows[str_order(x[rows], axes, leaf)] for rows in np.split(by_label, cut)])
        self.x, self.label = x[self.order], label[self.order]
        low = high = self.x
        least = most = self.label
        self.levels: list[Level] = []
        while not self.levels or len(low) > 1:
            size = fanout if self.levels else leaf
            at = np.arange(0, len(low), size)
            first = np.append(at, len(low))
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append(Level(first, low, high, least, most))

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(least, largest) score of every box of every level, for each row of ``q``."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return [(up @ lv.low.T + down @ lv.high.T, up @ lv.high.T + down @ lv.low.T) for lv in self.levels]


class Nearest:
    """The k highest scores so far, with all ties of the k-th. ``ids`` gives
    each candidate's ids in ascending order."""

    def __init__(self, k: int, floor: float = -np.inf, low: float = -np.inf, high: float = np.inf):
        self.k, self.kth, self.low, self.high = k, max(floor, low), low, high
        self.found: list[tuple[float, int]] = []  # (-score, id), the best first

    def wants(self, least: float, most: float) -> bool:
        return most >= self.kth and least <= self.high

    def add(self, scores: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.kth) & (scores <= self.high)
        if not fits.any():
            return
        new = [(-s, int(i)) for s, r in zip(scores[fits].tolist(), rows[fits].tolist(), strict=True) for i in ids[r]]
        self.found = heapq.nsmallest(self.k, self.found + new)
        if len(self.found) == self.k:
            self.kth = max(self.kth, -self.found[-1][0])


def search(tree: RTree, ids: np.ndarray, q: np.ndarray, bounds: list, same: int | None, other: int | None, wanted: list[Nearest]) -> int:
    """Fills ``wanted`` with rows of label ``same``, or of labels not
    ``other``; returns the number of rows scored."""

    def fits(level: int, box: int) -> bool:
        lv = tree.levels[level]
        if same is not None:
            return lv.least[box] <= same <= lv.most[box]
        return not lv.least[box] == other == lv.most[box]

    scored, top = 0, len(tree.levels) - 1
    agenda = [(-bounds[top][1][b], top, b) for b in range(len(tree.levels[top].low)) if fits(top, b)]
    heapq.heapify(agenda)
    while agenda:
        most, level, box = heapq.heappop(agenda)
        least = bounds[level][0][box]
        if not any(w.wants(least, -most) for w in wanted):
            if all(-most < w.kth for w in wanted):
                break  # no box left has a larger bound
            continue
        lv = tree.levels[level]
        a, b = int(lv.first[box]), int(lv.first[box + 1])
        if level:
            for child in range(a, b):
                if fits(level - 1, child):
                    heapq.heappush(agenda, (-bounds[level - 1][1][child], level - 1, child))
            continue
        rows = np.arange(a, b)
        label = tree.label[a:b]
        rows = rows[label == same] if same is not None else rows[label != other]
        scores = tree.x[rows] @ q
        scored += len(rows)
        for w in wanted:
            w.add(scores, tree.order[rows], ids)
    return scored


def _tiles(x: np.ndarray, axes: list[int], cuts: list[np.ndarray]) -> np.ndarray:
    tile = np.zeros(len(x), np.int64)
    for axis, cut in zip(axes, cuts, strict=True):
        tile = tile * SLABS + np.searchsorted(cut, x[:, axis], "right")
    return tile.astype(np.int32)


def _tiled(held):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f.assign(part=_tiles(V.matrix(f["vec"]), *held.value))

    return run


def _sent_positives(held, k: int):
    """Anchors to the tiles that may hold one of their k best of their label;
    one more than asked for, as the anchor itself is among them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample, label, boxes = held.value
        for f in frames:
            if not len(f):
                continue
            x, own = V.matrix(f["vec"]), f["label"].to_numpy()
            scores = np.where(label == own[:, None], x @ sample.T, -np.inf)
            floor = np.partition(scores, -k - 1, 1)[:, -k - 1] if len(sample) > k else np.full(len(x), -np.inf)
            _, most = _box_bounds(x, boxes)
            q, t = np.nonzero(most >= floor[:, None])
            yield f.iloc[q].assign(part=boxes["part"][t], floor=floor[q])

    return run


def _box_bounds(x: np.ndarray, boxes: dict) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    return up @ boxes["low"].T + down @ boxes["high"].T, up @ boxes["high"].T + down @ boxes["low"].T


def _sent_negatives(held):
    """(anchor, its windows) to the tiles that reach into a window."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, _, boxes = held.value
        for f in frames:
            if not len(f):
                continue
            least, most = _box_bounds(V.matrix(f["vec"]), boxes)
            low = np.array([min(w["low"] for w in ws) for ws in f["windows"]])
            high = np.array([max(w["high"] for w in ws) for ws in f["windows"]])
            q, t = np.nonzero((most >= low[:, None]) & (least <= high[:, None]))
            yield f.iloc[q].assign(part=boxes["part"][t])

    return run


def _forest(c: pd.DataFrame) -> tuple[RTree, np.ndarray]:
    return RTree(V.matrix(c["vec"]), c["label"].to_numpy()), c["ids"].to_numpy()


def _find_positives(k: int):
    def work(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        tree, ids = _forest(c)
        x, out = V.matrix(q["vec"]), []
        bounds = tree.bounds(x)
        for i, (qid, label, floor) in enumerate(zip(q["qid"], q["label"], q["floor"], strict=True)):
            best = Nearest(k + 1, floor)
            search(tree, ids, x[i], [(a[i], b[i]) for a, b in bounds], label, None, [best])
            out += [(qid, x, -s) for s, x in best.found]
        return pd.DataFrame(out, columns=["qid", "id", "score"]).astype("int64")

    return work


def _find_negatives(k: int):
    def work(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        tree, ids = _forest(c)
        x, out = V.matrix(q["vec"]), []
        bounds = tree.bounds(x)
        for i, (qid, label, windows) in enumerate(zip(q["qid"], q["label"], q["windows"], strict=True)):
            wanted = [Nearest(k, low=w["low"], high=w["high"]) for w in windows]
            search(tree, ids, x[i], [(a[i], b[i]) for a, b in bounds], None, label, wanted)
            out += [(qid, w["score"], x, -s) for w, n in zip(windows, wanted, strict=True) for s, x in n.found]
        return pd.DataFrame(out, columns=["qid", "positive_score", "id", "score"]).astype("int64")

    return work


def _first(found: DataFrame, per: list[str], k: int, name: str) -> DataFrame:
    """The k best rows of each group; Spark drops the others within tasks first."""
    order = Window.partitionBy(*per).orderBy(F.desc("score"), "id")
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). ``anchors``: condition on the column ``id`` that tells
    which rows are anchors; labels are whole numbers."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vec")
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
    rows = rows.filter(~bad).select("id", "label", F.transform("vec", lambda v: F.floor(v * F.lit(float(scale))).cast("double") + F.lit(0.0)).alias("vec"))
    rows = C.staged(rows, "rows")
    rows = rows.filter(F.size("vec") == V.common_length(rows))
    # no anchor needs more of a vector's ids than these
    most, key = max(positives + 1, negatives), ["label", "vec"]
    few = Window.partitionBy(*key).orderBy("id")
    cands = rows.groupBy(*key, "id").agg(F.lit(1)).withColumn("at", F.row_number().over(few)).filter(F.col("at") <= most)
    cands = cands.groupBy(*key).agg(F.min("id").alias("gid"), F.sort_array(F.collect_list("id")).alias("ids"))
    cands = C.staged(cands.select("gid", "label", "vec", "ids"), "candidates")
    own = C.staged(rows.filter(anchors).distinct(), "anchors")
    asked = C.staged(own.groupBy(*key).agg(F.min("id").alias("qid"), F.count("*").alias("n")), "asked")
    picked = cands.orderBy(F.xxhash64("gid", "label"), "gid").limit(SAMPLE).select("vec", "label").collect()  # a bounded sample
    if not picked or asked.isEmpty():
        return empty
    # one anchor vector may stand under several labels: qid tells them apart
    asked = C.staged(asked.withColumn("qid", F.monotonically_increasing_id()), "numbered")
    sample, label = np.array([r["vec"] for r in picked]), np.array([r["label"] for r in picked])
    axes = np.argsort(-sample.var(0), kind="stable")[:SLAB_AXES].tolist()
    cuts = [np.quantile(sample[:, a], np.arange(1, SLABS) / SLABS) for a in axes]
    tiled = cands.mapInPandas(_tiled(C.broadcast(spark, (axes, cuts))), "gid long, label long, vec array<double>, ids array<long>, part int")
    tiled = C.staged(tiled, "tiles")
    dim = sample.shape[1]
    ranges = [f(F.col("vec")[i]) for f in (F.min, F.max) for i in range(dim)]
    found = tiled.groupBy("part").agg(*ranges).collect()  # a row for each of the SLABS ** SLAB_AXES tiles
    boxes = {
        "part": np.array([r[0] for r in found], np.int32),
        "low": np.array([r[1 : 1 + dim] for r in found]),
        "high": np.array([r[1 + dim :] for r in found]),
    }
    held = C.broadcast(spark, (sample, label, boxes))
    asked_type = "qid long, label long, vec array<double>"
    sent = asked.select("qid", "label", "vec").mapInPandas(_sent_positives(held, positives), f"{asked_type}, part int, floor double")
    near = V.grid(tiled, C.staged(sent, "sent"), _find_positives(positives), "long", SLABS**SLAB_AXES)
    near = C.staged(_first(near, ["qid"], positives + 1, "place").drop("place"), "positives")
    # each anchor row's own positives: the first that are not itself
    counted = asked.select(*key, "qid", "n")
    mine = C.attach(own.select(F.col("id").alias("anchor_id"), *key), counted, key, "n", by=["anchor_id"]).select("anchor_id", "qid")
    top = near.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct(F.negative("score").alias("minus"), "id"))).alias("top"))  # k + 1 at most
    pairs = mine.join(top, "qid").withColumn("top", F.slice(F.filter("top", lambda t: t["id"] != F.col("anchor_id")), 1, positives))
    pairs = pairs.select("qid", "anchor_id", F.explode("top").alias("p"))
    pairs = C.staged(pairs.select("qid", "anchor_id", F.col("p.id").alias("positive_id"), F.negative("p.minus").alias("positive_score")), "pairs")
    window = F.struct(
        F.col("positive_score").alias("score"),
        F.ceil(F.col("positive_score") * low / 100).cast("double").alias("low"),
        F.floor(F.col("positive_score") * high / 100).cast("double").alias("high"),
    )
    windows = pairs.select("qid", window.alias("w")).distinct().filter("w.low <= w.high").groupBy("qid").agg(F.collect_list("w").alias("windows"))
    queries = asked.select("qid", "label", "vec").join(windows, "qid")
    kind = "windows array<struct<score: long, low: double, high: double>>"
    sent = queries.select("qid", "label", "vec", "windows").mapInPandas(_sent_negatives(held), f"{asked_type}, {kind}, part int")
    hard = V.grid(
        tiled, C.staged(sent, "asked"), _find_negatives(negatives), "long", SLABS**SLAB_AXES, "qid long, positive_score long, id long, score long"
    )
    hard = _first(hard, ["qid", "positive_score"], negatives, "rank")
    return pairs.join(hard, ["qid", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
