"""Approximate nearest neighbours by cosine over learned partitions.

1. The neighbour graph of a bounded sample of vectors is cut into balanced
   partitions by recursive bisection: a spectral order split in the middle,
   then refined by swapping the nodes that cut most edges.
2. A small classifier (one hidden layer, numpy) learns the partitions; its
   targets are the shares of partitions among a node's neighbours.
3. Every distinct vector is stored in its most probable partition. A query is
   sent to its most probable partitions and ranked there by exact cosine in
   double precision.

The number of partitions grows with the rows. How many are probed is
measured: a share of the sample is held back from the training, and the
fewest partitions are taken that hold AIM of its true neighbours. Vectors in
clusters need few; vectors without structure need most, whatever the index.
A query whose partitions hold fewer than k other rows is sent to the
remaining ones as well.

The sample (SAMPLE distinct vectors by a hash of their id) only shapes the
index; every row is indexed and can be found.

Edge cases: vectors that are NULL, zero, or hold NULL or non-finite
components take no part, nor do vectors whose length is not the most frequent
one; copies and repeated rows of an id are one candidate per id; ties go to
the smaller id; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C
from babelframe.llm import vectors as V

K, SAMPLE, DEGREE, HIDDEN = 5, 4000, 24, 128
#: Partitions, at least and at most (a partition needs some nodes of the
#: sample); distinct vectors of a partition, about.
LEAST_PARTS, MOST_PARTS, PART_ROWS = 16, 128, 8192
#: Share of the true neighbours of held-back vectors that the probes hold.
AIM, HELD_BACK = 0.96, 0.25


def neighbour_graph(x: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Symmetric 0/1 adjacency of the nearest neighbours by cosine."""
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    graph = np.zeros(near.shape, np.float32)
    k = min(degree, len(x) - 1)
    if k:
        graph[np.arange(len(x))[:, None], np.argpartition(-near, k - 1, 1)[:, :k]] = 1
    return np.maximum(graph, graph.T)


def bisect(graph: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two halves of a graph (sizes differ by one at most)."""
    n = len(graph)
    weight = graph.sum(1) + 1e-9
    x = rng.normal(size=n)
    for _ in range(60):
        x = x - (x * weight).sum() / weight.sum()
        x = 0.5 * (x + graph @ x / weight)
        x /= np.linalg.norm(x) + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2 :]] = True
    cut = graph[side][:, ~side].sum()
    for _ in range(20):
        gain = np.where(side, graph @ ~side - graph @ side, graph @ side - graph @ ~side)
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        m = int((gain[a[:m]] + gain[b[:m]] > 0).sum()) // 2
        if not m:
            break
        new = side.copy()
        new[a[:m]], new[b[:m]] = False, True
        if (now := graph[new][:, ~new].sum()) >= cut:
            break
        side, cut = new, now
    return side


def partition(graph: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """Balanced partition of a graph into ``parts`` (a power of two)."""
    rng = np.random.default_rng(seed)
    label = np.zeros(len(graph), np.int64)
    size = 1
    while size < parts:
        for p in range(size):
            nodes = np.flatnonzero(label == p)
            if len(nodes) > 1:
                label[nodes[bisect(graph[np.ix_(nodes, nodes)], rng)]] = p + size
        size *= 2
    return label


def train(x: np.ndarray, target: np.ndarray, seed: int = 4, epochs: int = 10, batch: int = 128) -> list[np.ndarray]:
    """A classifier with one hidden layer, by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    net = [
        rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, target.shape[1])),
        np.zeros(target.shape[1]),
    ]
    m, v, t = [0.0] * 4, [0.0] * 4, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            pick = order[i : i + batch]
            h = np.maximum(x[pick] @ net[0] + net[1], 0)
            z = h @ net[2] + net[3]
            p = np.exp(z - z.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - target[pick]) / len(pick)
            dh = (d @ net[2].T) * (h > 0)
            t += 1
            for j, g in enumerate((x[pick].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                net[j] = net[j] - 0.003 * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
    return net


def likely(net: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Partitions of each row, the most probable first."""
    return np.argsort(-(np.maximum(x @ net[0] + net[1], 0) @ net[2] + net[3]), axis=1, kind="stable")


def parts_for(rows: int) -> int:
    """A power of two that grows with the rows."""
    return int(min(MOST_PARTS, max(LEAST_PARTS, 2 ** np.ceil(np.log2(max(rows, 1) / PART_ROWS)))))


def probes_for(net: list[np.ndarray], sample: np.ndarray, held: int, k: int = K, aim: float = AIM) -> int:
    """The fewest partitions that hold ``aim`` of the k nearest of the last
    ``held`` vectors of the sample."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    order = likely(net, x)
    near = x[len(x) - held :] @ x.T
    near[np.arange(held), np.arange(len(x) - held, len(x))] = -np.inf
    k = min(k, len(x) - 1)
    if not held or not k:
        return order.shape[1]
    best = np.argpartition(-near, k - 1, 1)[:, :k]
    place = np.argsort(order[len(x) - held :], axis=1)  # of each partition in the vector's order
    found = np.sort(place[np.arange(held)[:, None], order[best, 0]].ravel())
    return int(found[min(len(found) - 1, int(np.ceil(aim * len(found))) - 1)]) + 1


def learn(sample: np.ndarray, parts: int = LEAST_PARTS) -> list[np.ndarray]:
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    graph = neighbour_graph(x)
    label = partition(graph, parts)
    one = np.eye(parts)[label]
    target = (graph + np.eye(len(x), dtype=np.float32)) @ one
    return train(x, target / target.sum(1, keepdims=True))


def _unit(f: pd.DataFrame) -> np.ndarray:
    x = V.matrix(f["vec"])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _stored(held):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f.assign(part=likely(held.value, _unit(f))[:, 0].astype(np.int32))

    return run


def _sent(held, low: int, high: int):
    """Queries to their ``low``-th to ``high``-th most probable partitions."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                parts = likely(held.value, _unit(f))[:, low:high]
                row = np.repeat(np.arange(len(f)), parts.shape[1])
                yield f.iloc[row].assign(part=parts.ravel().astype(np.int32))

    return run


def _search(k: int):
    def work(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        x, y = V.matrix(q["vec"]), V.matrix(c["vec"])
        nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
        ids = c["ids"].to_numpy()
        out: tuple[list, list, list] = ([], [], [])
        for i in range(0, len(x), 256):
            rough = (x[i : i + 256] @ y.T) / nx[i : i + 256, None] / ny
            last = np.partition(rough, -k - 1, 1)[:, -k - 1] if len(y) > k else np.full(len(rough), -np.inf)
            for j, (line, least) in enumerate(zip(rough, last, strict=True), i):
                # rounding in the matrix product must not decide: exact sums, one order, for all that are near
                picked = np.flatnonzero(line >= least - 1e-9)
                scores = np.full(len(y), -np.inf)
                scores[picked] = (y[picked] * x[j]).sum(1) / (nx[j] * ny[picked])
                for to, values in zip(out, V.expand(q["qid"].iat[j], scores, picked, ids, k), strict=True):
                    to.extend(values)
        return pd.DataFrame(dict(zip(("qid", "id", "score"), out, strict=True))).astype({"qid": "int64", "id": "int64", "score": "float64"})

    return work


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int | None = None,
    probes: int | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (a subset
    of ``df``'s rows) the k nearest other rows found. ``parts``, ``probes``:
    instead of the numbers that follow from the rows and the sample."""
    spark = df.sparkSession
    some = F.exists("vec", lambda x: x != 0.0)
    usable = C.staged(V.clean(df, id_col, vector_col).filter(some), "usable")
    length = F.size("vec") == V.common_length(usable)
    cands = C.staged(V.candidates(usable.filter(length), k), "candidates")
    rows = C.staged(V.clean(queries, id_col, vector_col).filter(some).filter(length), "queries")
    asked = C.staged(V.distinct_queries(rows), "asked")
    picked = cands.orderBy(F.xxhash64("gid"), "gid").limit(sample).select("vec").collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = parts or parts_for(cands.count())
    vectors = np.array([r["vec"] for r in picked])
    held_back = int(HELD_BACK * len(vectors))
    net = learn(vectors[: len(vectors) - held_back], parts)
    probes = probes or probes_for(net, vectors, held_back, k)
    held = C.broadcast(spark, net)
    index = C.staged(cands.mapInPandas(_stored(held), "gid long, vec array<double>, ids array<long>, part int"), "index")
    sent_type = "qid long, vec array<double>, part int"
    sent = C.staged(asked.mapInPandas(_sent(held, 0, probes), sent_type), "sent")
    found = C.staged(V.grid(index, sent, _search(k), "double", parts), "found")
    if probes < parts:
        enough = found.groupBy("qid").count().filter(F.col("count") > k).select("qid")
        short = C.staged(asked.join(enough, "qid", "left_anti"), "short")
        if not short.isEmpty():
            rest = C.staged(short.mapInPandas(_sent(held, probes, parts), sent_type), "rest")
            found = found.unionByName(V.grid(index, rest, _search(k), "double", parts))
    return V.best(found, rows, asked, k)
