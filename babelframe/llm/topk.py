"""Exact top-k by inner product with pivot-table elimination.

Vectors are quantised to integers, floor(SCALE * x). Distances to pivots are
computed once for queries and candidates. By the triangle inequality
|d(q, p) - d(c, p)| is a lower bound of d(q, c) for every pivot p; the largest
of them bounds the inner product from above:

    <q, c> = (|q|^2 + |c|^2 - d(q, c)^2) / 2.

Every query first gets a floor: its k-th best score in a bounded sample of
candidates. Candidates lie in cells (their nearest pivot). A query is sent
only to cells whose distance ranges let them reach its floor; in a cell it
evaluates candidates in the order of their bounds and stops when the next
bound is below its k-th best score. Elimination uses proven bounds only, so
the result is exact.

Vectors without structure (random directions) are all about equally far from
every pivot, and the bounds eliminate next to nothing: the search is then a
scan of all candidates for each query, in blocks.

Edge cases: NULL vectors and those with NULL or non-finite components take
no part, nor do vectors whose length is not the most frequent one; copies and
repeated rows of an id are one candidate per id; ties go to the smaller id;
fewer than k candidates give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C
from babelframe.llm import vectors as V

K, SCALE, PIVOTS, SAMPLE = 20, 64, 24, 2048
STEP = 256  # candidates evaluated at a time
SLACK = 1e-3  # on squared distances; scores are whole numbers


def far_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Pivots far from each other: each the farthest from those before."""
    near = ((sample - sample.mean(0)) ** 2).sum(1)
    picked = []
    for _ in range(min(n, len(sample))):
        picked.append(int(near.argmax()))
        d = ((sample - sample[picked[-1]]) ** 2).sum(1)
        near = d if len(picked) == 1 else np.minimum(near, d)
    return sample[picked]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances; integers below 2**53 make the squares exact."""
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (x @ pivots.T), 0))


def _table(held):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots = held.value
        for f in frames:
            if len(f):
                d = distances(V.matrix(f["vec"]), pivots)
                yield f.assign(part=d.argmin(1).astype(np.int32), far=list(d))

    return run


def _routed(held, k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, sample, cells = held.value
        low, high = np.array([c[1] for c in cells]), np.array([c[2] for c in cells])
        norm = np.array([c[3] for c in cells])
        for f in frames:
            if not len(f):
                continue
            x = V.matrix(f["vec"])
            d = distances(x, pivots)
            scores = x @ sample.T
            floor = np.partition(scores, -k - 1, 1)[:, -k - 1] if len(sample) > k else np.full(len(x), -np.inf)
            gap = np.maximum(np.maximum(low[None] - d[:, None], d[:, None] - high[None]), 0).max(2)
            bound = ((x * x).sum(1)[:, None] + norm[None] - gap**2 + SLACK) / 2
            q, c = np.nonzero(bound >= floor[:, None])
            yield pd.DataFrame(
                {
                    "part": np.array([c[0] for c in cells], np.int32)[c],
                    "qid": f["qid"].to_numpy()[q],
                    "vec": f["vec"].to_numpy()[q],
                    "far": [d[i] for i in q],
                    "floor": floor[q],
                }
            )

    return run


def _search(k: int):
    def work(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        x, y = V.matrix(q["vec"]), V.matrix(c["vec"])
        dx, dy = V.matrix(q["far"]), V.matrix(c["far"])
        nx, ny = (x * x).sum(1), (y * y).sum(1)
        ids = c["ids"].to_numpy()
        out: tuple[list, list, list] = ([], [], [])
        for i in range(len(x)):
            gap = np.abs(dy - dx[i]).max(1)
            bound = (nx[i] + ny - gap**2 + SLACK) / 2
            floor = q["floor"].iat[i]
            order = np.flatnonzero(bound >= floor)
            order = order[np.argsort(-bound[order], kind="stable")]
            scores = np.full(len(y), -np.inf)
            done = 0
            while done < len(order) and bound[order[done]] >= floor:
                step = order[done : done + STEP]
                scores[step] = y[step] @ x[i]
                done += len(step)
                if done > k:
                    floor = max(floor, np.partition(scores[order[:done]], -k - 1)[-k - 1])
            picked = np.flatnonzero(scores >= floor) if done else order
            for to, values in zip(out, V.expand(q["qid"].iat[i], scores, picked[np.isfinite(scores[picked])], ids, k), strict=True):
                to.extend(values)
        return pd.DataFrame(dict(zip(("qid", "id", "score"), out, strict=True))).astype({"qid": "int64", "id": "int64", "score": "int64"})

    return work


def top_k(
    df: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (a subset
    of ``df``'s rows) the k other rows with the largest inner products."""
    spark = df.sparkSession

    def whole(x):
        return F.floor(x * F.lit(float(scale))).cast("double")

    usable = C.staged(V.clean(df, id_col, vector_col, whole), "usable")
    length = F.size("vec") == V.common_length(usable)
    cands = C.staged(V.candidates(usable.filter(length), k), "candidates")
    rows = C.staged(V.clean(queries, id_col, vector_col, whole).filter(length), "queries")
    asked = C.staged(V.distinct_queries(rows), "asked")
    picked = cands.orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE).select("vec").collect()  # a bounded sample for pivots and floors
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = np.array([r["vec"] for r in picked])
    pivots = far_pivots(sample, PIVOTS)
    held = C.broadcast(spark, pivots)
    table = C.staged(cands.mapInPandas(_table(held), "gid long, vec array<double>, ids array<long>, part int, far array<double>"), "table")
    squares = F.aggregate(F.transform("vec", lambda v: v * v), F.lit(0.0), lambda a, v: a + v)
    ranges = [f(F.col("far")[i]) for f in (F.min, F.max) for i in range(len(pivots))]
    cells = [
        (r[0], np.array(r[1 : 1 + len(pivots)]), np.array(r[1 + len(pivots) : -1]), r[-1])
        for r in table.groupBy("part").agg(*ranges, F.max(squares)).collect()  # a row for each pivot
    ]
    routed = asked.mapInPandas(
        _routed(C.broadcast(spark, (pivots, sample, cells)), k), "part int, qid long, vec array<double>, far array<double>, floor double"
    )
    found = V.grid(table, C.staged(routed, "routed"), _search(k), "long", len(pivots))
    return V.best(found, rows, asked, k)
