"""Shared parts of the vector searches: clean vectors, copies as one
candidate, and a grid of bounded blocks.

Equal vectors are one candidate that carries its ``k + 1`` smallest ids (a
query needs at most k of them besides itself), and equal query vectors are
searched once, so a vector that a third of all rows holds costs one row.

Queries meet candidates in a grid: the candidates of a part are dealt over
column blocks, its queries over row blocks, and each cell of the grid is one
group of bounded size on both sides. No group holds a whole part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Candidates and queries in one cell of the grid, about.
BLOCK, QUERIES = 8192, 1024


def clean(df: DataFrame, id_col: str, vector_col: str, value: Callable[[Column], Column] = lambda x: x) -> DataFrame:
    """(id, vec): vectors as doubles; those that are NULL, empty or hold NULL
    or non-finite components, and rows without id, are left out."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    out = out.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).filter(~bad)
    # + 0.0 makes -0.0 equal to 0.0
    return out.select("id", F.transform("vec", lambda x: value(x) + F.lit(0.0)).alias("vec"))


def common_length(rows: DataFrame, column: str = "vec") -> int:
    """The most frequent length of the vectors (the smaller one at a tie; 0
    if there are none). Vectors of other lengths have no products with them."""
    top = rows.groupBy(F.size(column).alias("size")).count().orderBy(F.desc("count"), "size").first()
    return top["size"] if top else 0


def candidates(rows: DataFrame, k: int) -> DataFrame:
    """(gid, vec, ids): distinct vectors with their k + 1 smallest ids."""
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.groupBy("vec", "id").agg(F.lit(1)).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k + 1)
    return few.groupBy("vec").agg(F.min("id").alias("gid"), F.sort_array(F.collect_list("id")).alias("ids")).select("gid", "vec", "ids")


def distinct_queries(rows: DataFrame) -> DataFrame:
    return rows.groupBy("vec").agg(F.min("id").alias("qid")).select("qid", "vec")


def grid(
    cands: DataFrame,
    queries: DataFrame,
    work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    score: str,
    parts: int,
    schema: str = "",
) -> DataFrame:
    """``work(queries, candidates)`` on every cell. ``cands`` (part, gid, vec,
    ids, ...), ``queries`` (part, qid, vec, ...); result (qid, id, score), or
    what ``schema`` names."""
    schema = schema or f"qid long, id long, score {score}"
    spark = cands.sparkSession
    n = cands.groupBy("part").count().collect()  # a row for each part
    m = {r["part"]: r["count"] for r in queries.groupBy("part").count().collect()}
    assert len(n) <= parts
    shape = spark.createDataFrame(
        [(r["part"], -(-r["count"] // BLOCK), -(-m[r["part"]] // QUERIES)) for r in n if r["part"] in m], "part int, columns long, lines long"
    )
    c = (
        cands.join(F.broadcast(shape), "part")
        .withColumn("column", F.pmod(F.xxhash64("gid"), "columns"))
        .withColumn("line", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lines") - 1)))
        .drop("columns", "lines")
    )
    q = (
        queries.join(F.broadcast(shape), "part")
        .withColumn("line", F.pmod(F.xxhash64("qid"), "lines"))
        .withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)))
        .drop("columns", "lines")
    )
    keys = ["part", "line", "column"]

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({n.split()[0]: [] for n in schema.split(", ")})
        return work(q, c)

    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(cell, schema)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def expand(qid: int, scores: np.ndarray, picked: np.ndarray, ids: np.ndarray, k: int) -> tuple[list, list, list]:
    """The best k + 1 rows of the picked candidates of one query."""
    order = picked[np.lexsort((np.array([ids[i][0] for i in picked]), -scores[picked]))][: k + 1]
    rows = sorted((-scores[i], int(x)) for i in order for x in ids[i])[: k + 1]
    return [qid] * len(rows), [x for _, x in rows], [-s for s, _ in rows]


def best(found: DataFrame, rows: DataFrame, distinct: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row, from the rows found
    for its vector."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    top = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    top = top.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("top"))
    asked = rows.select("id", "vec").distinct().join(distinct, "vec").select(F.col("id").alias("query_id"), "qid")
    own = asked.join(top, "qid").withColumn("top", F.slice(F.filter("top", lambda x: x["id"] != F.col("query_id")), 1, k))
    return own.select("query_id", F.posexplode("top").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )
