"""Near-duplicate vectors by a subspace pigeonhole join.

Two vectors of one label are linked if their cosine is ``least`` or more.
For unit vectors that is a squared distance of at most 2 - 2 * least, the
budget. Unit vectors are rotated into the principal directions of a bounded
sample (distances stay as they are), and the directions are dealt into blocks
of few dimensions. Each block gets a part of the budget in proportion to its
share of the variance; as the parts sum to the budget, two linked vectors
are within the part of at least one block.

Range join of a block: a tree of splitting planes, fitted on the sample, cuts
the block into leaves. A vector is owned by one leaf, and is a guest in every
leaf whose owners it could reach within the block's radius. Two vectors in
reach meet in exactly one leaf, and never as two guests. A leaf is worked on
in cells of bounded size (owners in columns, all members in lines).

In a cell, the pairs within the block's part are candidates; of those, a
pair that an earlier block finds as well is left to that block, so the union
of candidates needs no pairs to be written. The rest is verified by the exact
cosine of the original vectors. A cell returns a row a vector (the number of
its links, and the smallest vector of its group in the cell), never a pair:
groups of copies grow by rows. Equal vectors of a label are one node, with
the number of their ids, before anything is compared.

The sample only shapes rotation and planes; results do not depend on it.

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite
components, rows without label and rows without vec_id link with nothing (a
row without vec_id has no component and is kept). Vectors whose length is not
the most frequent one link with nothing. Repeated rows of an id and a vector
are one vector and get equal results; different vectors under one id are
vectors each. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from babelframe.llm import common as C
from babelframe.llm import vectors as V
from babelframe.llm.minhash import components

LEAST = 0.98
#: Dimensions of a block; rows of the sample; owners of a leaf, about.
BLOCK_DIMS, SAMPLE, LEAF = 8, 4096, 2048
#: Levels of planes that a sample of this size supports; leaves that stay
#: crowded are worked on in cells.
MAX_DEPTH = 9
#: Owners and members of a cell. Leaves are smaller, but for crowded ones.
COLUMN, LINE = 4096, 16384
#: On squared distances of unit vectors; only ever adds candidates.
SLACK = 1e-9


def turned(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Rows of ``x`` as unit vectors in the rotated axes. Without BLAS: a
    row's coordinates must not depend on the rows beside it."""
    unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return np.einsum("ij,kj->ik", unit, rotation)


class Model:
    """Rotation, blocks with their budgets, and each block's tree of planes."""

    def __init__(self, sample: np.ndarray, least: float, depth: int, dims: int = BLOCK_DIMS):
        dim = sample.shape[1]
        unit = sample / np.sqrt((sample * sample).sum(1))[:, None]
        variance, axes = np.linalg.eigh(unit.T @ unit / len(unit))
        n = max(1, dim // dims)
        # dealt to and fro by falling variance, so that blocks are alike
        turn = np.concatenate([np.arange(n), np.arange(n)[::-1]])
        block = turn[np.arange(dim) % (2 * n)]
        order = np.lexsort((np.arange(dim), block))
        self.rotation = np.ascontiguousarray(axes.T[::-1][order])
        held, sizes = np.maximum(variance[::-1][order], 0) + 1e-12, np.bincount(block)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        share = np.array([held[a:b].sum() for a, b in zip(self.starts, self.ends, strict=True)]) / held.sum()
        self.budget = (2 - 2 * least) * share + SLACK
        self.least, self.depth = least, depth
        x = turned(sample, self.rotation)
        self.axis = np.zeros((n, 1 << depth), np.int64)
        self.plane = np.zeros((n, 1 << depth))
        for b in range(n):
            self._split(b, 1, x)

    def _split(self, block: int, node: int, x: np.ndarray) -> None:
        """Planes of the subtree: the median of the widest coordinate."""
        if node >= len(self.plane[block]):
            return
        a, b = self.starts[block], self.ends[block]
        axis = a + int(np.argmax(x[:, a:b].var(0))) if len(x) else a
        self.axis[block, node] = axis
        self.plane[block, node] = cut = float(np.median(x[:, axis])) if len(x) else 0.0
        left = x[:, axis] <= cut
        self._split(block, 2 * node, x[left])
        self._split(block, 2 * node + 1, x[~left])

    def leaves(self, block: int, x: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, owned) of the rotated rows ``x``, each descending
        ``depth`` levels: to its own side, and as a guest to the right of a
        plane within its radius. Guests go wherever owners in reach may be."""
        radius = np.sqrt(self.budget[block])
        row, node, owned = np.arange(len(x)), np.ones(len(x), np.int64), np.ones(len(x), bool)
        done = []
        for level in range(self.depth + 1):
            ends = depth[row] == level
            done.append((row[ends], node[ends], owned[ends]))
            row, node, owned = row[~ends], node[~ends], owned[~ends]
            if not len(row):
                break
            d = x[row, self.axis[block, node]] - self.plane[block, node]
            left = np.where(owned, d <= 0, d <= radius)
            right = d > -radius
            own_right = owned & (d > 0)
            row, node, owned = (
                np.concatenate([row[left], row[right]]),
                np.concatenate([2 * node[left], 2 * node[right] + 1]),
                np.concatenate([owned[left], own_right[right]]),
            )
        return tuple(np.concatenate(z) for z in zip(*done, strict=True))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vec = b.column(b.schema.get_field_index("vec"))
        flat, ends = vec.flatten().to_numpy().astype(np.float64), vec.offsets.to_numpy().tolist()
        first = ends[0]
        marks = [hashlib.blake2b(flat[i - first : j - first].tobytes(), digest_size=16).digest() for i, j in zip(ends, ends[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(marks, pa.binary())], names=[*b.schema.names, "digest"])


def _routed(held):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, depths = held.value
        for f in frames:
            for at in range(0, len(f), 4096):
                part = f.iloc[at : at + 4096]
                x = turned(V.matrix(part["vec"]), model.rotation)
                depth = part["label"].map(depths).fillna(0).to_numpy().astype(np.int64)
                for block in range(len(model.starts)):
                    row, leaf, owned = model.leaves(block, x, depth)
                    yield part.iloc[row].assign(block=np.int32(block), leaf=leaf, owned=owned)

    return run


def group_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def _cell(held):
    def work(owners: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        model = held.value[0]
        if not len(owners) or not len(members):
            return pd.DataFrame({"gid": [], "links": [], "root": []}).astype("int64")
        block = int(owners["block"].iat[0])
        x, y = V.matrix(owners["vec"]), V.matrix(members["vec"])
        tx, ty = turned(x, model.rotation), turned(y, model.rotation)
        a, b = model.starts[block], model.ends[block]
        bx, by = tx[:, a:b], ty[:, a:b]
        gx, gy = owners["gid"].to_numpy(), members["gid"].to_numpy()
        squares = (by * by).sum(1)
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at in range(0, len(x), 512):
            some = bx[at : at + 512]
            near = (some * some).sum(1)[:, None] + squares - 2 * (some @ by.T)
            i, j = np.nonzero(near <= model.budget[block] + SLACK)
            i += at
            keep = gx[i] != gy[j]
            i, j = i[keep], j[keep]
            for k in range(0, len(i), 65536):  # many candidates, where copies crowd
                p, q = i[k : k + 65536], j[k : k + 65536]
                spread = np.add.reduceat((tx[p] - ty[q]) ** 2, model.starts, axis=1) <= model.budget
                first = spread[:, block] & ~spread[:, :block].any(1)
                p, q = p[first], q[first]
                linked = _cosines(x[p], y[q]) >= model.least
                pairs.append((p[linked], q[linked]))
        i, j = (np.concatenate(z) for z in zip(*pairs, strict=True))
        mx, my = owners["copies"].to_numpy(), members["copies"].to_numpy()
        guest = ~members["owned"].to_numpy()
        gids, place = np.unique(np.concatenate([gx, gy]), return_inverse=True)
        pi, pj = place[:len(gx)][i], place[len(gx) :][j]
        # owners see each other twice, once from either side; a guest is seen by owners only
        links = np.bincount(pi, weights=my[j], minlength=len(gids))
        links += np.bincount(pj[guest[j]], weights=mx[i][guest[j]], minlength=len(gids))
        some = np.flatnonzero(links)
        root = group_roots(pi, pj, len(gids))
        return pd.DataFrame({"gid": gids[some], "links": links[some].astype(np.int64), "root": gids[root[some]]})

    return work


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST,
    block_dims: int = BLOCK_DIMS,
    leaf: int = LEAF,
) -> DataFrame:
    """One row per row of ``df``: (vec_id, n_links, component_id, kept)."""
    spark = df.sparkSession
    kind = df.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    number = "float" if single else "double"
    base = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(f"array<{number}>").alias("vec")
    )
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    valid = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda v: v != 0.0)
    base = C.staged(base.withColumn("valid", F.coalesce(valid, F.lit(False))), "vectors")
    own = F.col("valid") & (F.size("vec") == V.common_length(base.filter("valid"), "vec"))
    alone = base.filter(~own).select(
        F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
    )
    # + 0.0 makes -0.0 equal to 0.0
    rows = base.filter(own).select("id", "label", F.transform("vec", lambda v: v + F.lit(0.0).cast(number)).alias("vec"))
    rows = C.staged(rows.mapInArrow(_digests, f"id long, label {dict(rows.dtypes)['label']}, vec array<{number}>, digest binary"), "rows")
    key = ["label", "digest"]
    # every step combines within tasks first: a vector that crowds costs a row a task
    nodes = rows.dropDuplicates(["id", *key]).groupBy(*key).agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    nodes = C.staged(nodes.withColumn("gid", F.monotonically_increasing_id()), "nodes")
    sample = nodes.orderBy(F.xxhash64("digest"), "gid").limit(SAMPLE).select("vec").collect()
    if not sample:
        return alone
    vectors = nodes.select("gid", "label", "copies", "vec")
    sizes = vectors.groupBy("label").count().filter(F.col("count") > leaf).collect()  # at most rows / leaf labels
    depths = {r["label"]: min(MAX_DEPTH, int(np.ceil(np.log2(r["count"] / leaf)))) for r in sizes}
    model = Model(np.array([r["vec"] for r in sample], np.float64), least, max(depths.values(), default=0), block_dims)
    held = C.broadcast(spark, (model, depths))
    kinds = ", ".join(f"{n} {t}" for n, t in vectors.dtypes)
    routed = C.staged(vectors.mapInPandas(_routed(held), f"{kinds}, block int, leaf long, owned boolean"), "routed")
    found = C.staged(_joined(routed, held), "found")
    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    labels = components(found.filter("root <> gid").select(F.col("gid").alias("a"), F.col("root").alias("b")))
    grouped = labels.select(F.col("id").alias("gid"), F.col("label").alias("root")).join(nodes.select("gid", "first"), "gid")
    grouped = C.staged(grouped, "grouped")
    lowest = grouped.groupBy("root").agg(F.min("first").alias("component"), F.count("*").alias("n"))
    groups = C.attach(grouped, lowest, ["root"], "n", by=["gid"]).select("gid", "component")
    told = nodes.select("gid", *key, "first", "copies").join(links, "gid", "left").join(groups, "gid", "left")
    told = told.select(
        *key,
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "first").alias("component_id"),
    )
    counted = C.staged(told.join(rows.groupBy(*key).agg(F.count("*").alias("n")), key), "told")
    each = C.attach(rows.select("id", *key).withColumn("at", F.monotonically_increasing_id()), counted, key, "n", by=["at"])
    each = each.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
    return each.unionByName(alone)


def _joined(routed: DataFrame, held) -> DataFrame:
    """``_cell`` on every cell of every leaf; only crowded leaves have more
    than one cell."""
    key = ["label", "block", "leaf"]
    sizes = routed.groupBy(*key).agg(F.count_if("owned").alias("owners"), F.count("*").alias("members"))
    crowded = sizes.filter(f"owners > {COLUMN} OR members > {LINE}").select(  # at most members / COLUMN rows
        *key, F.ceil(F.col("owners") / COLUMN).alias("columns"), F.ceil(F.col("members") / LINE).alias("lines")
    )
    dealt = routed.join(F.broadcast(crowded), key, "left").fillna(1, ["columns", "lines"])

    def spread(name: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(name), F.lit(1)) - 1))

    owners = dealt.filter("owned").withColumn("column", F.pmod(F.xxhash64("gid"), "columns")).withColumn("line", spread("lines"))
    members = dealt.withColumn("line", F.pmod(F.xxhash64("gid"), "lines")).withColumn("column", spread("columns"))
    cell = [*key, "column", "line"]
    names = [c for c in owners.columns if c not in ("columns", "lines")]
    return (
        owners.select(*names)
        .groupBy(*cell)
        .cogroup(members.select(*names).toDF(*names).groupBy(*cell))  # toDF: columns of their own, not those of owners
        .applyInPandas(_cell(held), "gid long, links long, root long")
    )
