"""Near-duplicate vectors, importance resampling and hard negatives against
brute force, and on hard rows: NULLs, zeros, odd lengths, copies, ties,
repeated rows, empty tables, extra columns with clashing names."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from babelframe.llm import common, negatives, resample, subspaces
from babelframe.llm import queries as Q

SCHEMA = "vec_id long, label int, embedding array<float>, vec string, gid int, id int, part int, block int, rank int"
DIM = 16


def vector_rows() -> list[tuple[int | None, int | None, list | None]]:
    rng = np.random.default_rng(5)
    rows: list = []
    centres = rng.normal(size=(30, DIM))
    for i in range(300):
        c = centres[i % 30]
        near = 0.1 if i % 3 else 1.2  # groups of copies, and rows without any
        rows.append((i, int(i % 30) % 3, (c + near * rng.normal(size=DIM) * np.linalg.norm(c) / DIM**0.5 * 0.9).astype(np.float32).tolist()))
    rows += [(400 + i, 1, rows[3][2]) for i in range(40)]  # one vector that crowds
    rows += [(450, 2, rows[3][2]), (451, 1, [2 * x for x in rows[3][2]])]  # under another label; another length
    rows += [rows[7], rows[7]]  # repeated rows
    rows += [
        (500, 1, None),
        (501, None, rows[3][2]),
        (502, 1, [0.0] * DIM),
        (503, 1, []),
        (504, 1, [float("nan")] * DIM),
        (505, 1, [None, *rows[3][2][1:]]),
        (506, 1, [float("inf"), *rows[3][2][1:]]),
        (507, 1, rows[3][2][:5]),  # too short
        (None, 1, rows[3][2]),
        (508, 1, [-0.0, *rows[3][2][1:]]),
        (509, 1, [0.0, *rows[3][2][1:]]),
    ]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(5)


def usable(rows, zero: bool):
    out = {}
    for i, label, v in rows:
        if i is None or label is None or not v or len(v) != DIM or any(x is None or not math.isfinite(x) for x in v):
            continue
        if zero or any(v):
            out[i, label, tuple(float(x) for x in v)] = None
    return list(out)


def brute_links(rows, least):
    nodes = usable(rows, zero=False)
    x = np.array([v for _, _, v in nodes])
    norm = np.sqrt((x * x).sum(1))
    root = list(range(len(nodes)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    links = [0] * len(nodes)
    for a, b in itertools.combinations(range(len(nodes)), 2):
        if nodes[a][1] == nodes[b][1] and (x[a] * x[b]).sum() / (norm[a] * norm[b]) >= least:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    low: dict[int, int] = {}
    for a in range(len(nodes)):
        low[find(a)] = min(low.get(find(a), 1 << 60), nodes[a][0])
    return {n[0]: (links[a], low[find(a)]) for a, n in enumerate(nodes)}


@pytest.mark.parametrize("shape", ["whole", "leaves", "cells"])
def test_near_vectors_equal_brute_force(spark, monkeypatch, shape):
    """Also where a label fills many leaves, and a leaf many cells."""
    rows = vector_rows()
    if shape == "cells":
        monkeypatch.setattr(subspaces, "COLUMN", 16)
        monkeypatch.setattr(subspaces, "LINE", 24)
    got = subspaces.near_vectors(table(spark, rows), block_dims=4, leaf={"whole": 2048, "leaves": 8, "cells": 64}[shape]).collect()
    want = brute_links(rows, subspaces.LEAST)
    assert len(got) == len(rows)
    for r in got:
        links, component = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"], r["kept"]) == (links, component, r["vec_id"] == component)
    assert max(n for n, _ in want.values()) > 40


def test_leaves_meet_once():
    """Every pair within the radius meets in one leaf, once, and not as two guests."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 8))
    model = subspaces.Model(x, 0.9, 5, 4)
    t = subspaces.turned(x, model.rotation)
    assert np.isclose(model.budget.sum(), 0.2, atol=1e-6)
    for block in range(2):
        row, leaf, owned = model.leaves(block, t, np.full(400, 5))
        assert sorted(row[owned].tolist()) == list(range(400))
        met: dict = {}
        for at in np.unique(leaf):
            here = [(r, o) for r, o, lf in zip(row, owned, leaf, strict=True) if lf == at]
            for (a, oa), (b, ob) in itertools.combinations(here, 2):
                if oa or ob:
                    met[min(a, b), max(a, b)] = met.get((min(a, b), max(a, b)), 0) + 1
        part = t[:, model.starts[block] : model.ends[block]]
        for a, b in itertools.combinations(range(400), 2):
            if ((part[a] - part[b]) ** 2).sum() <= model.budget[block]:
                assert met[a, b] == 1
        assert len(met) < 400 * 399 / 2 * 0.8  # the planes do keep pairs apart


def test_attach_deals_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "CROWDED_ROWS", 10)
    left = spark.range(1000).select((F.col("id") % 7 * (F.col("id") % 2)).alias("k"), F.col("id").alias("v"))
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    got = common.attach(left, right, ["k"], "n", by=["v"])
    assert got.columns == ["k", "v", "top"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right.drop("n"), "k").collect()))


def test_vectors_without_any(spark):
    none = table(spark, vector_rows()[:1]).filter("false")
    assert subspaces.near_vectors(none).count() == 0
    assert negatives.hard_negatives(none, F.col("id") % 50 == 0).count() == 0
    bad = table(spark, [(1, None, [1.0]), (2, 1, None), (None, None, None)])
    alone = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in subspaces.near_vectors(bad).collect()}
    assert alone == {(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)}
    assert negatives.hard_negatives(bad, F.col("id") % 50 == 0).count() == 0


def brute_negatives(rows, anchor, n_positives, n_negatives, low, high, scale):
    nodes = [(i, label, np.floor(np.array(v) * scale)) for i, label, v in usable(rows, zero=True)]
    x = np.array([v for _, _, v in nodes])
    out = []
    for a in (a for a in range(len(nodes)) if anchor(nodes[a][0])):
        scores = (x @ x[a]).astype(int).tolist()
        by_score = sorted((-s, nodes[b][0], nodes[b][1]) for b, s in enumerate(scores) if nodes[b][0] != nodes[a][0])
        for ps, p, _ in [r for r in by_score if r[2] == nodes[a][1]][:n_positives]:
            fits = [r for r in by_score if r[2] != nodes[a][1] and -low * ps <= -100 * r[0] <= -high * ps][:n_negatives]
            out += [(nodes[a][0], p, k, i, -ps, -s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("cells", [False, True])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, cells):
    if cells:
        for name, value in (("LEAF", 4), ("FANOUT", 2), ("SAMPLE", 20)):
            monkeypatch.setattr(negatives, name, value)
        monkeypatch.setattr(negatives.V, "BLOCK", 32)
        monkeypatch.setattr(negatives.V, "QUERIES", 8)
    rows = vector_rows()
    got = negatives.hard_negatives(table(spark, rows), F.col("id") % 5 == 0)
    want = brute_negatives(rows, lambda i: i % 5 == 0, 5, 3, 50, 95, 256)
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) > 200


def test_boxes_prune_without_loss():
    """On clustered vectors most rows are never scored, and nothing is missed."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(64, 8)) * 100
    x = np.floor(np.repeat(centres, 40, 0) + rng.normal(size=(2560, 8)) * 3)
    label = rng.integers(0, 3, 2560)
    ids = np.empty(2560, object)
    ids[:] = [[i] for i in range(2560)]
    tree = negatives.RTree(x, label, 16, 8)
    q = x[::64]
    scored = 0
    every = tree.bounds(q)
    for i in range(len(q)):
        bounds = [(a[i], b[i]) for a, b in every]
        exact = x @ q[i]
        best = negatives.Nearest(5)
        scored += negatives.search(tree, ids, q[i], bounds, 1, None, [best])
        assert best.found == sorted((-exact[r], r) for r in np.flatnonzero(label == 1))[:5]
        top = -best.found[0][0]
        some = [negatives.Nearest(3, low=0.5 * top, high=0.9 * top), negatives.Nearest(3, low=0.2 * top, high=0.3 * top)]
        scored += negatives.search(tree, ids, q[i], bounds, None, 1, some)
        for w in some:
            fits = [r for r in np.flatnonzero(label != 1) if w.low <= exact[r] <= w.high]
            assert w.found == sorted((-exact[r], r) for r in fits)[:3]
    assert scored < 0.5 * len(q) * len(x)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text, max_n):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, max_n, buckets, min_words, per_cent, seed):
    feats = [(i, *brute_features(t, max_n)) for i, t in docs]
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, _, f in feats:
        np.add.at(s, np.array(f, int) % buckets, 1)
    for text in target:
        np.add.at(t, np.array(brute_features(text, max_n)[1], int) % buckets, 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out, may = [], []
    for i, n, f in feats:
        weight = sum(gain[x % buckets] for x in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= min_words:
                may.append((-score, i))
        out.append((i, len(f), n, weight, score))
    drawn = sorted(may)[: per_cent * len(may) // 100]
    return out, drawn


TEXTS = [
    (1, None),
    (2, ""),
    (3, "  \n . "),
    (4, "Straße ÀÉ naïve 日本語 x1 1x it's a-b\x00c"),
    (5, "word " * 30),
    (5, "word " * 30),
    (None, "target words of the benchmark " * 10),
    (6, "\x1c".join(f"w{i % 5}" for i in range(3000))),
    *((10 + i, " ".join(f"{'tT'[i % 2]}{(i * j) % 11}é" for j in range(i))) for i in range(60)),
]


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_resample_equals_brute_force(spark, monkeypatch, max_n):
    monkeypatch.setattr(common, "SLICE_BYTES", 500)
    docs = spark.createDataFrame([(i, t, 0, 0, 0, 0) for i, t in TEXTS], "doc_id long, text string, rank int, score int, weight int, __place int").repartition(4)
    target = ["T1é t2é benchmark", None, "words of the x1"]
    got = resample.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), max_n=max_n, buckets=500, min_words=5, per_cent=30).collect()
    want, drawn = brute_resample(TEXTS, target, max_n, 500, 5, 30, resample.SEED)

    def plain(rows):
        return sorted(map(str, rows))

    assert plain((r["doc_id"], r["n_features"], r["n_words"], r["weight"], r["score"]) for r in got) == plain(want)
    ranks = sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranks] == list(range(1, len(drawn) + 1))
    assert [r[1:] for r in ranks] == drawn
    assert len(drawn) > 10
    kept = resample.drawn_rows(docs, spark.createDataFrame(got))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for _, i in drawn}


def test_resample_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(docs, docs).count() == 0
    some = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert [tuple(r) for r in resample.resample(some, docs, per_cent=100).select("n_features", "rank").collect()] == [(30, 1)]


def test_ngrams_do_not_cross_documents():
    doc, bucket, words = resample.ngram_buckets([b"a b", b"", b"b", b"C d e"], 2, 1 << 32)
    assert words.tolist() == [2, 0, 1, 3]
    assert sorted(zip(doc.tolist(), bucket.tolist(), strict=True)) == sorted(
        (i, zlib.crc32(f)) for i, f in [(0, b"a"), (0, b"b"), (0, b"a b"), (2, b"b"), (3, b"c"), (3, b"d"), (3, b"e"), (3, b"c d"), (3, b"d e")]
    )


@pytest.mark.parametrize("name", ["op11_subspace_dedup", "op12_importance_resampling", "op13_hard_negatives"])
def test_queries_take_whole_tables(spark, name):
    data = "/root/testdata/sf0.001"
    n = Q.QUERIES[name](spark, data).count()
    table_name = "documents" if name.startswith("op12") else "embeddings"
    rows = spark.read.parquet(f"{data}/{table_name}.parquet")
    assert n == rows.count() if not name.startswith("op13") else n > 0
