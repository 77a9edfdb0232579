"""Python workers hold slices of a batch, whatever the batch holds; what is
costly is done once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from babelframe.functions import ngrams as NG
from babelframe.llm import common, suffixes
from babelframe.operators import metrics as ME
from babelframe.operators import translate as TR
from babelframe.sources import json_records as JR


def test_passages_are_looked_for_in_small_slices(monkeypatch):
    sizes, real = [], common.words
    monkeypatch.setattr(common, "words", lambda text, **k: sizes.append(text.nbytes) or real(text, **k))
    texts = [" ".join(f"w{i}x{j}" for j in range(2000)) for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array([b"d"] * 200, pa.binary()), pa.array(texts)], names=["id", "digest", "text"])
    assert sum(b.num_rows for b in suffixes._suffixes(iter([batch]))) == 200
    assert max(sizes) < 600_000


def test_json_chunks_are_cut_within_a_batch(monkeypatch):
    monkeypatch.setattr(JR, "CHUNK", 500)
    lines = [b"x" * (i % 90) for i in range(1000)]
    begin = [0] * 700 + [4096] * 300
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["f"] * 1000), pa.array(begin, pa.int64()), pa.array(lines, pa.binary())], names=["file", "begin", "value"]
    )
    found = list(JR._chunks(iter([batch])))
    assert max(len(text.replace(b"}", b"")) for _, _, text in found) <= 500 + 90
    for of, rows in ((0, lines[:700]), (4096, lines[700:])):
        assert b"".join(text for _, at, text in found if at == of) == b"".join(x + b"}" for x in rows)


def test_calls_get_whole_chunks_of_bounded_parts(monkeypatch):
    monkeypatch.setattr(TR, "SLICE_BYTES", 1000)
    text, called = pa.array(["y" * 30] * 500), np.arange(500) % 3 > 0
    parts = list(TR._parts(text, called, TR.CallPlan(4, 10, 0.0, 2)))
    assert [p.start for p in parts] == [0, *(p.stop for p in parts[:-1])] and parts[-1].stop == 500
    assert max(p.stop - p.start for p in parts) <= 1000 // 30
    assert all(called[p].sum() % 10 == 0 for p in parts[:-1])


def test_one_sort_gives_the_matches_of_all_orders():
    rng = np.random.default_rng(5)
    for base, pairs, order in ((3, 20, 6), (40, 7, 4), (2, 1, 2)):
        row = np.repeat(np.arange(2 * pairs), rng.integers(0, 30, 2 * pairs))
        unit = rng.integers(0, base, len(row))
        args = (row, unit, base, pairs, order)
        assert (NG._matches(*args) == NG._matches_by_order(*args)).all()


def test_counting_udfs_take_slices(monkeypatch):
    monkeypatch.setattr(NG, "BATCH_CHARS", 300)
    texts = pa.array(["abc def " * 5, None] * 40)
    seen = []
    found = NG._lists((texts, texts), lambda h, r: seen.append(len(h)) or NG.chrf_batch(h, r))
    assert max(seen) < 10
    whole = texts.to_pylist()
    assert found.to_pylist() == NG.chrf_batch(whole, whole).tolist()
    assert len(NG._lists((texts[:0], texts[:0]), NG.chrf_batch)) == 0


def test_tokens_are_found_once(spark):
    flag = ME.repeated_tokens("p", "r")
    df = spark.createDataFrame([("a a b", "x"), ("a a b", "a"), ("a b", "x"), (None, "x"), ("a a", None), ("", "")], "p string, r string")
    plan = df.select(flag.alias("f"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2
    assert [r["f"] for r in df.select(flag.alias("f")).collect()] == [True, False, False, False, False, False]
