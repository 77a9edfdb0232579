"""The registered queries of the training-data operators: whole tables, their
SQL where there is one, no cross joins on the way; the pipeline end to end."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from babelframe.llm.oracle import ORACLE
from babelframe.llm.queries import QUERIES, vocabulary_path
from tests.conftest import SMOKE, no_cross_joins


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, plans, name):
    df = QUERIES[name](spark, SMOKE)
    got = df.collect()
    assert got and no_cross_joins(plans)
    if name in ORACLE:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
        res = con.execute(ORACLE[name])
        names = [d[0] for d in res.description]
        want = res.fetchall()
        assert sorted(names) == sorted(df.columns)
        assert sorted(str([_plain(r[n]) for n in sorted(names)]) for r in got) == sorted(
            str([_plain(v) for _, v in sorted(zip(names, r, strict=True))]) for r in want
        )


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v


def pipeline_rows(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").filter("doc_id < 80")
    extra = [F.when(F.col("doc_id") >= 0, x).alias(c) for c, x in (("blob", F.lit("b")), ("id", F.lit(1)))]
    return docs.select("*", *extra)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_on_hard_tables(spark, stage):
    """Empty tables, NULL rows and columns called like helpers."""
    empty = spark.read.parquet(f"{SMOKE}/documents.parquet").limit(0)
    assert stage[1](spark, empty, SMOKE).count() == 0
    df = pipeline_rows(spark)
    nulls = spark.createDataFrame([(None,) * 7, (7000, None, None, None, None, None, None)], df.schema)
    out = stage[1](spark, df.unionByName(nulls), SMOKE)
    assert out.columns == df.columns
    assert out.filter("doc_id IS NOT NULL AND text IS NOT NULL").count() > 30


def test_pipeline_end_to_end(spark):
    """Each stage on what its predecessor kept; the result packs every text
    that is left, whole."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMOKE).collect(), docs.schema)
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in docs.collect())
    got = corpus_pipeline.run(spark, SMOKE)
    rows = got.collect()
    lengths: dict = {}
    for r in rows:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert sorted(lengths.items()) == want
    assert all(0 <= r["offset"] and r["offset"] + r["length"] <= 4096 for r in rows)
