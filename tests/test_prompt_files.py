"""Disk of prompt_file_evaluation: texts move once, what is kept is packed."""

from __future__ import annotations

import json
import os
import random
import time

import pytest

from babelframe import constants as C
from babelframe.operators import prompts as PM
from babelframe.operators import translate as TR
from babelframe.plans import pipelines as PL
from babelframe.plans import queries as Q
from babelframe.session import configured
from babelframe.sources import io


def _files(roots: list[str]) -> dict[str, int]:
    found = (os.path.join(d, f) for r in roots for d, _, fs in os.walk(r) for f in fs)
    return {p: os.path.getsize(p) for p in found if os.path.exists(p)}


def test_disk_of_prompt_files(spark, tmp_dir):
    """What is left of the whole job, shuffle files among it, is under three
    times its texts (5.3 times before)."""
    draw = random.Random(7)
    words = ["".join(draw.choices("etaoinshr", k=draw.randint(2, 9))) for _ in range(400)]
    texts = [" ".join(draw.choices(words, k=300)) for _ in range(1600)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    roots = [*dirs, spark.conf.get("spark.checkpoint.dir")]
    before = _files(roots)
    rep = Q.q_prompt_file_evaluation(spark, tmp_dir)
    end = time.monotonic() + 20  # shuffle files are removed in the background
    while (left := sum(n for p, n in _files(roots).items() if p not in before)) > 3 * sum(map(len, texts)) and time.monotonic() < end:
        time.sleep(0.5)
    assert left < 3 * sum(map(len, texts))
    got = {(r["prompt_idx"], r["lang"], r["English"], r["Ground_truth"], r["Model_output"]) for r in rep.collect()}
    english = texts[200 * C.BLOCK_LANGUAGES.index("en") :][:200]
    assert len(got) == 1400 and {x[2] for x in got} == set(english) and {x[3] for x in got} == set(texts) - set(english)
    assert all(x[4] == " ".join(f"Input: {x[2]}".split(" ")[::-1]) for x in got)


def test_dealt_rows_are_not_shuffled(spark, tmp_dir):
    """Rows of files are called where they are read, by the tasks asked for."""
    path = os.path.join(tmp_dir, "texts")
    spark.range(60).selectExpr("id", "concat('a b ', id) AS t").repartition(12).write.parquet(path)
    with configured(spark, files__maxPartitionBytes="1"):
        read = spark.read.parquet(path)
        assert read.rdd.getNumPartitions() >= 12
        out = TR.translate_column(read, "t", TR.ReverseWords(), keep=["id"], num_partitions=5, dealt=True)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.rdd.getNumPartitions() == 5
        assert {(r["id"], r["translation"]) for r in out.collect()} == {(i, f"{i} b a") for i in range(60)}


@pytest.mark.parametrize("writers", [2, 64])
def test_more_reports_than_a_task_keeps_open(spark, tmp_dir, monkeypatch, writers):
    """Every report is whole, also those past the ones kept open; prompts of
    a read list are broadcast, not shuffled with the texts."""
    monkeypatch.setattr(io, "REPORT_WRITERS", writers)
    pairs = spark.createDataFrame([(f"one {i}", "French", f"{i} one") for i in range(40)], "sentence string, lang string, translation string")
    prompts = PM.prompts_from_rows(spark, [["French", "p", str(i)] for i in range(9)])
    rep = PL.prompt_eval_pipeline(prompts, pairs, TR.ReverseWords(), f"{tmp_dir}/reports", num_partitions=2)
    assert sorted((r["prompt_idx"], r["English"]) for r in rep.collect()) == sorted((p, f"one {i}") for p in range(9) for i in range(40))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_list_of_prompts_is_broadcast(spark, tmp_dir, plans):
    """Pairs of a read list's prompts are not shuffled to meet them."""
    with open(os.path.join(tmp_dir, "prompts.json"), "w") as f:
        f.write("\n".join(json.dumps(["French", f"prompt {i} " * 30, "{message}"]) for i in range(300)))
    pairs = spark.createDataFrame([(f"a {i}", "French", f"b {i}") for i in range(5)], "sentence string, lang string, translation string")
    with configured(spark, autoBroadcastJoinThreshold="256k"):
        prompts = PM.read_prompt_list(spark, os.path.join(tmp_dir, "prompts.json"))
        plans.clear()
        rep = PL.prompt_eval_pipeline(prompts, pairs, TR.ReverseWords(), f"{tmp_dir}/reports", num_partitions=2)
    assert rep.count() == 1500
    written = [p for p in plans if "MapInArrow" in p]
    assert len(written) == 1 and "BroadcastHashJoin" in written[0] and "Exchange hashpartitioning" not in written[0]


def test_settings_are_put_back(spark):
    name, other = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set(name, "3")
    try:
        with pytest.raises(ValueError), configured(spark, maxConcurrentOutputFileWriters="5", ansi__enabled="false"):
            assert (spark.conf.get(name), spark.conf.get("spark.sql.ansi.enabled")) == ("5", "false")
            raise ValueError
        assert (spark.conf.get(name), spark.conf.get("spark.sql.ansi.enabled")) == ("3", other)
    finally:
        spark.conf.unset(name)
