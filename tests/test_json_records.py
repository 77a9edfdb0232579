"""JSON arrays cut into byte ranges: equal rows for every layout and cut."""

from __future__ import annotations

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from babelframe.sources import io
from babelframe.sources import json_records as JR

TEXTS = ["plain", 'quote " inside', "back\\slash \\", "} brace ] [ {", "é 中 😀", "", 'end with slash \\" }', "a\nb", '\\\\"{', "x" * 3000]


def records(n: int) -> list[dict]:
    rnd = random.Random(7)
    return [
        {
            "id": f"{i:09d}",
            "image": f"{i}.jpg",
            "conversations": [{"from": rnd.choice(["human", "gpt"]), "value": rnd.choice(TEXTS)} for _ in range(rnd.randint(0, 5))],
        }
        for i in range(n)
    ]


def plain(rows) -> list:
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in rows)


@pytest.mark.parametrize("layout", [{"indent": 4}, {}, {"ensure_ascii": False}, {"separators": (",", ":")}, "lines"])
def test_any_layout_in_many_ranges(spark, tmp_dir, monkeypatch, layout):
    monkeypatch.setattr(JR, "CHUNK", 500)
    rows = records(150)
    path = os.path.join(tmp_dir, "data.json")
    with open(path, "w", encoding="utf-8") as f:
        if layout == "lines":
            f.write("\n".join(json.dumps(r) for r in rows))
        else:
            json.dump(rows, f, **layout)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = sorted(json.dumps(r, sort_keys=True) for r in rows)
    try:
        for size in ("700", "4k", "16m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = io.read_conversations(spark, path).collect()
            assert plain(got) == want
            texts = JR.read_record_texts(spark, path)
            if size == "700":
                assert texts.select("begin").distinct().count() > 10  # read by several tasks
            assert [json.loads(r["text"])["id"] for r in texts.orderBy("file", "begin", "place").collect()] == [r["id"] for r in rows]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_large_array_is_read_by_several_tasks(spark, tmp_dir):
    """As Spark's own reader gives it, which reads it in one task."""
    path = os.path.join(tmp_dir, "large.json")
    rows = records(4000)
    with open(path, "w") as f:
        json.dump(rows, f)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        got = io.read_conversations(spark, path)
        assert JR.read_record_texts(spark, path).select("begin").distinct().count() >= 3
        own = spark.read.schema(io.CONVERSATION_SCHEMA).option("multiLine", True).json(path)
        assert got.exceptAll(own).isEmpty() and own.exceptAll(got).isEmpty() and got.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_empty_and_small_files(spark, tmp_dir):
    for name, text, n in [("a", "[]", 0), ("b", "  [ ]\n", 0), ("c", '[{"id": "1"}]', 1), ("d", '{"id": "1"}\n{"id": "2"}\n', 2)]:
        path = os.path.join(tmp_dir, f"{name}.json")
        with open(path, "w") as f:
            f.write(text)
        assert io.read_metadata(spark, path).count() == n


def test_written_arrays_are_read_back(spark, tmp_dir):
    df = spark.range(0, 50, 1, 3).select(F.col("id").cast("string"), F.concat(F.lit('say "'), F.col("id"), F.lit("\\\n}")).alias("blip_caption"))
    JR.write_arrays(df, os.path.join(tmp_dir, "arrays"))
    for name in os.listdir(os.path.join(tmp_dir, "arrays")):
        if name.endswith(".txt"):
            with open(os.path.join(tmp_dir, "arrays", name)) as f:
                assert isinstance(json.load(f), list)
    back = io.read_metadata(spark, os.path.join(tmp_dir, "arrays"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_scan_knows_escapes():
    text = b'{"a\\\\": "}\\"{"}'
    step, ends = JR._scan(np.frombuffer(text, np.uint8), False)
    assert [i for i in np.flatnonzero(step)] == [0, len(text) - 1] and not ends
