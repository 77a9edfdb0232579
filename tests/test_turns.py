"""Conversation operators P1-P5, F6 on nested rows and flat turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from babelframe.functions import turns as FT
from babelframe.operators import turns as TU
from tests.conftest import rows

CONV = "id string, image string, conversations array<struct<from:string,value:string>>"


def conv_basic(spark):
    return spark.createDataFrame(
        [
            ("000000001", "00000/000000001.jpg", [("human", "Say it.\n<image>"), ("gpt", "a red kite")]),
            ("000000002", "00000/000000002.jpg", [("human", "<image>\nSay it."), ("gpt", "a blue kite")]),
        ],
        CONV,
    )


def conv_odd(spark):
    return spark.createDataFrame(
        [
            ("a", "i", []),
            ("b", "i", [("human", "only human")]),
            ("c", "i", [("human", "h"), ("gpt", "first"), ("gpt", "second")]),
            ("d", "i", [("gpt", "g first"), ("human", "h last")]),
            ("e", "i", [("system", "sys"), ("human", "h"), ("gpt", "g")]),
            ("f", "i", [("human", "h"), ("gpt", None)]),
        ],
        CONV,
    )


def test_extract_values_last_of_role(spark):
    out = TU.extract_values(conv_odd(spark))
    got = {r["id"]: (r["human_value"], r["gpt_value"]) for r in out.collect()}
    assert got == {
        "a": ("", ""),
        "b": ("only human", ""),
        "c": ("h", "second"),
        "d": ("h last", "g first"),
        "e": ("h", "g"),
        "f": ("h", ""),
    }


def test_first_last_and_multi_turn(spark):
    df = conv_odd(spark).select(
        "id",
        FT.first_value_of_role("conversations", "gpt").alias("first"),
        FT.last_turn_value("conversations").alias("last"),
        FT.is_multi_turn("conversations").alias("multi"),
    )
    got = {r["id"]: (r["first"], r["last"], r["multi"]) for r in df.collect()}
    assert got["a"] == (None, None, False)
    assert got["b"] == (None, "only human", False)
    assert got["c"] == ("first", "second", True)
    assert got["d"] == ("g first", "h last", False)
    assert got["e"] == ("g", "g", True)


def test_replace_role_values_all_caption_turns(spark):
    df = conv_odd(spark).select("id", FT.replace_role_values("conversations", "gpt", F.lit("T")).alias("c"))
    got = {r["id"]: [tuple(t) for t in r["c"]] for r in df.collect()}
    assert got["c"] == [("human", "h"), ("gpt", "T"), ("gpt", "T")]
    assert got["b"] == [("human", "only human")]


def test_flat_forms_agree_with_nested(spark):
    nested = conv_odd(spark)
    flat = TU.explode_turns(nested)
    assert flat.count() == 11
    a = rows(TU.role_values(flat), "id", "human_value", "gpt_value")
    b = rows(TU.extract_values(nested).filter(F.size("conversations") > 0), "id", "human_value", "gpt_value")
    assert a == b
    first = {r["id"]: r["caption"] for r in TU.first_role_value(flat).collect()}
    assert first["c"] == "first" and first["b"] is None
    last = {r["id"]: r["conversations"] for r in TU.last_turn(flat).collect()}
    assert last["d"] == "h last"


def test_replace_role_turns_flat(spark):
    flat = TU.explode_turns(conv_odd(spark))
    rep = spark.createDataFrame([("c", "X")], "id string, translation string")
    out = {(r["id"], r["turn"]): r["value"] for r in TU.replace_role_turns(flat, rep).collect()}
    assert out[("c", 1)] == "X" and out[("c", 2)] == "X" and out[("c", 0)] == "h"
    assert out[("d", 0)] == "g first"


def test_turn_counts(spark):
    flat = TU.explode_turns(conv_odd(spark))
    got = {r["id"]: r["multi_turn"] for r in TU.turn_counts(flat).collect()}
    assert got == {"b": False, "c": True, "d": False, "e": True, "f": False}


def test_hot_conversation(spark):
    """One conversation holds most turns: aggregates and the pair join stay
    exact (no operator gathers the conversation)."""
    from babelframe.plans.queries import drop_every_fifth_word  # noqa: F401

    n = 3000
    rows = [("hot", i, "human" if i % 2 == 0 else "gpt", f"t{i}") for i in range(n)]
    rows += [(f"c{j}", i, "human" if i % 2 == 0 else "gpt", f"c{j}-{i}") for j in range(20) for i in range(2)]
    flat = spark.createDataFrame(rows, "id string, turn long, `from` string, value string").repartition(8)
    vals = {r["id"]: (r["human_value"], r["gpt_value"]) for r in TU.role_values(flat).collect()}
    assert vals["hot"] == (f"t{n - 2}", f"t{n - 1}")
    first = {r["id"]: r["caption"] for r in TU.first_role_value(flat).collect()}
    assert first["hot"] == "t1"
    rep = TU.first_role_value(flat).select("id", F.upper("caption").alias("translation"))
    out = TU.replace_role_turns(flat, rep)
    assert out.filter((F.col("id") == "hot") & (F.col("value") == "T1")).count() == n // 2
    prev = flat.select("id", (F.col("turn") + 1).alias("turn"), F.col("value").alias("reference"))
    pairs = flat.join(prev, ["id", "turn"])
    assert pairs.filter(F.col("id") == "hot").count() == n - 1
