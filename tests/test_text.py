"""Scalar text functions: P6, P7, P10, P12-P15, M2, M8, M9 and the whitespace
and word-character traps (D3, D9, R4)."""

from __future__ import annotations

import json
import random
import re

from pyspark.sql import functions as F

from babelframe.functions import text as X


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


def test_strip_image_tag_and_affix(spark):
    df = spark.createDataFrame(
        [("Say it.\n<image>",), ("<image>\nSay it.",), ("a <image> b",), ("<image>",)], "s string"
    )
    got = [tuple(r) for r in df.select(X.strip_image_tag("s"), X.strip_image_affix("s")).collect()]
    assert got == [
        ("Say it.\n", "Say it."),
        ("\nSay it.", "Say it."),
        ("a  b", "a <image> b"),
        ("", "<image>"),
    ]


def test_capitalize_first_is_not_initcap(spark):
    assert one(spark, X.capitalize_first("s"), "hINDI") == "Hindi"
    assert one(spark, X.capitalize_first("s"), "hIGH gERMAN") == "High german"
    assert one(spark, X.capitalize_first("s"), "") == ""


def test_language_name_and_jp_alias(spark):
    df = spark.createDataFrame([("jp",), ("ja",), ("HI",), ("xx",)], "s string")
    assert [r[0] for r in df.select(X.language_name("s")).collect()] == ["Japanese", "Japanese", "Hindi", None]


def test_render_template_and_input_message(spark):
    assert one(spark, X.render_template("Translate: {message}", F.col("s")), "a kite") == "Translate: a kite"
    assert one(spark, X.input_message("s"), "a kite") == "Input: a kite"


def test_as_message_coerces(spark):
    assert one(spark, X.as_message("s"), 42, "s int") == "42"
    assert one(spark, X.as_message("s"), None) == "None"


def test_clean_response_unicode_whitespace(spark):
    # "response" fixture: ideographic space, blanks, NULL
    df = spark.createDataFrame([("　x ",), ("   ",), (None,), (" \t y ",)], "s string")
    text, err = X.clean_response("s")
    got = [tuple(r) for r in df.select(text, err).collect()]
    assert got[0] == ("x", None)
    assert got[1][0] == "" and got[1][1].startswith("empty_response")
    assert got[2] == (None, "No response")
    assert got[3] == ("y", None)


def test_strip_ws_matches_python_strip(spark):
    ws = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert len(ws) == 29
    assert sorted(X.WS_LIST) == sorted(ws)
    random.seed(3)
    vals = ["".join(random.choice(ws + "ab") for _ in range(12)) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(X.strip_ws("s")).collect()]
    assert got == [v.strip() for v in vals]
    got = [r[0] for r in df.select(F.size(X.split_ws("s"))).collect()]
    assert got == [len(v.split()) for v in vals]


def test_words_lower_matches_python_word_regex(spark):
    # D3: Hindi vowel signs and French accents, as Python's \w sees them
    texts = ["Le Café, c'est très bien!", "नमस्ते दुनिया कि", "snake_case 42 x", "", "ÉCOLE école"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [list(r[0]) for r in df.select(X.words_lower("s")).collect()]
    assert got == [re.findall(r"\w+", t.lower()) for t in texts]


def test_json_length_matches_json_dumps(spark):
    random.seed(7)
    alphabet = ['a', '"', "\\", "\n", "\t", "\x01", "\x7f", "é", "中", "\U0001f600", " ", "/"]
    convs = []
    for _ in range(60):
        turns = [
            {"from": random.choice(["human", "gpt"]), "value": "".join(random.choice(alphabet) for _ in range(random.randint(0, 15)))}
            for _ in range(random.randint(0, 4))
        ]
        convs.append(turns)
    df = spark.createDataFrame([(c,) for c in convs], "c array<struct<from:string,value:string>>")
    got = [r[0] for r in df.select(X.json_turns_length("c")).collect()]
    assert got == [len(json.dumps(c)) for c in convs]


def test_char_length_counts_code_points(spark):
    assert one(spark, X.char_length("s"), "a\U0001f600é") == 3
