"""U1-U5, W1/W2, F8, K1 (resume and streaming), C1-C3, J4, J5."""

from __future__ import annotations

import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from babelframe.operators import prompts as PM
from babelframe.operators import translate as TR
from babelframe.plans import pipelines as PL
from babelframe.sources import io
from tests.conftest import rows


class CountingTranslator:
    """Reverses words and records every message it was called with."""

    def __init__(self, log_dir):
        self.log_dir = log_dir

    def __call__(self):
        log_dir = self.log_dir

        def translate(messages, preambles=None, targets=None):
            with open(os.path.join(log_dir, f"calls-{os.getpid()}-{time.time_ns()}.json"), "w") as f:
                json.dump(list(messages), f)
            return messages.map(lambda s: " ".join(s.split(" ")[::-1]))

        return translate


def called_messages(log_dir):
    out = []
    for name in os.listdir(log_dir):
        with open(os.path.join(log_dir, name)) as f:
            out += json.load(f)
    return sorted(out)


def test_translate_column_success_and_failure(spark):
    df = spark.createDataFrame([("1", "a b c"), ("2", "   "), ("3", None)], "id string, t string")
    ok = {r["id"]: (r["translation"], r["error"]) for r in TR.translate_column(df, "t", TR.ReverseWords(), keep=["id"]).collect()}
    assert ok["1"] == ("c b a", None)
    assert ok["2"][0] is None and ok["2"][1].startswith("empty_response")
    assert ok["3"] == (None, "No text")  # a NULL is never sent
    bad = TR.translate_column(df, "t", TR.FailingTranslator(), keep=["id"])
    assert all(r["error"].startswith("call failed" if r["t"] else "No text") and r["translation"] is None for r in bad.collect())
    assert TR.failure_counts(bad).count() == 2


def test_only_when_skips_rows(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a b", True), ("2", "c d", False)], "id string, t string, go boolean")
    out = TR.translate_column(df, "t", CountingTranslator(tmp_dir), keep=["id"], only_when=F.col("go"))
    got = {r["id"]: (r["translation"], r["error"]) for r in out.collect()}
    assert got == {"1": ("b a", None), "2": (None, None)}
    assert called_messages(tmp_dir) == ["a b"]


def test_pacer_spacing():
    p = TR.Pacer(calls=600, period=60)  # 10 calls / s
    t0 = time.monotonic()
    for _ in range(4):
        p.wait(1)
    assert time.monotonic() - t0 >= 0.25
    TR.Pacer(None).wait(5)


def test_paced_translation_respects_global_budget(spark):
    df = spark.createDataFrame([(str(i), f"w{i} x") for i in range(8)], "id string, t string")
    t0 = time.monotonic()
    out = TR.translate_column(df, "t", TR.ReverseWords(), keep=["id"], calls_per_minute=240, num_partitions=2, batch_size=1)
    assert out.filter(F.col("error").isNull()).count() == 8
    # 8 calls at 4 calls/s overall (2 tasks x 2/s): at least ~1.5 s
    assert time.monotonic() - t0 >= 1.4


def test_batch_ids_and_order(spark):
    df = spark.createDataFrame([(i, 100 - i) for i in range(25)], "row_idx long, len long")
    df = df.withColumn("b", TR.batch_ids("row_idx", 10))
    out = TR.order_within_batches(df, "b", "len", "row_idx")
    got = {r["row_idx"]: (r["b"], r["position_in_batch"]) for r in out.collect()}
    assert got[0] == (0, 10) and got[9] == (0, 1) and got[24] == (2, 1)


def test_resume_skips_logged_ids(spark, tmp_dir):
    conv = spark.createDataFrame(
        [(f"{i:09d}", "img", [("human", "q"), ("gpt", f"caption {i} here")]) for i in range(5)], io.CONVERSATION_SCHEMA
    )
    out_dir = os.path.join(tmp_dir, "out")
    calls = os.path.join(tmp_dir, "calls")
    os.makedirs(calls)
    # first run on 2 rows, second on all 5: only 3 new calls
    PL.translate_pipeline(spark, conv.filter(F.col("id") < "000000002"), CountingTranslator(calls), out_dir)
    res = PL.translate_pipeline(spark, conv, CountingTranslator(calls), out_dir)
    assert len(called_messages(calls)) == 5
    log = rows(res.audit_log)
    assert len(log) == 5 and len({r[0] for r in log}) == 5
    outputs = {r["id"]: r["conversations"][1]["value"] for r in res.output.collect()}
    assert outputs["000000004"] == "here 4 caption"


def test_memory_translate_keeps_affix_side(spark):
    memory = spark.createDataFrame([("Describe it.", "Hindi", "वर्णन करें।")], "sentence string, lang string, translation string")
    df = spark.createDataFrame(
        [(1, "<image>\nDescribe it."), (2, "Describe it.\n<image>"), (3, "Unknown.")], "id int, t string"
    )
    got = {r["id"]: r["translation"] for r in TR.memory_translate(df, memory, "t", "Hindi").collect()}
    assert got == {1: "<image>\nवर्णन करें।", 2: "वर्णन करें।\n<image>", 3: None}


def test_back_translate_one_job_all_languages(spark):
    df = spark.createDataFrame(
        [(0, "1", "fr", "un deux"), (1, "1", "en", "one two"), (2, "2", "jp", "x y")],
        "row_idx long, id string, language string, conversations string",
    )
    got = {r["row_idx"]: r["back_translations"] for r in TR.back_translate(df, TR.ReverseWords(), keep=["row_idx"]).collect()}
    assert got == {0: "deux un", 1: None, 2: "y x"}
    unknown = spark.createDataFrame([(0, "1", "xx", "a")], "row_idx long, id string, language string, conversations string")
    with pytest.raises(Exception):
        TR.back_translate(unknown, TR.ReverseWords(), keep=["row_idx"], languages=["xx"]).collect()


def test_prompts_checks_and_arity(spark):
    with pytest.raises(ValueError):
        PM.prompts_from_rows(spark, [["Hindi", "p"]])
    p = PM.prompts_from_rows(spark, [["hINDI", "", "{message}"], [" ", "pre", "m"], ["French", "pre", "m"]])
    got = [r["validation_error"] for r in PM.check_prompts(p).orderBy("prompt_idx").collect()]
    assert got[0] == "prompt_blank"
    assert got[1] == "target_blank"
    assert got[2] is None
    assert [r["lang"] for r in PM.normalise_target(p).orderBy("prompt_idx").collect()][0] == "Hindi"


def test_catalogue_and_directions(spark):
    cat = PM.prompt_catalogue(spark)
    assert cat.count() == 14
    assert cat.select("lang").distinct().count() == 7
    hi = {r["direction"]: r["preamble"] for r in cat.filter("lang = 'hi'").collect()}
    assert "from Hindi into English" in hi[PM.TO_ENGLISH] and "from English into Hindi" in hi[PM.TO_LANGUAGE]


def test_prompt_list_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "prompts.jsonl")
    with open(path, "w") as f:
        f.write('["Hindi", "pre", "{message}"]\n["Spanish", "pre", "{message}"]\n')
    assert PM.read_prompt_list(spark, path).count() == 2
    with open(path, "w") as f:
        f.write('["Hindi", "pre"]\n')
    with pytest.raises(ValueError):
        PM.read_prompt_list(spark, path)


def test_stream_equals_batch(spark, tmp_dir):
    from babelframe.streaming.incremental import stream_translate

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    pdf = pd.DataFrame(
        {"conv_id": [0, 0, 1, 1, 2], "turn": [0, 1, 0, 1, 0], "role": ["user", "assistant", "user", "assistant", "user"], "text": ["q", "a b", "q", "c d e", "z"]}
    )
    pdf.iloc[:2].to_parquet(os.path.join(src, "part-0.parquet"))
    pdf.iloc[2:].to_parquet(os.path.join(src, "part-1.parquet"))
    out = stream_translate(spark, src, TR.ReverseWords(), os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    assert rows(out, "id", "translation") == [("000000000", "b a"), ("000000001", "e d c")]
    # a restart finds nothing new: the checkpoint remembers both files
    again = stream_translate(spark, src, TR.ReverseWords(), os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    assert again.count() == 2


def test_calls_go_in_length_order_within_a_task(spark, tmp_dir):
    texts = ["a b c d e f", "a", "a b c", "a b"]
    df = spark.createDataFrame([(str(i), t, len(t)) for i, t in enumerate(texts)], "id string, t string, n int").coalesce(1)
    TR.translate_column(df, "t", CountingTranslator(tmp_dir), keep=["id"], order_col="n", batch_size=1, num_partitions=1).collect()
    files = sorted(os.listdir(tmp_dir), key=lambda f: int(f.rsplit("-", 1)[1].split(".")[0]))
    order = []
    for name in files:
        with open(os.path.join(tmp_dir, name)) as f:
            order += json.load(f)
    assert order == sorted(texts, key=len)


def test_resume_trusts_staged_translations(spark, tmp_dir):
    """A run that staged its translations but stopped before the log append:
    the next run calls nothing for those ids and logs them."""
    conv = spark.createDataFrame(
        [(f"{i:09d}", "img", [("human", "q"), ("gpt", f"cap {i}")]) for i in range(3)], io.CONVERSATION_SCHEMA
    )
    out_dir = os.path.join(tmp_dir, "out")
    staged = spark.createDataFrame(
        [("000000000", "cap 0", "0 cap", None)], "id string, caption string, translation string, error string"
    )
    staged.write.parquet(os.path.join(out_dir, "translations", "run-crashed"))
    calls = os.path.join(tmp_dir, "calls")
    os.makedirs(calls)
    res = PL.translate_pipeline(spark, conv, CountingTranslator(calls), out_dir)
    assert called_messages(calls) == ["cap 1", "cap 2"]
    assert sorted(r[0] for r in res.audit_log.collect()) == ["000000000", "000000001", "000000002"]


def test_null_text_is_never_sent(spark):
    df = spark.createDataFrame([("1", None), ("2", "a b")], "id string, t string")
    got = {r["id"]: r for r in TR.translate_column(df, "t", TR.ReverseWords(), keep=["id"]).collect()}
    assert (got["1"]["t"], got["1"]["translation"], got["1"]["error"]) == (None, None, "No text")
    assert (got["2"]["translation"], got["2"]["error"]) == ("b a", None)


def test_back_translation_takes_both_codes_of_japanese(spark):
    df = spark.createDataFrame([(0, "ja", "a b"), (1, "JP", "c d"), (2, "jp", "e f")], "row_idx long, language string, conversations string")
    got = {r["row_idx"]: r["back_translations"] for r in TR.back_translate(df, TR.ReverseWords(), keep=["row_idx"]).collect()}
    assert got == {0: "b a", 1: "d c", 2: "f e"}


def test_blank_prompts_of_any_white_space(spark):
    p = PM.prompts_from_rows(spark, [["\n", "p", "m"], ["French", "\n\t", "m"]])
    assert [r["validation_error"] for r in PM.check_prompts(p).orderBy("prompt_idx").collect()] == ["target_blank", "prompt_blank"]


def test_repeated_memory_entries_keep_rows(spark):
    df = spark.createDataFrame([("a",)], "t string")
    memory = spark.createDataFrame([("a", "French", "x"), ("a", "French", "y")], "sentence string, lang string, translation string")
    assert [r["translation"] for r in TR.memory_translate(df, memory, "t", "French").collect()] == ["x"]


def _nested(spark, *captions):
    return spark.createDataFrame(
        [(i, "img", [("human", "q")] + ([("gpt", c)] if c is not None else [])) for i, c in captions], io.CONVERSATION_SCHEMA
    )


def test_rows_sharing_an_id_keep_their_own_translation(spark, tmp_dir):
    calls = os.path.join(tmp_dir, "calls")
    os.makedirs(calls)
    data = _nested(spark, ("1", "a b"), ("1", "c d"), ("1", "c d"), ("2", None), ("3", "e f"))
    for _ in range(2):  # the second run calls nothing
        res = PL.translate_pipeline(spark, data, CountingTranslator(calls), os.path.join(tmp_dir, "out"))
        assert called_messages(calls) == ["a b", "c d", "e f"]
        got = sorted((r["id"], [t["value"] for t in r["conversations"]]) for r in res.output.collect())
        assert got == [("1", ["q", "b a"]), ("1", ["q", "d c"]), ("1", ["q", "d c"]), ("2", ["q"]), ("3", ["q", "f e"])]
        assert rows(res.audit_log) == [("1", "a b", "b a"), ("1", "c d", "d c"), ("3", "e f", "f e")]
        assert rows(res.errors) == [("2", "no caption")]
    assert res.output.columns == data.columns


def test_calls_after_an_aggregate_are_spread(spark, tmp_dir):
    calls = os.path.join(tmp_dir, "calls")
    os.makedirs(calls)
    turns = spark.createDataFrame([(str(i), 1, "gpt", f"w {i}") for i in range(40)], "id string, turn long, `from` string, value string")
    PL.translate_pipeline(spark, turns, CountingTranslator(calls), os.path.join(tmp_dir, "out"), nested=False, num_partitions=4, batch_size=100)
    assert len(called_messages(calls)) == 40 and len(os.listdir(calls)) == 4  # one call a task


def test_validation_stays_within_a_split(spark):
    ds = spark.createDataFrame(
        [("1", "en", 0, "one two", "train", 7), ("1", "fr", 1, "un deux", "train", 8), ("1", "fr", 2, "un", "test", 9), (None, "fr", 3, None, None, 10)],
        "id string, language string, row_idx long, conversations string, split string, extra int",
    )
    out = PL.validation_pipeline(ds, TR.ReverseWords(), do_repeated_tokens=False, do_back_translate_chrf=False)
    got = {r["extra"]: (r["split"], r["back_translations"], r["reference_text"]) for r in out.collect()}
    assert got == {8: ("train", "deux un", "one two"), 9: ("test", "un", "id_not_found"), 10: (None, "", "id_not_found")}


def test_failed_prompt_calls_are_reported(spark, tmp_dir):
    prompts = PM.prompts_from_rows(spark, [["French", "pre", "m"]])
    pairs = spark.createDataFrame([("one", "French", "un")], "sentence string, lang string, translation string")
    path = os.path.join(tmp_dir, "errors")
    rep = PL.prompt_eval_pipeline(prompts, pairs, TR.FailingTranslator(), os.path.join(tmp_dir, "reports"), error_path=path)
    assert rep.count() == 1
    found = spark.read.parquet(path).collect()
    assert [r["sentence"] for r in found] == ["one"] and found[0]["error"].startswith("call failed")
