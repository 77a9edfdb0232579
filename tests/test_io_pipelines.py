"""Sources/sinks S1-S11 round trips (D1, D2) and pipelines X2-X5."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from babelframe import constants as C
from babelframe.operators import translate as TR
from babelframe.plans import pipelines as PL
from babelframe.sources import io
from babelframe.sources.tables import conversation_turns
from tests.conftest import SMOKE, rows


def test_read_conversations_ids_stay_strings(spark, tmp_dir):
    path = os.path.join(tmp_dir, "conv.json")
    data = [
        {"id": "002718281", "image": "00271/002718281.jpg", "conversations": [{"from": "human", "value": "Say.\n<image>"}, {"from": "gpt", "value": "a kite"}]},
        {"id": "000000012", "image": "00000/000000012.jpg", "conversations": [{"from": "human", "value": "<image>\nSay."}, {"from": "gpt", "value": "b"}]},
    ]
    with open(path, "w") as f:
        json.dump(data, f, indent=2)
    df = io.read_conversations(spark, path)
    assert sorted(r["id"] for r in df.collect()) == ["000000012", "002718281"]
    assert dict(df.dtypes)["id"] == "string"


def test_read_metadata(spark, tmp_dir):
    path = os.path.join(tmp_dir, "meta.json")
    with open(path, "w") as f:
        json.dump([{"id": "000000007", "blip_caption": "a kite", "extra": 1}], f)
    assert [tuple(r) for r in io.read_metadata(spark, path).collect()] == [("000000007", "a kite")]


def test_parallel_csv_doubled_quotes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p.csv")
    header = ",".join([C.PARALLEL_ENGLISH_COLUMN] + [n + C.PARALLEL_SUFFIX for n in C.PARALLEL_LANGUAGES])
    row = ",".join(['"a ""b"" c, d"'] + ["x"] * 7)
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + row + "\n")
    df = io.read_parallel_csv(spark, path)
    r = df.first()
    assert r[C.PARALLEL_ENGLISH_COLUMN] == 'a "b" c, d' and r["Japanese Translation"] == "x"


def test_audit_log_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    df = spark.createDataFrame([("001", ' "q", x\n', "  lead")], "ID string, `GPT Value Original` string, `GPT Value Modified` string")
    io.write_audit_log(df, path)
    io.write_audit_log(df, path)
    back = io.read_audit_log(spark, path).collect()
    assert len(back) == 2 and tuple(back[0]) == ("001", ' "q", x\n', "  lead")


def test_publish_and_read_dataset(spark, tmp_dir):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "x int, split string")
    base = io.publish_dataset(df, tmp_dir, "owner", "name")
    assert base.endswith("owner/name")
    assert sorted(r["split"] for r in io.read_dataset(spark, base).collect()) == ["test", "train"]


def test_validation_pipeline_per_row(spark):
    df = spark.createDataFrame(
        [(0, "1", "en", "a red kite"), (1, "1", "fr", "un cerf-volant rouge rouge"), (2, "2", "fr", "bleu")],
        "row_idx long, id string, language string, conversations string",
    )
    out = {r["row_idx"]: r for r in PL.validation_pipeline(df, TR.ReverseWords(), keys=["row_idx"]).collect()}
    assert set(out) == {1, 2}
    assert out[1]["reference_text"] == "a red kite" and out[1]["repeated_tokens"] is True
    assert out[2]["reference_text"] == "id_not_found"
    assert 0.0 <= out[1]["back_translate_chrf"] <= 100.0


def test_curation_pipeline_writes_one_column(spark, tmp_dir):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    path = os.path.join(tmp_dir, "sample")
    out = PL.curation_pipeline(docs, "text", "doc_id", path, n_samples=12, n_bins=3)
    assert out.count() == 12
    back = io.read_sample_csv(spark, "text", path)
    assert back.columns == ["text"] and back.count() == 12
    assert sorted(r[0] for r in back.collect()) == sorted(r["text"] for r in out.collect())
    cx = [r["complexity"] for r in out.collect()]
    assert cx == sorted(cx)


def test_prompt_eval_reports(spark, tmp_dir):
    from babelframe.operators import prompts as PM

    pairs = spark.createDataFrame([("0", "a b c d", "Hindi", "d c b a :Input"), ("1", "x y", "French", "y")], "id string, sentence string, lang string, translation string")
    prompts = PM.prompts_from_rows(spark, [["hindi", "pre", "{message}"]])
    rep = PL.prompt_eval_pipeline(prompts, pairs, TR.ReverseWords(), os.path.join(tmp_dir, "rep"))
    r = rep.collect()
    assert len(r) == 1 and r[0]["Model_output"] == "d c b a Input:" and r[0]["lang"] == "Hindi"
    assert os.path.isdir(os.path.join(tmp_dir, "rep", "prompt_idx=0", "lang=Hindi"))


def test_profile_pipeline_counts(spark):
    turns = conversation_turns(spark, SMOKE)
    out = PL.profile_pipeline(turns)
    c = out["counters"].first()
    assert c["n_conversations"] == 20 and c["n_turns"] == 87
    assert c["n_instructions_tagged"] >= c["n_instructions_untagged"]
    assert out["instructions"].count() == c["n_instructions_untagged"]
    assert rows(out["instructions"].filter(F.col("instruction").contains("<image>"))) == []


def test_publish_private_dataset(spark, tmp_dir):
    df = spark.createDataFrame([(1, "train")], "x int, split string")
    base = io.publish_dataset(df, tmp_dir, "owner", "name", private=True)
    assert "/.private/owner/name" in base and io.read_dataset(spark, base).count() == 1


def test_csv_tells_empty_from_missing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    log = spark.createDataFrame([("1", "", None), ("2", None, ""), ("3", " x ", 'a "b", c')], io.AUDIT_SCHEMA)
    io.write_audit_log(log, path)
    assert sorted(tuple(r) for r in io.read_audit_log(spark, path).collect()) == sorted(tuple(r) for r in log.collect())


def test_one_split_again_leaves_the_others(spark, tmp_dir):
    """validate_dataset: resumed by split, and a split run again rewrites its
    own files only; turns and flat text alike."""
    turns = [("human", "q")]
    rows = [(s, i, [*turns, ("gpt", f"{s} word {i}")]) for s in ("test", "train", None) for i in range(16)]
    ds = spark.createDataFrame(rows, "split string, row_idx long, conversations array<struct<`from`: string, value: string>>")
    io.save_dataset(ds, os.path.join(tmp_dir, "in"))
    out = os.path.join(tmp_dir, "out")

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(os.path.join(out, "data")) for f in fs if f.endswith(".parquet")}

    PL.validate_dataset(spark, os.path.join(tmp_dir, "in"), out, TR.ReverseWords(), splits=["test"])
    first = files()
    res = PL.validate_dataset(spark, os.path.join(tmp_dir, "in"), out, TR.FailingTranslator(), splits=["test"])
    assert files() == first  # committed: not run again
    res = PL.validate_dataset(spark, os.path.join(tmp_dir, "in"), out, TR.ReverseWords())
    assert first.items() <= files().items()
    assert sorted((r["split"] or "", r["n"]) for r in res.groupBy("split").agg({"*": "count"}).toDF("split", "n").collect()) == [("", 14), ("test", 14), ("train", 14)]
    before = files()
    PL.validate_dataset(spark, os.path.join(tmp_dir, "in"), out, TR.ReverseWords(), splits=["train"], again=True)
    after = files()
    assert {f for f in before if "split=train" not in f} == {f for f in after if "split=train" not in f and after[f] == before.get(f)}
    assert not {f for f in before if "split=train" in f} & set(after)


def test_prompt_lists_of_any_length(spark, tmp_dir):
    from babelframe.operators import prompts as PM

    path = os.path.join(tmp_dir, "prompts.json")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(["French", "p", f"m{i}"]) + ("\n  " if i % 7 == 0 else "") for i in range(10_500)))
    got = PM.read_prompt_list(spark, path).orderBy("prompt_idx").collect()
    assert [(r["prompt_idx"], r["message"]) for r in got] == [(i, f"m{i}") for i in range(10_500)]


def test_profile_is_one_lazy_scan(spark, tmp_dir):
    from babelframe.operators import profile as PR

    turns = [("1", 0, "human", "<image>\na"), ("1", 1, "gpt", "x\ny"), ("1", 2, "human", "a\n<image>"), ("1", 3, "gpt", "x y"), ("2", 0, "gpt", None), ("3", 0, "human", "b")]
    path = os.path.join(tmp_dir, "turns")
    spark.createDataFrame(turns, "id string, turn long, `from` string, value string").write.parquet(path)
    out = PR.profile(spark.read.parquet(path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert out.first().asDict() == {
        "n_conversations": 3, "n_turns": 6, "n_multi_turn": 1, "n_instructions_tagged": 3, "n_instructions_untagged": 2, "n_caption_mismatch": 1,
    }
    meta = spark.createDataFrame([("1", "x y"), ("9", "z")], "id string, blip_caption string")
    assert PR.profile(spark.read.parquet(path), meta).first()["n_caption_mismatch"] == 1
