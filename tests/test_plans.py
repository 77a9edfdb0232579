"""Physical-plan properties that matter at scale (checked on the formatted
plan, before execution)."""

from __future__ import annotations

import contextlib
import io as _io
import re

import __spark_entry__ as E
from tests.conftest import SMOKE


def plan(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def hash_exchanges(p: str) -> list[str]:
    return re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", p)


def test_text_work_is_map_only(spark):
    for name in ["repeated_words", "readability", "strip_image_markup"]:
        p = plan(E.queries()[name](spark, SMOKE))
        assert not hash_exchanges(p), name
        assert "Window" not in p and "SortMergeJoin" not in p, name


def test_block_labels_prune_text_and_need_no_join(spark):
    p = plan(E.queries()["label_language_blocks"](spark, SMOKE))
    assert "ReadSchema: struct<doc_id:bigint>" in p
    assert "Join" not in p and "Window" not in p and not hash_exchanges(p)


def test_reference_join_pushes_filter_and_has_no_window(spark):
    p = plan(E.queries()["attach_reference_text"](spark, SMOKE))
    assert "Not(EqualTo(text,))" in p
    assert "Window" not in p


def test_turn_pairs_join_on_unique_key_not_window(spark):
    for name in ["sentence_bleu", "repeated_tokens", "chrf_flag"]:
        p = plan(E.queries()[name](spark, SMOKE))
        assert "Window" not in p, name
        for keys in hash_exchanges(p):
            assert "turn" in keys, (name, keys)  # never partitioned by conversation alone


def test_prompts_are_broadcast_not_shuffled_by_language(spark):
    p = plan(E.queries()["render_prompts"](spark, SMOKE))
    assert "BroadcastHashJoin" in p
    for keys in hash_exchanges(p):
        assert not keys.startswith("lang#"), keys


def test_conversation_aggregates_combine_map_side(spark):
    p = plan(E.queries()["extract_role_values"](spark, SMOKE))
    # a partial aggregate runs before the exchange on the conversation id
    assert p.count("Aggregate") >= 2 and "Window" not in p
