"""Profiling a conversation set (A2, A3, A4, F6, J2/F7, O2) - the checks the
reference runs by hand over the raw set, as aggregates over flat turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe import constants as C
from babelframe.functions.text import strip_image_affix


def caption_metadata(turns: DataFrame, key: str = "id") -> DataFrame:
    """A metadata table ``(id, blip_caption)`` derived from the turns: the
    last caption of each conversation with newlines folded into spaces."""
    cap = F.when(F.col("from") == C.GPT, F.col("value"))
    return turns.groupBy(key).agg(
        F.replace(F.max_by(cap, F.when(F.col("from") == C.GPT, F.col("turn"))), F.lit("\n"), F.lit(" ")).alias("blip_caption")
    )


def _digest(text: F.Column) -> F.Column:
    """128 bits that stand for a text in distinct counts."""
    return F.unhex(F.md5(text))


def profile(turns: DataFrame, metadata: DataFrame | None = None, key: str = "id") -> DataFrame:
    """A3 counters in one row: conversations, turns, multi-turn
    conversations (F6), caption turns differing from the metadata (J2, F7),
    distinct instructions with and without the image affix (A4).

    A lazy plan with one scan of the turns. Every turn gives a few facts
    (what is counted, of which conversation or text), texts as digests; the
    facts are counted by key, and the keys by kind. Both levels combine
    within tasks, so a conversation or a text of any frequency costs a row a
    task. ``metadata`` has one row an id; captions of other ids are not
    compared. Without it a caption is compared with the conversation's
    last caption, its newlines folded: captions are counted by digest, and
    each digest also names the text that the last caption would ask for.
    """
    human, caption = F.col("from") == C.HUMAN, F.col("from") == C.GPT
    text, given = F.coalesce("value", F.lit("")), F.col("value").isNotNull()
    nothing = F.lit(None)

    def fact(kind: str, of=nothing, digest=nothing, turn=nothing, n=F.lit(1)):
        kinds = (F.lit(kind), "string", "kind"), (of, "string", "of"), (digest, "binary", "digest"), (turn, "long", "asked"), (n, "long", "n")
        return F.struct(*[c.cast(t).alias(name) for c, t, name in kinds])

    raw, whose = _digest(text), F.col(key)
    captioned = caption & whose.isNotNull()
    facts = [
        fact("turns", whose),
        F.when(human & given, fact("tagged", digest=raw)),
        F.when(human & given, fact("untagged", digest=_digest(strip_image_affix(text)))),
        F.when(captioned, fact("captions", whose, F.when(given, raw))),
    ]
    if metadata is None:
        folded = _digest(F.replace(text, F.lit("\n"), F.lit(" ")))
        facts.append(F.when(captioned, fact("captions", whose, F.when(given, folded), F.col("turn"), F.lit(0))))
    each = turns.select(F.explode(F.filter(F.array(*facts), lambda f: f.isNotNull())).alias("f")).select("f.*")
    if metadata is not None:
        told = F.when(F.col("blip_caption").isNotNull(), _digest(F.coalesce("blip_caption", F.lit(""))))
        each = each.unionByName(metadata.filter(whose.isNotNull()).select(fact("captions", whose, told, F.lit(1), F.lit(0)).alias("f")).select("f.*"))
    # captions, and the text that they are asked to equal, meet under one digest
    keys = each.groupBy("kind", "of", "digest").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    per = keys.groupBy("kind", "of").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("n"), F.max_by("n", "asked").alias("equal"))

    def total(kind: str, value) -> F.Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0)).cast("bigint")

    return per.agg(
        F.count_if(F.col("kind") == "turns").alias("n_conversations"),
        total("turns", F.col("n")).alias("n_turns"),
        F.count_if((F.col("kind") == "turns") & (F.col("n") > 2)).alias("n_multi_turn"),
        total("tagged", F.col("keys")).alias("n_instructions_tagged"),
        total("untagged", F.col("keys")).alias("n_instructions_untagged"),
        total("captions", F.col("n") - F.col("equal")).alias("n_caption_mismatch"),  # NULL: no metadata
    )


def distinct_instructions(turns: DataFrame) -> DataFrame:
    """A4 + O2: the set of human instructions without the image affix."""
    return turns.filter(F.col("from") == C.HUMAN).select(strip_image_affix("value").alias("instruction")).distinct()
