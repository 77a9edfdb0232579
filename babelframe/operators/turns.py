"""Conversation operators on DataFrames.

Two layouts are supported:

* nested rows ``(id, image, conversations: array<struct<from,value>>)`` as
  read from JSON (S1) - handled per row by ``babelframe.functions.turns``;
* flat turns ``(id, turn, from, value)`` - per-conversation questions are
  aggregates (``max_by``/``min_by`` with map-side partial aggregation, so
  the state per key is one value however long the conversation is).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe import constants as C
from babelframe.functions import turns as T


# ---------------------------------------------------------------- nested form
def extract_values(df: DataFrame, conv_col: str = "conversations") -> DataFrame:
    """P1 on nested rows: add ``human_value`` and ``gpt_value``."""
    return df.withColumn("human_value", T.last_value_of_role(conv_col, C.HUMAN)).withColumn(
        "gpt_value", T.last_value_of_role(conv_col, C.GPT)
    )


def flatten_conversations(df: DataFrame, conv_col: str = "conversations") -> DataFrame:
    """P3 on nested rows: the column becomes the last turn's value (string)."""
    return df.withColumn(conv_col, T.last_turn_value(conv_col))


def explode_turns(df: DataFrame, conv_col: str = "conversations", key: str = "id") -> DataFrame:
    """P5: one row per turn, keeping its position -> ``(key, turn, from, value)``."""
    return df.select(key, F.posexplode(conv_col).alias("turn", "t")).select(
        key, F.col("turn").cast("bigint").alias("turn"), F.col("t.from").alias("from"), F.col("t.value").alias("value")
    )


# ------------------------------------------------------------------ flat form
def _of_role(role: str, col: str) -> F.Column:
    return F.when(F.col("from") == role, F.col(col))


def role_values(turns: DataFrame, key: str = "id", order: str = "turn") -> DataFrame:
    """P1 on flat turns: last human and last gpt value per conversation."""
    return turns.groupBy(key).agg(
        F.coalesce(F.max_by(_of_role(C.HUMAN, "value"), _of_role(C.HUMAN, order)), F.lit("")).alias("human_value"),
        F.coalesce(F.max_by(_of_role(C.GPT, "value"), _of_role(C.GPT, order)), F.lit("")).alias("gpt_value"),
    )


def first_role_value(
    turns: DataFrame, role: str = C.GPT, key: str = "id", order: str = "turn", out: str = "caption"
) -> DataFrame:
    """P2 on flat turns: first turn of ``role``; none -> NULL plus an error."""
    return (
        turns.groupBy(key)
        .agg(
            F.min_by(_of_role(role, "value"), _of_role(role, order)).alias(out),
            F.count(_of_role(role, order)).alias(f"n_{role}_turns"),
        )
        .withColumn(
            "error",
            F.when(F.col(f"n_{role}_turns") == 0, F.lit(f"no '{role}' turn")),
        )
    )


def last_turn(turns: DataFrame, key: str = "id", order: str = "turn", out: str = "conversations") -> DataFrame:
    """P3 on flat turns: value of the last turn of any role."""
    return turns.groupBy(key).agg(F.max_by("value", order).alias(out))


def replace_role_turns(
    turns: DataFrame, replacements: DataFrame, role: str = C.GPT, key: str = "id", new_col: str = "translation"
) -> DataFrame:
    """P4 on flat turns: every ``role`` turn of a conversation takes the
    conversation's replacement (a row per key in ``replacements``); keys with
    no replacement keep their text.

    The join is on the conversation key; the replacement side has one row
    per key, so a very long conversation is a skewed key on one side only,
    which AQE's skew-join splitting handles.
    """
    rep = replacements.select(F.col(key), F.col(new_col).alias("__new"))
    joined = turns.join(rep, on=key, how="left")
    return joined.withColumn(
        "value", F.when((F.col("from") == role) & F.col("__new").isNotNull(), F.col("__new")).otherwise(F.col("value"))
    ).drop("__new")


def turn_counts(turns: DataFrame, key: str = "id") -> DataFrame:
    """Turns per conversation and the multi-turn flag."""
    return turns.groupBy(key).agg(F.count(F.lit(1)).alias("n_turns")).withColumn("multi_turn", F.col("n_turns") > 2)
