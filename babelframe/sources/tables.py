"""Reading the driver's parquet tables and shaping them into corpus inputs.

The conversation operators work on the flat turn-per-row layout
``(id, turn, from, value)``: every per-conversation question is an
aggregate with map-side combine (bounded state per key) or a join on a
unique key, so a conversation of any length never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from babelframe import constants as C


def load_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one driver table. ``spread``: see ``spread_rows``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_rows(df) if spread else df


def spread_rows(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Rebalance an under-partitioned scan before CPU-heavy per-row work.

    A small table stored as one parquet row group is read by a single task;
    per-row text work would then run on one core. When the scan yields fewer
    splits than the cluster's parallelism, rows are spread round-robin (a
    narrow, deterministic repartition). At scale the scan already has
    thousands of splits and this adds nothing.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a connect session)
        return df
    return df.repartition(target) if current < target else df


def padded_id(col) -> F.Column:
    """Ids are digit strings with leading zeros, 9 wide at least (D1); longer
    ones stay whole."""
    text = col.cast("string")
    return F.when(F.length(text) < 9, F.lpad(text, 9, "0")).otherwise(text)


def role_to_from(role) -> F.Column:
    """Driver roles user/assistant/system -> conversation roles human/gpt/system."""
    return F.when(role == "user", F.lit(C.HUMAN)).when(role == "assistant", F.lit(C.GPT)).otherwise(role)


def conversation_turns(
    spark: SparkSession, sf_dir: str, with_image_tag: bool = True, spread: bool = False
) -> DataFrame:
    """Flat turns ``(id, image, turn, from, value)`` from ``conversations``.

    Human turns carry the ``<image>`` tag as the reference data does: as a
    ``<image>\\n`` prefix when ``conv_id + turn`` is even, else as a
    ``\\n<image>`` suffix.
    """
    conv = load_table(spark, sf_dir, "conversations", spread=spread)
    cid = padded_id(F.col("conv_id"))
    frm = role_to_from(F.col("role"))
    value = F.col("text")
    if with_image_tag:
        value = (
            F.when(
                frm == C.HUMAN,
                F.when(
                    (F.col("conv_id") + F.col("turn")) % 2 == 0,
                    F.concat(F.lit(C.IMAGE_TAG + "\n"), F.col("text")),
                ).otherwise(F.concat(F.col("text"), F.lit("\n" + C.IMAGE_TAG))),
            ).otherwise(F.col("text"))
        )
    return conv.select(
        cid.alias("id"),
        F.concat(F.substring(cid, 1, 5), F.lit("/"), cid, F.lit(".jpg")).alias("image"),
        F.col("conv_id"),
        F.col("turn"),
        frm.alias("from"),
        value.alias("value"),
    )


def documents(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """``spread=True`` for queries doing heavy per-row work right after the
    scan (see ``spread_rows``)."""
    return load_table(spark, sf_dir, "documents", spread=spread)
