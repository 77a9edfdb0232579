"""The corpus pipeline: raw documents to packed token sequences.

Stages, in order: language identification (rows without a known language
go), MinHash near-duplicates (one document of each group stays), repeated
passages (all but the first occurrence are cut), secrets (redacted), best-fit
packing. Each stage gets the rows its predecessor kept, written as Parquet
and read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from babelframe.llm import languages, minhash, packing, secrets, suffixes
from babelframe.llm.common import fold, staged, table
from babelframe.llm.queries import vocabulary_path

#: Lowest cosine with a language's profile that counts as known: 4.5 standard
#: deviations of a text of unlearned letters in languages.WIDE dimensions.
LEAST_COSINE = 0.025
#: Near-duplicates: five-word shingles, similarity 0.8.
SHINGLE, SIMILARITY = 5, 80


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prototypes = languages.learn_wide(docs.filter(fold("doc_id", 5) != 0))
    return languages.keep_known(docs, prototypes, LEAST_COSINE)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``: its doc_id, or, for rows without one and for
    the further texts of a doc_id, a hash above 2**62 of the id and the text,
    so that each (id, text) is a document and those with an id come first."""
    digest = F.sha2("text", 256)
    own = (F.xxhash64(F.col("doc_id"), F.coalesce(digest, F.lit(""))).bitwiseAND((1 << 61) - 1) + F.lit(1 << 62)).cast("long")
    texts = F.coalesce(digest, F.lit(""))
    several = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.min(texts).alias("__first"), F.max(texts).alias("__last"))
    several = staged(several.filter("__first < __last").select("__id", "__first"), "several")
    if several.isEmpty():
        return docs.withColumn("__row", F.coalesce(F.col("doc_id").cast("long"), own))
    further = F.col("doc_id").isNull() | (texts > F.col("__first"))
    keyed = docs.join(several, F.col("doc_id") == F.col("__id"), "left")
    return keyed.withColumn("__row", F.when(further, own).otherwise(F.col("doc_id").cast("long"))).drop("__id", "__first")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    found = minhash.near_duplicates(keyed, id_col="__row", similarity=SIMILARITY, shingle=SHINGLE)
    return minhash.keep_one(keyed, found, id_col="__row").drop("__row")


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages but for their first document; a document of
    which a cut leaves nothing goes."""
    keyed = _keyed(docs).withColumn("__empty", F.col("text") == "")
    cut = suffixes.cut_passages(keyed, suffixes.repeated_passages(keyed, id_col="__row", later_only=True), id_col="__row")
    return _counted(cut.filter("text IS NULL OR text <> '' OR __empty").drop("__row", "__empty"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the language and packing stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
