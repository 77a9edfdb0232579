"""Registered queries of this subpackage: thin views of its operators over
the given tables, whole and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from babelframe.llm import languages, minhash, negatives, neighbours, packing, pieces, quality, resample, secrets, subspaces, suffixes, topk, toxicity
from babelframe.llm.common import fold, table


def vocabulary_path(name: str) -> str:
    """Where the installed public vocabulary file ``name`` is."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's best segmentations, digested; each one is decoded and
    compared with the text."""
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.read_vocabulary(vocabulary_path("piece_bpe_32k.model")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE]
    own = F.filter("findings", lambda x: secrets.kind(x["rule"]).isin(base))

    def of(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: secrets.kind(x["rule"]) == kind)).cast("long")

    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in base],
        F.sha2(secrets.span_list(own), 256).alias("base_sha256"),
        secrets.span_list("findings").alias("spans"),
    )


def op4_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.filter("vec_id % 50 = 0"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    net = quality.learn(docs.filter(fold("doc_id", 3) != 1).join(labels, "doc_id"))
    return _labelled(quality.score(docs, net), 3, 1, 0.5)


def op7_toxicity_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.source_model(docs)
    fitted = toxicity.learn(docs.filter(fold("doc_id", 4) != 2).join(labels, "doc_id"), model)
    return _labelled(toxicity.score(docs, model, fitted), 4, 2, 0.3)


def _labelled(scored: DataFrame, modulus: int, held: int, least: float) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", modulus) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.filter("vec_id % 20 = 0"))


def op9_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = languages.learn(docs.filter(fold("doc_id", 5) != 0))
    return languages.identify(docs, prototypes).select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_subspace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspaces.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", noisy), F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece_nbest,
        op2_best_fit_packing,
        op3_secret_scan,
        op4_learned_partitions,
        op5_suffix_dedup,
        op6_quality_cnn,
        op7_toxicity_channel,
        op8_pivot_topk,
        op9_language_profiles,
        op10_minhash,
        op11_subspace_dedup,
        op12_importance_resampling,
        op13_hard_negatives,
    )
}
