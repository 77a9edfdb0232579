"""End-to-end jobs (X1-X5) composed from the operators.

Each paid step (translation) is written once to the shared work folder and
read back before anything uses it twice, so a retried or re-planned stage
never calls the translator again for rows already done.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from babelframe import constants as C
from babelframe.functions import text as X
from babelframe.functions import turns as FT
from babelframe.operators import assemble as AS
from babelframe.operators import degenerate as DG
from babelframe.operators import metrics as ME
from babelframe.operators import profile as PR
from babelframe.operators import prompts as PM
from babelframe.operators import sampling as SA
from babelframe.operators import translate as TR
from babelframe.operators import turns as TU
from babelframe.session import configured, stage, work_path
from babelframe.sources import io
from babelframe.sources.runs import Runs, present


#: Bytes of an Arrow batch where a task has two Python workers, for calls and
#: scores; only memory depends on it.
BATCH_BYTES = 8 << 20


def _staged_successes(spark: SparkSession, root: str) -> DataFrame | None:
    """Successful translations staged by earlier runs under ``root``, also by
    runs that were stopped: each row is a paid result of its own."""
    staged = present(lambda: spark.read.parquet(f"{root}/*"))
    return None if staged is None else staged.filter(F.col("error").isNull()).select("id", "caption", "translation")


def audit_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """The log rows of all committed runs of X1 under ``out_dir``."""
    runs = Runs(spark, out_dir)
    return runs.read("audit_log", runs.committed(), io.AUDIT_SCHEMA, lambda paths: io.read_audit_log(spark, paths))


@dataclass
class TranslateResult:
    translations: DataFrame  # (id, caption, translation, error), persisted
    output: DataFrame  # conversations with caption turns replaced
    audit_log: DataFrame  # read back from the CSV log
    errors: DataFrame  # (id, error) - F8
    run: str  # name of the run
    counts: dict[str, int]  # n_rows called, n_failed (A2, A10)


# ------------------------------------------------------------------ X1 / K1
def translate_pipeline(
    spark: SparkSession,
    data: DataFrame,
    factory: TR.TranslatorFactory,
    out_dir: str,
    *,
    nested: bool = True,
    template: str = "{message}",
    resume: bool = True,
    batch_size: int = C.TRANSLATE_BATCH_SIZE,
    calls_per_minute: float | None = None,
    num_partitions: int | None = None,
    max_in_flight: int = 1,
) -> TranslateResult:
    """P2 -> P13 -> U1 -> P15 -> P4, written as S6 (all rows), S7 (audit
    log of successes, appended) and an error table (F8).

    ``nested``: ``data`` has ``(id, image, conversations)`` rows, whose ids
    may repeat; else flat turns ``(id, turn, from, value)``, one conversation
    per id. A translation belongs to (id, caption), so rows that share an id
    keep their own. Conversations without a caption go to the error table.
    Every run writes folders of its own and is committed last (``Runs``): a
    run stopped in between leaves no log row, and what it paid for is used by
    the next one.
    ``resume``: captions in the log of a committed run, or staged as
    successes by any earlier run, are not called again (K1, left anti joins);
    staged successes missing from the log are logged.
    ``num_partitions``: calling tasks (default: the cluster's parallelism).
    """
    runs = Runs(spark, out_dir)
    run = f"run-{uuid.uuid4().hex[:12]}"
    staged_root = f"{out_dir}/translations"
    key = ["id", "caption"]
    if nested:
        captions = data.select("id", FT.first_value_of_role("conversations", C.GPT).alias("caption"))
    else:
        captions = TU.first_role_value(data, C.GPT).select("id", "caption")
    logged = audit_log(spark, out_dir).toDF("id", "caption", "translation")
    done = logged if resume else None
    # successes staged by earlier runs (logged or not: a run may have stopped
    # between staging and appending to the log)
    earlier = _staged_successes(spark, staged_root) if resume else None
    todo = captions.filter(F.col("caption").isNotNull())
    if nested:
        todo = todo.dropDuplicates(key)
    if done is not None:
        todo = todo.join(done, key, "left_anti")
    if earlier is not None:
        todo = todo.join(earlier, key, "left_anti")
    todo = todo.withColumn("message", X.render_template(template, F.col("caption")))
    called = TR.translate_column(
        todo,
        "message",
        factory,
        keep=["id", "caption"],
        batch_size=batch_size,
        calls_per_minute=calls_per_minute,
        num_partitions=num_partitions,
        max_in_flight=max_in_flight,
    ).drop("message")
    observed = Observation()
    translations = TR.persist_translations(called, f"{staged_root}/{run}", observed)
    made = translations.filter(F.col("error").isNull()).select("id", "caption", "translation")
    if earlier is not None:
        made = made.unionByName(earlier)
    ok = made.join(done, key, "left_anti") if done is not None else made
    ok = ok.dropDuplicates(key)
    io.write_audit_log(
        ok.select(
            F.col("id").alias("ID"),
            F.col("caption").alias("GPT Value Original"),
            F.col("translation").alias("GPT Value Modified"),
        ),
        runs.path("audit_log", run),
        mode="overwrite",
    )
    # every translation known now: logged earlier or made in this run
    known = made.unionByName(logged).dropDuplicates(key)
    if nested:
        mine = known.select("id", F.col("caption").alias("__caption"), F.col("translation").alias("__new"))
        out = (
            data.withColumn("__caption", FT.first_value_of_role("conversations", C.GPT))
            .join(mine, ["id", "__caption"], "left")
            .withColumn(
                "conversations",
                F.when(
                    F.col("__new").isNotNull(), FT.replace_role_values("conversations", C.GPT, F.col("__new"))
                ).otherwise(F.col("conversations")),
            )
            .select(*data.columns)
        )
    else:
        out = TU.replace_role_turns(data, captions.join(known, key), C.GPT)
    io.write_conversations(out, runs.path("conversations", run))
    uncalled = captions.filter(F.col("caption").isNull()).select("id", F.lit("no caption").alias("error"))
    TR.failures(translations, "id", "error").unionByName(uncalled).write.mode("overwrite").parquet(runs.path("errors", run))
    runs.commit(run)
    return TranslateResult(
        translations,
        spark.read.schema(out.schema).json(runs.path("conversations", run)),
        audit_log(spark, out_dir),
        spark.read.parquet(runs.path("errors", run)),
        run,
        observed.get,
    )


# ---------------------------------------------------------------------- X2
def validation_pipeline(
    ds: DataFrame,
    factory: TR.TranslatorFactory,
    *,
    keys: list[str] | None = None,
    do_repeated_tokens: bool = True,
    do_back_translate_chrf: bool = True,
    chrf_threshold: float = C.CHRF_FLAG_THRESHOLD,
    languages: list[str] | None = None,
    batch_size: int = C.BACK_TRANSLATE_CHUNK,
    calls_per_minute: float | None = None,
    num_partitions: int | None = None,
    max_in_flight: int = 1,
    reference_col: str = "reference_text",
    prediction_col: str = "conversations",
    back_translation_col: str = "back_translations",
) -> DataFrame:
    """X2 (J-B): ``ds`` has ``id``, ``language``, ``row_idx`` and
    ``prediction_col`` (flattened text, P3). Back-translation (U2) runs when
    its column is absent (F9) and is staged as a table (S8); then the English
    reference (J1), English rows dropped (F2), metrics as columns on each row
    (M5, M7, F5) - per split when a ``split`` column is present (D13).
    ``keys``: columns to carry besides those named here (default: all)."""
    spark = ds.sparkSession
    splits = [c for c in ("split",) if TR.has_column(ds, c)]
    if not TR.has_column(ds, back_translation_col):
        keep = ds.columns if keys is None else [*keys, "id", "row_idx", prediction_col, *splits]
        bt = TR.back_translate(
            ds,
            factory,
            keep=list(dict.fromkeys(keep)),
            text_col=prediction_col,
            languages=languages,
            batch_size=batch_size,
            calls_per_minute=calls_per_minute,
            num_partitions=num_partitions,
            max_in_flight=max_in_flight,
            out_col=back_translation_col,
        )
        ds = TR.persist_translations(bt, work_path(spark, "back-translations"))
    ref = AS.attach_reference_text(ds, "id", "language", prediction_col, "row_idx", reference_col, within=splits)
    out = AS.drop_language(ref, "en")
    if do_repeated_tokens:
        out = out.withColumn("repeated_tokens", ME.repeated_tokens(prediction_col, reference_col))
    if do_back_translate_chrf:
        out = ME.sentence_chrf(out, back_translation_col, reference_col, "back_translate_chrf")
        out = out.withColumn("back_translate_chrf_int", ME.chrf_flag("back_translate_chrf", chrf_threshold))
    return out


def validate_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    factory: TR.TranslatorFactory,
    *,
    splits: list[str | None] | None = None,
    again: bool = False,
    conversation_col: str = "conversations",
    row_idx: str = "row_idx",
    **options,
) -> DataFrame:
    """X2 from a stored dataset to a stored result, split by split.

    The dataset (S4) has ``split`` partitions (rows without a split are one
    as well), rows numbered within their split by ``row_idx``, and
    conversations as turns or as flat text. Per split: language by block (P8,
    sized by the split's own rows), flattening (P3), then the validation job.
    The result is written to ``target/data`` (S8) by overwriting only the
    split's partition, and the split is committed last: a job that stops goes
    on with the splits it has not committed, and running one split again
    (``splits``, ``again``) leaves the files of the others as they are.
    ``options``: those of ``validation_pipeline``, whose result it returns
    for all committed splits.
    """
    runs = Runs(spark, target)
    ds = io.read_dataset(spark, source)
    there = [r["split"] for r in ds.select("split").distinct().collect()]  # a handful
    done = set() if again else set(runs.committed())
    prediction = options.get("prediction_col", "conversations")
    for split in sorted(there if splits is None else [s for s in splits if s in there], key=lambda s: (s is None, s)):
        name = "split-none" if split is None else f"split={split}"
        if name in done:
            continue
        part = ds.filter(F.col("split").eqNullSafe(F.lit(split)))
        labelled = AS.label_language_blocks(part, row_idx, by=["split"]).withColumn("row_idx", F.col(row_idx))
        flat = F.col(conversation_col)
        if isinstance(part.schema[conversation_col].dataType, ArrayType):
            flat = FT.last_turn_value(conversation_col)
        scored = validation_pipeline(labelled.withColumn(prediction, flat), factory, **options)
        write = scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split")
        write.parquet(f"{target}/data")
        runs.commit(name)
    return io.read_dataset(spark, f"{target}/data")


# ---------------------------------------------------------------------- X3
def prompt_eval_pipeline(
    prompts: DataFrame,
    pairs: DataFrame,
    factory: TR.TranslatorFactory,
    out_path: str,
    *,
    error_path: str | None = None,
    batch_size: int = C.TRANSLATE_BATCH_SIZE,
    calls_per_minute: float | None = None,
    num_partitions: int | None = None,
    max_in_flight: int = 1,
    dealt: bool = False,
) -> DataFrame:
    """X3 (J-C): prompts x pairs of their language (J4), each English
    sentence sent as ``Input: <text>`` with the prompt's preamble (U3; the
    prompt's own message is not used), BLEU of the output against the
    ground truth (M6), all reports in one partitioned write (S10). Failed
    calls are reported with an empty output; ``error_path`` takes their
    (prompt_idx, lang, sentence, error) rows (F8).

    The prompts are staged, so that the planner knows their size and
    broadcasts a list that is not long. ``dealt``: ``pairs`` lie in as many
    partitions as there are calling tasks or more; no text is shuffled then."""
    spark = prompts.sparkSession
    prompts = stage(prompts, "prompts", spread=False)
    joined = PM.prompts_for_pairs(prompts, pairs, "lang").withColumn("__msg", X.input_message("sentence"))
    called = TR.translate_column(
        joined,
        "__msg",
        factory,
        keep=["prompt_idx", "lang", "sentence", "translation"],
        preamble_col="preamble",
        clean=False,
        out_col="Model_output",
        error_col="error",
        batch_size=batch_size,
        calls_per_minute=calls_per_minute,
        num_partitions=num_partitions,
        max_in_flight=max_in_flight,
        dealt=dealt,
    )
    with configured(spark, execution__arrow__maxBytesPerBatch=str(BATCH_BYTES)):
        if error_path:
            called = TR.persist_translations(called, work_path(spark, "prompt-outputs"))
            TR.failures(called, ["prompt_idx", "lang", "sentence"]).write.mode("overwrite").parquet(error_path)
        report = called.select(
            "prompt_idx",
            "lang",
            F.col("sentence").alias("English"),
            F.col("translation").alias("Ground_truth"),
            F.coalesce(F.col("Model_output"), F.lit("")).alias("Model_output"),
        )
        report = ME.sentence_bleu(report, "Model_output", "Ground_truth", "Bleu_score")
        io.write_reports(report, out_path)
    return io.read_reports(spark, out_path)


# ---------------------------------------------------------------------- X4
def curation_pipeline(
    data: DataFrame, text_col: str, id_col: str, out_path: str | None = None, n_samples: int = 30, n_bins: int = 5
) -> DataFrame:
    """X4 (J-D): readability, length and the degenerate flag are computed in
    one pass into a narrow staged table; complexity is min-max normalised
    over all rows (A6) before degenerate texts are dropped (F4); the exact
    stratified sample is drawn from the narrow table, its text fetched by a
    join of the stored sample, sorted by complexity (L1) and written as
    a one-file CSV (S11)."""
    _, _, degenerate = DG.repeat_stats(text_col)
    scored = ME.add_readability(data.select(id_col, text_col), text_col).withColumn("__degenerate", degenerate)
    scored = scored.withColumn(SA.TEXT_MARK, F.xxhash64(text_col))
    cx = ME.add_complexity(scored.drop(text_col), keep=None, staged=True)
    kept = cx.filter(~F.col("__degenerate"))
    sample = SA.sample_rows(kept, id_col, n_samples=n_samples, n_bins=n_bins)
    out = SA.attach_text(sample, data, id_col, text_col).select(id_col, text_col, *C.SAMPLE_COLUMNS).orderBy(
        "complexity", id_col
    )
    if out_path:
        io.write_sample_csv(out, text_col, out_path)
    return out


# ---------------------------------------------------------------------- X5
def profile_pipeline(turns: DataFrame, metadata: DataFrame | None = None) -> dict[str, DataFrame]:
    """Counters (A2, A3, F6, J2/F7) and the distinct instruction set (A4)."""
    return {
        "counters": PR.profile(turns, metadata),
        "instructions": PR.distinct_instructions(turns),
    }
