"""K1: incremental translation as Structured Streaming jobs.

``stream_translate`` translates every caption turn: a file source picks up
new input files, the translation is a stateless ``mapInArrow`` projection
and the parquet sink's checkpoint records which files are done.

``translate_first_captions`` does what the batch job X1 does, file by file:
one translation a conversation, of its *first* caption, with the log S7. The
turns of a conversation may arrive in different files and in any order, so
the smallest caption turn seen is kept as keyed state (an aggregate, combined
within tasks before it meets the state). Whenever a conversation is touched,
its first caption comes out; captions translated already are dropped, the
others are called. A later file with an earlier turn thus replaces the
conversation's translation and its log row.

The sink writes each micro-batch into folders of the batch's own number and
commits the number last (``sources.runs``). A batch that is replayed after a
crash writes the same folders again and adds no row; if its translations were
complete, it calls nothing again. Readers see committed batches only.

With ``availableNow`` the jobs drain what is there and stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from babelframe import constants as C
from babelframe.operators import translate as TR
from babelframe.operators import turns as TU
from babelframe.sources import io
from babelframe.sources.runs import Runs
from babelframe.sources.tables import padded_id, role_to_from

CONVERSATION_ROWS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


TRANSLATIONS = "id string, turn long, original string, translation string, error string"


def caption_turn_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Caption turns of flat conversation rows arriving as parquet files, all
    new files in one batch unless the caller sets a limit."""
    reader = spark.readStream.schema(CONVERSATION_ROWS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source).select(
        padded_id(F.col("conv_id")).alias("id"),
        F.col("turn"),
        role_to_from(F.col("role")).alias("from"),
        F.col("text").alias("original"),
    ).filter(F.col("from") == C.GPT)


def stream_translate(
    spark: SparkSession,
    source: str,
    factory: TR.TranslatorFactory,
    sink: str,
    checkpoint: str,
    *,
    max_files_per_trigger: int | None = None,
    batch_size: int = C.TRANSLATE_BATCH_SIZE,
    calls_per_minute: float | None = None,
) -> DataFrame:
    """Translate every caption turn arriving under ``source`` into a parquet
    sink; returns the sink read as a batch table once the stream is drained."""
    turns = caption_turn_stream(spark, source, max_files_per_trigger)
    translated = TR.translate_column(
        turns, "original", factory, keep=["id", "turn"], batch_size=batch_size, calls_per_minute=calls_per_minute
    )
    # the translated column replaced the message by its string form; keep the original text too
    out = translated.select("id", "turn", "original", "translation", "error")
    q = (
        out.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(sink)


# ------------------------------------------------- first captions, with a log
def _batch_name(batch_id: int) -> str:
    return f"batch-{batch_id:09d}"


def _translations(runs: Runs, names: list[str]) -> DataFrame:
    return runs.read("translations", names, TRANSLATIONS, lambda paths: runs.spark.read.schema(TRANSLATIONS).parquet(*paths))


def _commit_batch(runs: Runs, factory: TR.TranslatorFactory, **calls):
    """The ``foreachBatch`` function: translate, log, commit."""

    def run(firsts: DataFrame, batch_id: int) -> None:
        name = _batch_name(batch_id)
        # the batch's plan has to run once, in a replay too: it moves the state
        firsts.write.mode("overwrite").parquet(runs.path("firsts", name))
        firsts = runs.spark.read.schema(firsts.schema).parquet(runs.path("firsts", name))
        committed = runs.committed()
        if name in committed:
            return
        if name not in runs.marked("translated"):
            done = _translations(runs, committed).filter("error IS NULL").select("id", "turn", "original")
            todo = firsts.join(done.distinct(), ["id", "turn", "original"], "left_anti")
            made = TR.translate_column(todo, "original", factory, keep=["id", "turn"], **calls)
            made.select("id", "turn", "original", "translation", "error").write.mode("overwrite").parquet(runs.path("translations", name))
            runs.mark("translated", name)
        ok = _translations(runs, [name]).filter("error IS NULL")
        log = ok.select(F.col("id").alias("ID"), F.col("original").alias("GPT Value Original"), F.col("translation").alias("GPT Value Modified"))
        io.write_audit_log(log, runs.path("audit_log", name), mode="overwrite")
        runs.commit(name)

    return run


def translate_first_captions(
    spark: SparkSession,
    source: str,
    factory: TR.TranslatorFactory,
    sink: str,
    checkpoint: str,
    *,
    max_files_per_trigger: int | None = None,
    batch_size: int = C.TRANSLATE_BATCH_SIZE,
    calls_per_minute: float | None = None,
    num_partitions: int | None = None,
    max_in_flight: int = 1,
) -> Runs:
    """Translate the first caption of every conversation arriving under
    ``source``; returns the sink's runs (see ``first_captions``,
    ``first_caption_log`` and ``translated_turns``)."""
    turns = caption_turn_stream(spark, source, max_files_per_trigger)
    firsts = turns.groupBy("id").agg(F.min(F.struct("turn", "original")).alias("first"))
    runs = Runs(spark, sink)
    commit = _commit_batch(
        runs,
        factory,
        batch_size=batch_size,
        calls_per_minute=calls_per_minute,
        num_partitions=num_partitions,
        max_in_flight=max_in_flight,
    )
    q = (
        firsts.select("id", "first.turn", "first.original")
        .writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return runs


def first_captions(runs: Runs) -> DataFrame:
    """(id, turn, original, translation, error) of each conversation's first
    caption seen so far, from committed batches; a success goes before a
    failure of the same turn."""
    order = F.struct("turn", F.col("error").isNotNull())
    value = F.struct("turn", "original", "translation", "error")
    return _translations(runs, runs.committed()).groupBy("id").agg(F.min_by(value, order).alias("x")).select("id", "x.*")


def first_caption_log(runs: Runs) -> DataFrame:
    """The log rows of committed batches, without those of captions that
    an earlier turn has replaced."""
    log = runs.read("audit_log", runs.committed(), io.AUDIT_SCHEMA, lambda paths: io.read_audit_log(runs.spark, paths))
    valid = first_captions(runs).filter("error IS NULL").select(F.col("id").alias("ID"), F.col("original").alias("GPT Value Original"))
    return log.join(valid, ["ID", "GPT Value Original"], "left_semi").distinct()


def translated_turns(runs: Runs, turns: DataFrame) -> DataFrame:
    """Flat turns ``(id, turn, from, value)`` with every caption turn of a
    conversation replaced by its translation; failed ones keep their text."""
    return TU.replace_role_turns(turns, first_captions(runs).filter("error IS NULL"), C.GPT)
