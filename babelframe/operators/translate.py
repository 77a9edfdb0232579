"""Translation through a caller-supplied translator.

The translator is a *factory*: a picklable zero-argument callable that
builds the client once per task. The client is called with a pandas Series
of messages (and optional Series of preambles / target languages) and
returns a Series of responses, ``None`` for a failed item. No network client
is bundled; tests and queries use deterministic translators.

Calls run inside ``mapInArrow`` over Arrow batches: each task owns a slice
of the rows, calls in chunks of at most ``batch_size``, several at once if
asked to, and paces itself to its share of the global budget (U4). A retried task calls again, so callers persist
the result once (``persist_translations``) before using it twice.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from babelframe import constants as C
from babelframe.functions.text import as_message, clean_response, json_turn_length, language_code

#: Text bytes made Python strings at a time; only memory depends on it.
SLICE_BYTES = 1 << 20

TranslatorFactory = Callable[[], Callable[..., pd.Series]]


# ------------------------------------------------------------ translators
class ReverseWords:
    """Deterministic offline translator: reverses the space-separated tokens.

    ``' '.join(text.split(' ')[::-1])``; a ``None`` message fails.
    """

    def __call__(self):
        def translate(messages: pd.Series, preambles: pd.Series | None = None, targets: pd.Series | None = None):
            return messages.map(lambda s: None if s is None else " ".join(s.split(" ")[::-1]))

        return translate


class FailingTranslator:
    """Raises for every call (tests the failure path)."""

    def __call__(self):
        def translate(messages, preambles=None, targets=None):
            raise RuntimeError("translator unavailable")

        return translate


# ----------------------------------------------------------------- pacing
@dataclass(frozen=True)
class CallPlan:
    """How one of ``tasks`` calling tasks calls: ``chunk`` messages at a time,
    the starts of two chunks ``spacing`` seconds apart at least, no more than
    ``in_flight`` chunks under way (U4)."""

    tasks: int
    chunk: int
    spacing: float
    in_flight: int


def call_plan(
    tasks: int, batch_size: int, calls_per_minute: float | None, in_flight: int = 1, period: float = C.CALL_PERIOD_SECONDS
) -> CallPlan:
    """The share of a global budget of messages that each task may spend.

    A task may send a whole number of messages a period, in chunks of a size
    that divides it, so that no window of a period holds more than its share,
    and all tasks together no more than the budget. Budgets below one message
    a task take fewer tasks; below one a period, longer spacing.
    """
    if not calls_per_minute:
        return CallPlan(tasks, batch_size, 0.0, in_flight)
    tasks = max(1, min(tasks, int(calls_per_minute)))
    share = int(calls_per_minute // tasks)
    if share < 1:
        return CallPlan(1, 1, period / calls_per_minute, in_flight)
    chunk = max(d for d in range(1, min(batch_size, share) + 1) if share % d == 0)
    return CallPlan(tasks, chunk, period * chunk / share, in_flight)


class Pacer:
    """Pacing of one task to ``calls`` messages per ``period`` seconds.
    ``late``: an earlier attempt of this task may just have called."""

    def __init__(self, calls: float | None, period: float = C.CALL_PERIOD_SECONDS, late: float = 0.0):
        self.interval = (period / calls) if calls else 0.0
        self.next_at = time.monotonic() + late if late else 0.0

    def wait(self, n_calls: int) -> None:
        if not self.interval:
            return
        now = time.monotonic()
        if self.next_at > now:
            time.sleep(self.next_at - now)
        self.next_at = max(time.monotonic(), self.next_at) + self.interval * n_calls


def _parts(text: pa.Array, called: np.ndarray, plan: CallPlan) -> Iterator[slice]:
    """Rows cut so that a part has about SLICE_BYTES of ``text``, but whole
    chunks of calls, and as many as may be under way."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    calls = np.cumsum(called)
    at, done, made = 0, 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        whole = max(plan.in_flight, (int(calls[to - 1]) - made) // plan.chunk) * plan.chunk
        if to < len(ends):
            to = min(len(ends), int(np.searchsorted(calls, made + whole)) + 1)
        yield slice(at, to)
        at, done, made = to, int(ends[to - 1]), int(calls[to - 1])


def _call_partition(
    factory: TranslatorFactory, text_col: str, preamble_col: str | None, target_col: str | None, plan: CallPlan
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        retried = context is not None and context.attemptNumber() > 0
        rate = plan.chunk / plan.spacing if plan.spacing else None
        pacer = Pacer(rate, 1.0, late=plan.spacing if retried else 0.0)
        client = factory()

        def call(chunk: pd.DataFrame) -> tuple[list, list]:
            """Responses and failures of a chunk."""
            try:
                out = client(
                    chunk[text_col].reset_index(drop=True),
                    chunk[preamble_col].reset_index(drop=True) if preamble_col else None,
                    chunk[target_col].reset_index(drop=True) if target_col else None,
                )
                out = list(out)
                return out, [None if r is not None else "No response" for r in out]
            except Exception as e:  # noqa: BLE001 - a failed call fails its items
                return [None] * len(chunk), [f"call failed: {type(e).__name__}: {e}"] * len(chunk)

        with ThreadPoolExecutor(plan.in_flight) as pool:
            for whole in batches:
                called = whole.column("__call").to_numpy(zero_copy_only=False).astype(bool)
                for part in _parts(whole.column(text_col), called, plan):
                    b = whole.slice(part.start, part.stop - part.start)
                    sent = list(dict.fromkeys(c for c in (text_col, preamble_col, target_col) if c))
                    pdf = pd.DataFrame({c: pd.Series(b.column(c).to_pylist(), dtype=object) for c in sent})
                    responses: list = [None] * len(pdf)
                    failures: list = [None] * len(pdf)
                    under_way: deque = deque()

                    def take() -> None:
                        rows, result = under_way.popleft()
                        for i, r, f in zip(rows, *result.result(), strict=False):
                            responses[i], failures[i] = r, f

                    todo = np.flatnonzero(called[part]).tolist()
                    for start in range(0, len(todo), plan.chunk):
                        rows = todo[start : start + plan.chunk]
                        while len(under_way) >= plan.in_flight:
                            take()  # the oldest first: results keep the order of the rows
                        pacer.wait(plan.chunk)
                        under_way.append((rows, pool.submit(call, pdf.iloc[rows])))
                    while under_way:
                        take()
                    kept = [c for c in b.schema.names if c not in ("__call", "__message")]
                    made = [pa.array(x, pa.string(), from_pandas=True) for x in (responses, failures)]
                    yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *made], names=[*kept, "__response", "__call_error"])

    return run


def translate_column(
    df: DataFrame,
    text_col: str,
    factory: TranslatorFactory,
    *,
    keep: list[str] | None = None,
    preamble_col: str | None = None,
    target_col: str | None = None,
    out_col: str = "translation",
    error_col: str = "error",
    batch_size: int = C.TRANSLATE_BATCH_SIZE,
    calls_per_minute: float | None = None,
    num_partitions: int | None = None,
    partition_key: str | None = None,
    dealt: bool = False,
    order_col: str | None = None,
    clean: bool = True,
    only_when: F.Column | None = None,
    max_in_flight: int = 1,
) -> DataFrame:
    """Translate ``text_col`` -> ``out_col`` plus ``error_col``.

    * ``keep``: columns carried through the call (pruned by hand: column
      pruning does not pass through ``mapInArrow``).
    * ``num_partitions``: calling tasks (default: the cluster's parallelism),
      always fixed by a repartition before the call (by ``partition_key``, or
      dealt round-robin), so that neither an aggregate before it nor the
      planner decides how many tasks call.
    * ``dealt``: the rows lie in that many partitions or more (those of a scan,
      say), which are put together to the calling tasks without a shuffle; if
      there are fewer, fewer tasks call.
    * ``calls_per_minute``: one budget of messages for all tasks together; no
      minute holds more, and a retried task waits before its first call (U4).
      Speculative execution would call twice; leave it off here.
    * ``max_in_flight``: chunks a task has under way at once; results keep
      the order of the rows. The client must bear calls from several threads.
    * ``order_col``: calls inside a task go in ascending order of it (W1).
    * ``clean``: apply P15 (strip Unicode whitespace; empty -> error) and
      route failures to ``error_col`` (F8). Failed rows get NULL ``out_col``.
    * A NULL text is never sent; its row gets the error ``No text``.
    * ``only_when``: rows where it is false pass through uncalled with NULL
      ``out_col`` and ``error_col`` (one pass, no join back).
    """
    keep = list(keep or [])
    cols = list(dict.fromkeys(keep + [text_col] + [c for c in (preamble_col, target_col, order_col) if c]))
    wanted = F.lit(True) if only_when is None else F.coalesce(only_when, F.lit(False))
    has_text = F.col(text_col).isNotNull()
    df = df.withColumn("__call", wanted & has_text).withColumn("__none", wanted & ~has_text)
    src = df.select(*cols, "__call", "__none")
    plan = call_plan(num_partitions or df.sparkSession.sparkContext.defaultParallelism, batch_size, calls_per_minute, max_in_flight)
    if dealt:
        src = src.coalesce(plan.tasks)
    else:
        src = src.repartition(plan.tasks, partition_key) if partition_key else src.repartition(plan.tasks)
    if order_col:
        src = src.sortWithinPartitions(order_col)
    src = src.withColumn("__message", as_message(text_col))  # after the shuffle: the text moves once
    schema = T.StructType(
        [f for f in src.schema.fields if f.name not in ("__call", "__message")]
        + [T.StructField("__response", T.StringType()), T.StructField("__call_error", T.StringType())]
    )
    called = src.mapInArrow(
        _call_partition(factory, "__message", preamble_col, target_col, plan), schema
    )
    called = called.withColumn("__call_error", F.when(F.col("__none"), F.lit("No text")).otherwise(F.col("__call_error"))).drop("__none")
    if not clean:
        return called.withColumnRenamed("__response", out_col).withColumnRenamed("__call_error", error_col)
    text, err = clean_response("__response")
    err = F.when(F.col("__response").isNotNull(), err)
    return (
        called.withColumn(error_col, F.coalesce(F.col("__call_error"), err))
        .withColumn(out_col, F.when(F.col(error_col).isNull(), text))
        .drop("__response", "__call_error")
    )


def persist_translations(df: DataFrame, path: str, observed: Observation | None = None, error_col: str = "error") -> DataFrame:
    """Write the paid-for result once and read it back (S8 checkpoint).
    ``observed`` takes ``n_rows`` and ``n_failed`` (A2, A10) from the pass
    that writes."""
    from babelframe.sources.tables import spread_rows

    if observed is not None:
        df = df.observe(observed, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(error_col).isNotNull()).alias("n_failed"))
    df.write.mode("overwrite").parquet(path)
    return spread_rows(df.sparkSession.read.parquet(path))


def failures(translated: DataFrame, key: str | list[str] = "id", error_col: str = "error") -> DataFrame:
    """F8/A10: failed ids with their error."""
    keys = [key] if isinstance(key, str) else key
    return translated.filter(F.col(error_col).isNotNull()).select(*keys, error_col)


def failure_counts(translated: DataFrame, error_col: str = "error") -> DataFrame:
    """A10: failure count per error message (NULL = success)."""
    return translated.groupBy(error_col).agg(F.count(F.lit(1)).alias("n"))


def has_column(df: DataFrame, name: str) -> bool:
    """plan-time guard (metadata only)."""
    return name in df.columns


# ---------------------------------------------------------- batches & order
def batch_ids(row_idx: F.Column | str, size: int = C.TRANSLATE_BATCH_SIZE) -> F.Column:
    """Fixed-size slices by row index; the last slice may be short."""
    c = F.col(row_idx) if isinstance(row_idx, str) else row_idx
    return F.floor(c / F.lit(size)).cast("bigint")


def turns_json_length(turns: DataFrame, key: str = "id") -> DataFrame:
    """M8 on flat turns: ``len(json.dumps(conversation))`` per key."""
    return turns.groupBy(key).agg(
        (F.lit(2) + F.sum(json_turn_length("from", "value")) + F.lit(2) * (F.count(F.lit(1)) - 1))
        .cast("bigint")
        .alias("json_len")
    )


def order_within_batches(df: DataFrame, batch_col: str, length_col: str, row_idx: str) -> DataFrame:
    """Position of each row inside its batch by (length, input order).

    Batches are fixed-size slices, so each window partition is bounded.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(batch_col).orderBy(length_col, row_idx)
    return df.withColumn("position_in_batch", F.row_number().over(w).cast("bigint"))


# ------------------------------------------------------ U2 back-translation
def back_translate(
    df: DataFrame,
    factory: TranslatorFactory,
    *,
    keep: list[str],
    text_col: str = "conversations",
    lang_col: str = "language",
    languages: list[str] | None = None,
    catalogue: DataFrame | None = None,
    out_col: str = "back_translations",
    batch_size: int = C.BACK_TRANSLATE_CHUNK,
    calls_per_minute: float | None = None,
    num_partitions: int | None = None,
    max_in_flight: int = 1,
) -> DataFrame:
    """U2 + J5 + J3: back-translate every row whose language is listed, all
    languages in one job, each row with its language's ``lang_to_en``
    prompt. The result stays on its own row (no positional attach, D4):
    rows of other languages (English) get NULL; failed calls get ''.
    """
    from babelframe.operators.prompts import TO_ENGLISH, choose_prompt, prompt_catalogue

    langs = languages or C.BACK_TRANSLATE_LANGUAGES
    wanted = language_code(lang_col).isin([C.LANGUAGE_ALIASES.get(x, x) for x in langs])
    cat = catalogue if catalogue is not None else prompt_catalogue(df.sparkSession, langs)
    with_prompt = choose_prompt(df, cat, lang_col, TO_ENGLISH, required=wanted)
    called = translate_column(
        with_prompt,
        text_col,
        factory,
        keep=list(dict.fromkeys([*keep, lang_col])),
        preamble_col="preamble",
        batch_size=batch_size,
        calls_per_minute=calls_per_minute,
        num_partitions=num_partitions,
        max_in_flight=max_in_flight,
        clean=False,
        only_when=wanted,
        out_col="__bt",
        error_col="__bt_error",
    )
    return called.withColumn(out_col, F.when(wanted, F.coalesce(F.col("__bt"), F.lit("")))).drop(
        "__bt", "__bt_error", "preamble"
    )


# -------------------------------------------------- U5 translation memory
def memory_translate(
    df: DataFrame,
    memory: DataFrame,
    text_col: str,
    target_lang: str | F.Column,
    out_col: str = "translation",
) -> DataFrame:
    """Look sentences up in a translation memory
    ``(sentence, lang, translation)`` with the ``<image>`` affix taken off
    (P7) and put back on the same side afterwards. Unmatched -> NULL.

    An equi-join on (sentence, lang); memory tables are small in practice
    and the planner broadcasts them when their measured size allows.
    """
    from babelframe.functions.text import strip_image_affix

    txt = F.col(text_col)
    tag = C.IMAGE_TAG
    prefix = txt.startswith(tag + "\n")
    suffix = txt.endswith("\n" + tag)
    lang = F.lit(target_lang) if isinstance(target_lang, str) else target_lang
    keyed = df.withColumn("__sentence", strip_image_affix(txt)).withColumn("__lang", lang)
    mem = memory.select(
        F.col("sentence").alias("__sentence"), F.col("lang").alias("__lang"), F.col("translation").alias("__tr")
    )
    mem = mem.groupBy("__sentence", "__lang").agg(F.min("__tr").alias("__tr"))  # of several translations the smallest
    joined = keyed.join(mem, on=["__sentence", "__lang"], how="left")
    restored = (
        F.when(prefix, F.concat(F.lit(tag + "\n"), F.col("__tr")))
        .when(suffix, F.concat(F.col("__tr"), F.lit("\n" + tag)))
        .otherwise(F.col("__tr"))
    )
    return joined.withColumn(out_col, restored).drop("__sentence", "__lang", "__tr")
