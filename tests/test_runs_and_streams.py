"""Committed runs, incremental jobs and paced calls: crashes between any two
writes, replays, turns that arrive in any order, and budgets of calls."""

from __future__ import annotations

import json
import math
import os
import threading
import time

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException

from babelframe import constants as C
from babelframe.operators import translate as TR
from babelframe.plans import pipelines as PL
from babelframe.sources import io
from babelframe.sources.runs import Runs
from babelframe.sources.tables import padded_id, role_to_from
from babelframe.streaming import incremental as INC


class Counting:
    """Reverses words and writes a file for each call (tasks run elsewhere)."""

    def __init__(self, folder: str, seconds: float = 0.0):
        self.folder, self.seconds = folder, seconds

    def __call__(self):
        folder, seconds, reverse = self.folder, self.seconds, TR.ReverseWords()()
        lock, state = threading.Lock(), {"now": 0, "most": 0}

        def translate(messages, preambles=None, targets=None):
            with lock:
                state["now"] += 1
                state["most"] = max(state["most"], state["now"])
                most = state["most"]
            at = time.time()
            if seconds:
                time.sleep(seconds * (1 + len(messages) % 3))
            with lock:
                state["now"] -= 1
            name = f"{os.getpid()}-{threading.get_ident()}-{time.monotonic_ns()}.json"
            with open(os.path.join(folder, name), "w") as f:
                json.dump({"messages": list(messages), "at": at, "most": most}, f)
            return reverse(messages)

        return translate


def calls_in(folder: str) -> list[dict]:
    out = []
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as f:
            out.append(json.load(f))
    return out


def messages_in(folder: str) -> list[str]:
    return sorted(m for c in calls_in(folder) for m in c["messages"])


@pytest.fixture
def calls(tmp_dir):
    folder = os.path.join(tmp_dir, "calls")
    os.makedirs(folder)
    return folder


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ runs of X1
class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("after", ["persist_translations", "write_audit_log", "write_conversations", "commit"])
@pytest.mark.parametrize("before", [True, False])
def test_a_killed_run_is_taken_up(spark, tmp_dir, calls, monkeypatch, after, before):
    """Stopped before or after each write: the next run logs every caption
    once and pays for none again that had been paid for."""
    data = spark.createDataFrame([(f"{i}", "img", [("human", "q"), ("gpt", f"cap {i}")]) for i in range(6)], io.CONVERSATION_SCHEMA)
    out = os.path.join(tmp_dir, "out")
    first = data.filter("id < 2")
    PL.translate_pipeline(spark, first, Counting(calls), out)
    place = {"persist_translations": TR, "write_audit_log": io, "write_conversations": io, "commit": Runs}[after]
    real = getattr(place, after)

    def stopped(*a, **k):
        if not before:
            real(*a, **k)
        raise Killed(after)

    with monkeypatch.context() as m:
        m.setattr(place, after, stopped)
        with pytest.raises(Killed):
            PL.translate_pipeline(spark, data, Counting(calls), out)
    seen = rows(PL.audit_log(spark, out))
    assert len(seen) == (6 if (after, before) == ("commit", False) else 2)  # only committed runs are read
    paid = messages_in(calls)
    res = PL.translate_pipeline(spark, data, Counting(calls), out)
    want = [(f"{i}", f"cap {i}", f"{i} cap") for i in range(6)]
    assert rows(res.audit_log) == want == rows(PL.audit_log(spark, out))
    assert sorted((r["id"], r["conversations"][1]["value"]) for r in res.output.collect()) == [(i, t) for i, _, t in want]
    assert messages_in(calls) == [c for _, c, _ in want]  # each paid once, over all three runs
    assert (len(paid) == 6) == ((after, before) != ("persist_translations", True))


def test_counts_come_with_the_write(spark, tmp_dir):
    data = spark.createDataFrame([("1", "img", [("gpt", "a b")]), ("2", "img", [("gpt", "  ")]), ("3", "img", [])], io.CONVERSATION_SCHEMA)
    res = PL.translate_pipeline(spark, data, TR.ReverseWords(), os.path.join(tmp_dir, "out"))
    assert res.counts == {"n_rows": 2, "n_failed": 1}
    assert sorted(r["id"] for r in res.errors.collect()) == ["2", "3"]


# ---------------------------------------------------------------------- stream
TURNS = [
    (0, 0, "user", "q"), (0, 1, "assistant", "a b"), (0, 3, "assistant", "late c"),
    (1, 0, "user", "q"), (1, 1, "assistant", "d e f"),
    (2, 0, "user", "only a question"),
    (3, 1, "assistant", "x y"), (3, 3, "assistant", "z w"), (3, 5, "assistant", "v u"),
    (4, 1, "assistant", "   "), (4, 3, "assistant", "not the first"),
]
#: Which turns come in which file: later turns before earlier ones, too.
FILES = [[2, 3, 8], [0, 7, 10], [1, 4, 9, 5], [6]]


def write_file(src: str, i: int) -> None:
    pd.DataFrame([TURNS[k] for k in FILES[i]], columns=["conv_id", "turn", "role", "text"]).to_parquet(os.path.join(src, f"part-{i}.parquet"))


def flat(spark):
    conv = spark.createDataFrame(TURNS, INC.CONVERSATION_ROWS)
    return conv.select(padded_id(conv["conv_id"]).alias("id"), "turn", role_to_from(conv["role"]).alias("from"), conv["text"].alias("value"))


def test_first_captions_equal_the_batch_job(spark, tmp_dir, calls):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    batch = PL.translate_pipeline(spark, flat(spark), TR.ReverseWords(), os.path.join(tmp_dir, "x1"), nested=False)
    for i in range(len(FILES)):  # every file a drain of its own: state and progress outlive the query
        write_file(src, i)
        runs = INC.translate_first_captions(spark, src, Counting(calls), os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    assert rows(INC.first_caption_log(runs)) == rows(batch.audit_log)
    assert rows(INC.translated_turns(runs, flat(spark)).select("id", "turn", "from", "value")) == rows(batch.output.select("id", "turn", "from", "value"))
    # captions that looked first for a while were called, none of them twice
    assert len(messages_in(calls)) == len(set(messages_in(calls)))
    assert {"a b", "d e f", "x y"} <= set(messages_in(calls)) and "v u" in messages_in(calls)


@pytest.mark.parametrize("where", ["mark", "write_audit_log", "commit"])
def test_a_replayed_batch_adds_nothing(spark, tmp_dir, calls, monkeypatch, where):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    for i in range(len(FILES)):
        write_file(src, i)
    place = {"mark": Runs, "write_audit_log": io, "commit": Runs}[where]
    real, stops = getattr(place, where), []

    def once(*a, **k):
        out = real(*a, **k)
        if not stops:
            stops.append(1)
            raise Killed(where)
        return out

    args = (spark, src, Counting(calls), os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    monkeypatch.setattr(place, where, once)
    with pytest.raises(StreamingQueryException):
        INC.translate_first_captions(*args)
    paid = messages_in(calls)
    runs = INC.translate_first_captions(*args)
    assert stops and messages_in(calls) == paid  # the translations were complete: not called again
    batch = PL.translate_pipeline(spark, flat(spark), TR.ReverseWords(), os.path.join(tmp_dir, "x1"), nested=False)
    assert rows(INC.first_caption_log(runs)) == rows(batch.audit_log)
    log = runs.read("audit_log", runs.committed(), io.AUDIT_SCHEMA, lambda p: io.read_audit_log(spark, p))
    assert log.count() == log.distinct().count()


# ------------------------------------------------------------------- U4 pacing
@pytest.mark.parametrize(("tasks", "batch", "calls_"), [(8, 10, 60), (8, 10, 600), (3, 7, 100), (100, 10, 60), (4, 5, 0.5), (1, 100, 10_000), (7, 9, 1000)])
def test_no_window_holds_more_than_the_budget(tasks, batch, calls_):
    plan = TR.call_plan(tasks, batch, calls_, period=60.0)
    assert plan.tasks <= max(1, tasks) and plan.chunk <= batch
    per_window = math.ceil(60.0 / plan.spacing - 1e-9)
    assert plan.tasks * plan.chunk * per_window <= max(1, calls_)
    assert TR.call_plan(tasks, batch, None) == TR.CallPlan(tasks, batch, 0.0, 1)


def test_calls_in_flight_and_their_order(spark, calls):
    df = spark.createDataFrame([(i, f"w{i} x") for i in range(60)], "id long, t string").coalesce(1)
    out = TR.translate_column(df, "t", Counting(calls, 0.05), keep=["id"], batch_size=5, num_partitions=1, max_in_flight=4).collect()
    assert {r["id"]: r["translation"] for r in out} == {i: f"x w{i}" for i in range(60)}
    most = max(c["most"] for c in calls_in(calls))
    assert 2 <= most <= 4


def test_calls_a_minute_over_all_tasks(spark, calls, monkeypatch):
    """240 messages a minute over two tasks, several chunks under way: no two
    seconds hold more than 8 messages."""
    df = spark.createDataFrame([(i, f"w{i}") for i in range(24)], "id long, t string")
    TR.translate_column(df, "t", Counting(calls, 0.1), keep=["id"], batch_size=2, num_partitions=2, calls_per_minute=240, max_in_flight=3).collect()
    sent = sorted((c["at"], len(c["messages"])) for c in calls_in(calls))
    for at, _ in sent:
        assert sum(n for t, n in sent if at <= t < at + 1.95) <= 8 + 2
    assert sum(n for _, n in sent) == 24


def test_a_retried_task_waits(monkeypatch):
    waits = []
    monkeypatch.setattr(TR.time, "sleep", waits.append)
    TR.Pacer(2, 1.0, late=0.5).wait(1)
    assert len(waits) == 1 and 0.4 < waits[0] <= 0.5


def test_tasks_are_fixed_after_an_aggregate(spark, calls):
    turns = flat(spark)
    first = turns.filter("`from` = 'gpt'").groupBy("id").agg({"value": "min"}).toDF("id", "t")
    n = TR.translate_column(first, "t", TR.ReverseWords(), keep=["id"]).rdd.getNumPartitions()
    assert n == spark.sparkContext.defaultParallelism
    assert C.CALL_PERIOD_SECONDS == 60
