"""Runs of a job: folders of their own that count once they are committed.

A job that writes several tables (translations, log, conversations, errors)
may be stopped between any two of them. Every run writes into folders of its
own name, and a one-row table, written last, commits it; readers take the
folders of committed runs only. What a stopped run left is ignored, or, for
paid results, picked up by the next run. Names come from the caller, so a run
that is repeated under its name (a replayed micro-batch) overwrites itself.

Only Spark's readers and writers touch the paths, so any store will do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def present(read) -> DataFrame | None:
    """``read()``, or None if nothing has been written there."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class Runs:
    """The runs under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str, run: str) -> str:
        return f"{self.root}/{table}/{run}"

    def marked(self, step: str) -> list[str]:
        """The runs that have finished ``step``, in the order they did."""
        marks = present(lambda: self.spark.read.schema("run string, place long").parquet(f"{self.root}/marks/{step}/*"))
        if marks is None:
            return []
        return [r["run"] for r in marks.orderBy("place", "run").collect()]  # a row a run

    def mark(self, step: str, run: str) -> None:
        """``run`` has finished ``step``; a second mark changes nothing."""
        done = self.marked(step)
        if run not in done:
            row = self.spark.createDataFrame([(run, len(done))], "run string, place long").coalesce(1)
            row.write.mode("overwrite").parquet(f"{self.root}/marks/{step}/{run}")

    def committed(self) -> list[str]:
        return self.marked("committed")

    def commit(self, run: str) -> None:
        self.mark("committed", run)

    def read(self, table: str, runs: list[str], schema: T.StructType | str, read) -> DataFrame:
        """``table`` of the given runs: ``read(paths)``, or no rows of ``schema``."""
        if not runs:
            return self.spark.createDataFrame([], schema)
        return read([self.path(table, r) for r in runs])
