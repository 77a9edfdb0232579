from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("babelframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="babelframe-tests-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="babelframe-t-")


@pytest.fixture()
def plans(monkeypatch):
    """The physical plans of everything that is written or collected."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter

    seen: list[str] = []

    def of(df) -> None:
        seen.append(df._jdf.queryExecution().executedPlan().toString())

    for name in ("parquet", "csv", "json", "text", "save"):
        real = getattr(DataFrameWriter, name)
        monkeypatch.setattr(DataFrameWriter, name, lambda self, *a, _real=real, **k: of(self._df) or _real(self, *a, **k))
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: of(self) or collect(self))
    return seen


def no_cross_joins(seen: list[str]) -> bool:
    return bool(seen) and not any("NestedLoopJoin" in p or "CartesianProduct" in p for p in seen)


def rows(df, *cols):
    """Collected rows as plain tuples, sorted."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
