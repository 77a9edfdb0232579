"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver's correctness gate, run small)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from babelframe.plans.oracle import ORACLE
from babelframe.plans.queries import QUERIES
from tests.conftest import SMOKE, no_cross_joins

TABLES = ["documents", "conversations", "benchmark", "labels", "pages"]


def _norm(v):
    if isinstance(v, float):
        r = round(v, 6)
        return repr(0.0 if r == 0 or math.isnan(r) else r)
    return repr(v)


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted("|".join(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 200
    assert df.columns == ["doc_id", "n_words", "max_count", "has_repeated_words"]


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, plans, name):
    """Equal rows; no cross join in any plan on the way, staged ones included."""
    df = E.queries()[name](spark, SMOKE)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    o_cols, o_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows
    assert no_cross_joins(plans)
