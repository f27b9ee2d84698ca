"""The driver contract: every catalogue query against its DuckDB oracle at
sf0.001, plan hygiene (no Cartesian product, no Python UDF), and entry()."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from courtgrid.plans import catalogue
from courtgrid.sources.tables import DRIVER_TABLES

from .conftest import SF_SMALL

QUERIES = {name: fn for name, fn in E.queries().items() if name in catalogue.QUERIES}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in catalogue.QUERIES}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_plan_hygiene(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in plan, f"{name}: {bad}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"availability_pk", "slot_type", "available_courts"} <= set(df.columns)
