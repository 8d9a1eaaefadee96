"""Every registered query equals its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
import oracle
from conftest import SF_SMALL
from vaultline.plans.registry import registry

TABLES = "region nation customer supplier part orders lineitem events".split()


def canon(v):
    if v is None:
        return "-"
    if isinstance(v, float):
        return "-" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


# The library's own queries; tests/llm covers the training-data ones.
QUERIES = registry()
ORACLES = oracle.oracle_queries()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["facility", "revenue"]
    assert df.count() > 0


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(op in plan for op in FORBIDDEN), f"{key} plans a cross/nested-loop join"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLES[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, res.fetchall())
