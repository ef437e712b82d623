"""Every registered query against its DuckDB SQL on the smallest driver tables:
same columns, same rows (order-insensitive)."""

import os
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry
from rillflow.plans import all_oracle_sql, all_queries
from rillflow.sources.tables import TABLES

SF = os.environ.get("RILLFLOW_ORACLE_SF", "/root/testdata/sf0.001")
Q = all_queries()
O = all_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return str(v)
    return v


def test_every_query_has_oracle():
    assert set(O) <= set(Q)
    assert set(Q) == set(O), sorted(set(Q) - set(O))


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["news_type", "clicks"] and len(df.collect()) == 3


@pytest.mark.parametrize("name", sorted(O))
def test_query_matches_oracle(spark, duck, name):
    df = Q[name](spark, SF)
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=repr)
    res = duck.sql(O[name])
    cols = [d[0] for d in res.description]
    want = sorted((tuple(_norm(v) for v in r) for r in res.fetchall()), key=repr)
    assert df.columns == cols
    assert got == want
