"""The training-data queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from rillflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(
        map(repr, want.select(*[f'"{c}"' for c in columns]).fetchall()))


def test_every_operator_has_a_query():
    from __spark_entry__ import oracle_sql, queries

    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
