"""Named queries: one per program of the reference, mapped onto the driver tables.

Each plan module exposes ``QUERIES`` (name -> ``fn(spark, sf_dir) -> DataFrame``) and
``ORACLE`` (name -> DuckDB SQL over the same tables, absent where SQL cannot say it).
"""

from __future__ import annotations

import importlib

_MODULES = ("counting", "ranking", "windowed", "enrich", "table_ops", "balances",
            "topic_io", "text_io", "streams", "stateful_streams", "table_streams", "late_streams")


def _load():
    queries, oracle = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"rillflow.plans.{m}")
        for k, v in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"query {k} registered twice")
            queries[k] = v
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _load()[0]


def all_oracle_sql():
    return _load()[1]
