"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.session import scratch_path

#: A word: a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a per-source (or per-rule) table may be broadcast.
BROADCAST_ROWS = 10_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared scratch folder, and read back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation) and keeps
    later passes from computing ``df`` again.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def small_or_not(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a stored table for broadcast if it has few rows; else the join is left to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def set_aside(docs: DataFrame, needed: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """``docs`` with every column that is not ``needed`` renamed by its place, whatever its name and
    case, so that no column of an operator's own can clash with it; and the names given."""
    names = [c if c in set(needed) else f"given__{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names
