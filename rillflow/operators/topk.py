"""Top-k rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows by ``order`` (put a unique column last to break ties).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition keeps its
    own k best, and only k rows per partition reach the final merge, so there is no
    single-partition sort of the input."""
    return df.orderBy(*order).limit(k)


def top_k_array(df: DataFrame, fields: list[str], order: list[Column], k: int,
                sort_key: Column, out: str) -> DataFrame:
    """The top ``k`` rows packed into one row as a sorted ``array<struct>`` (the
    bounded sorted set). The ranking runs first (k rows), so the collect is bounded.
    ``sort_key`` maps an element ``x`` to a value whose ascending order is ``order``."""
    best = top_k(df, order, k).select(sort_key.alias("__sk"), F.struct(*fields).alias("__e"))
    return best.agg(F.sort_array(F.collect_list(F.struct("__sk", "__e"))).alias("__a")) \
        .select(F.transform("__a", lambda x: x["__e"]).alias(out))
