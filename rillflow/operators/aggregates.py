"""Keyed aggregates: counts and folds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.time import money
from rillflow.operators.tables import keyed


def count_by(df: DataFrame, key: Column | str, key_name: str | None = None,
             out: str = "count") -> DataFrame:
    """Count rows per key (existing or derived). Partial counts are summed after the
    shuffle, so a hot key costs one row per map task in the exchange."""
    k = F.col(key) if isinstance(key, str) else key
    if key_name:
        k = k.alias(key_name)
    return df.groupBy(k).agg(F.count(F.lit(1)).alias(out))


def _epoch_of(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz")
    return F.timestamp_millis(F.lit(0))


def balance_fold(df: DataFrame, key: str, amount: str, time: str,
                 count_name: str = "count", balance_name: str = "balance",
                 time_name: str = "time") -> DataFrame:
    """The bank-balance fold per key, from the initial value ``(0, 0, epoch)``:
    ``count + 1``, ``balance + amount``, ``time = max(time, event time)``.

    Every step is associative and commutative, so the fold is a plain partial
    aggregate (count, exact decimal sum, max) and needs no ordering of the rows. Rows
    without a key are skipped, as a keyed grouping skips them.
    """
    dtype = df.schema[time].dataType
    return (keyed(df, key).groupBy(key)
            .agg(F.count(F.lit(1)).alias(count_name),
                 F.coalesce(F.sum(money(amount)), F.lit(0).cast("decimal(28,2)"))
                 .alias(balance_name),
                 F.greatest(F.max(time), _epoch_of(dtype)).alias(time_name)))


def balance_reduce(df: DataFrame, key: str, amount: str, time: str,
                   count_name: str = "count", balance_name: str = "balance",
                   time_name: str = "time") -> DataFrame:
    """The same balance as a reduce whose result type is the input type: each row is
    first lifted to a ``(count=1, balance=amount, time)`` record, then records are
    combined pairwise (sum, sum, max). Same result as :func:`balance_fold`."""
    lifted = keyed(df, key).select(key, F.lit(1).cast("long").alias("__c"),
                       money(amount).alias("__b"), F.col(time).alias("__t"))
    return (lifted.groupBy(key)
            .agg(F.sum("__c").alias(count_name), F.sum("__b").alias(balance_name),
                 F.max("__t").alias(time_name)))
