"""Running totals per key (the running balance)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.time import money
from rillflow.operators.buckets import BITS, bucket_of, carry_over, last_place
from rillflow.operators.tables import keyed


def running_sum(df: DataFrame, key: str, amount: str, seq: str, out: str = "running_bal",
                bits: Sequence[int] = BITS) -> DataFrame:
    """Each row with the sum of ``amount`` over its key's rows up to and including it, in the
    order of the offset ``seq``, whatever the rows' times. Amounts are exact DECIMAL(18,2)
    (the ``amount`` column comes back in that type); rows with a null key are dropped.

    The sum runs inside ``(key, offset bucket)`` groups; the totals of a key's earlier groups
    are carried in two levels (see :mod:`rillflow.operators.buckets`), so a hot key is spread
    over its buckets. For batch DataFrames; a stream uses the ``RunningBalance`` processor.
    """
    zero = F.lit(0).cast("decimal(38,2)")
    # the amount is replaced by its decimal form in place, so the windowed rows and the bucket
    # totals below read the same columns and share one exchange
    d = keyed(df, key).withColumn(amount, money(amount)) \
        .withColumn("__b", bucket_of(seq, bits[0]))
    w_in = (Window.partitionBy(key, "__b").orderBy(seq)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = d.withColumns({"__in": F.coalesce(F.sum(amount).over(w_in), zero), "__n": F.row_number().over(
        Window.partitionBy(key, "__b").orderBy(seq))})
    # bucket totals = the running value at each bucket's last row, taken from the windowed rows
    # (already clustered by (key, bucket)): the input is scanned and shuffled once
    totals = inner.groupBy(key, "__b").agg(F.max_by("__in", last_place(df, "__n", (key, amount, seq))).alias("__tot"))
    carry = carry_over(totals, key, "__tot", lambda c, w: F.coalesce(F.sum(c).over(w), zero), F.sum,
                       lambda far, near: far + near, bits).select(key, "__b", "__carry")
    return (inner.join(carry, [key, "__b"], "inner")
            .withColumn(out, (F.col("__in") + F.col("__carry")).cast("decimal(28,2)"))
            .drop("__b", "__n", "__in", "__carry"))
