"""Offset buckets for the operators that carry state along a key's arrival order.

The as-of join and the running sum work in the order of the offset (``seq``). A window over a
whole key would sort all rows of a hot key in one task. Instead rows are grouped by
``(key, offset >> BITS[0])``: however hot the key, such a group has at most ``2 ** BITS[0]``
offsets. What each group leaves is carried in levels: a window over the summaries of one key in
one group of ``2 ** (BITS[1] - BITS[0])`` buckets, then one over those groups' summaries. One grid
holds for every key and every input size; any widths give the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Widths of the two levels, as powers of two of offsets: 65,536 offsets in a bucket, 4,096
#: buckets in a group.
BITS = (16, 28)


def bucket_of(seq: str, bits: int) -> Column:
    """The bucket of an offset; rows without an offset come first."""
    return F.coalesce(F.shiftright(F.col(seq).cast("long"), bits), F.lit(-1 << 62))


def last_place(df: DataFrame, place: str, used: Sequence[str]) -> Column:
    """An order by ``place``, unique in a group, that also reads the columns not in ``used``: so
    the summary of a group needs the same columns as its rows, and Spark computes and shuffles
    those once for both."""
    rest = [f.name for f in df.schema.fields if f.name not in used and f.dataType.typeName() not in ("map", "variant")]
    return F.struct(place, F.xxhash64(*rest)) if rest else F.col(place)


def carry_over(summary: DataFrame, key: str, value: str, before: Callable[[Column, WindowSpec], Column],
               total: Callable[[Column], Column], join: Callable[[Column, Column], Column],
               bits: Sequence[int] = BITS) -> DataFrame:
    """What each ``(key, __b)`` group finds from the key's earlier groups, as ``__carry``.

    ``summary`` has one row per group: ``key, __b`` and what it leaves in ``value``.
    ``before`` combines the values of a window's rows, ``total`` those of a group of buckets
    (ordered by ``__b``), and ``join`` the carry into that group with the one inside it.
    """
    summary = summary.withColumn("__b2", F.shiftright("__b", bits[1] - bits[0]))
    inside = Window.partitionBy(key, "__b2").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("__b2").rowsBetween(Window.unboundedPreceding, -1)
    within = summary.withColumn("__near", before(F.col(value), inside))
    groups = summary.groupBy(key, "__b2").agg(total(F.col(value)).alias("__all"))
    far = groups.withColumn("__far", before(F.col("__all"), across)).select(key, "__b2", "__far")
    return within.join(far, [key, "__b2"]).withColumn("__carry", join(F.col("__far"), F.col("__near")))
