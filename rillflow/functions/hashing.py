"""Partition assignment by a payload field (the custom partitioner)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_of(col: Column | str, num_partitions: int) -> Column:
    """Partition number in ``[0, num_partitions)`` for a value: ``pmod(hash(v), n)``.
    Never negative, unlike a plain remainder of a signed hash."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.hash(c), F.lit(num_partitions))
