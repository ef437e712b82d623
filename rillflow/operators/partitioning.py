"""Co-locating rows by a payload field (the custom partitioner through a topic)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.hashing import partition_of


def co_locate(df: DataFrame, field: str, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition rows by ``field`` so each value's rows share a partition (and a
    task's state). Spark's grouping operators already do this on their key; use it
    only to reuse one partitioning for several later steps. A value holding a large
    share of the rows makes one large partition: prefer the keyed operators here, which
    pre-aggregate or split hot keys."""
    return df.repartition(num_partitions, field) if num_partitions else df.repartition(field)


def with_partition(df: DataFrame, field: str, num_partitions: int,
                   out: str = "partition") -> DataFrame:
    """The partition a record goes to: ``pmod(hash(field), n)``, never negative."""
    return df.withColumn(out, partition_of(F.col(field), num_partitions).cast("int"))
