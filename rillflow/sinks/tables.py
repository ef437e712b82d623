"""Compacted tables: the newest row per key, rewritten bucket by bucket as batches arrive.

A table lies in buckets by the leading bits of its keys' hash. A bucket with more rows than
``limit`` is split by the next bits, so buckets stay of one size while the table grows, and a
batch rewrites what it touches: its buckets, not the table. The rows of a bucket as a batch left
them are ``rows/v=<batch>/h=<depth>-<prefix>``; ``manifest/b=<batch>`` says for every bucket which
batch wrote it last. Files are immutable and a manifest names one whole version, so readers
see a batch entirely or not at all. Versions that no kept manifest names are removed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.operators.tables import latest_per_key

#: Rows of a bucket beyond which it is split: some tens of MB.
LIMIT = 250_000
#: Manifests that are kept: readers of the last one or the one before are never disturbed.
KEEP = 2

MANIFEST = "depth int, prefix bigint, v bigint"


@dataclass(frozen=True)
class Bucket:
    """The keys whose hash begins with the ``depth`` bits ``prefix``; the batch that wrote their
    rows last, or None if there are none."""

    depth: int
    prefix: int
    version: int | None

    @property
    def name(self) -> str:
        return f"{self.depth}-{self.prefix}"

    @property
    def folder(self) -> str:
        return f"rows/v={self.version}/h={self.name}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of a (possibly remote) file system, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class CompactedTable:
    """The table at ``base`` with rows of ``schema``, one for each ``key``."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, key: str | list[str],
                 limit: int = LIMIT, keep: int = KEEP):
        self.spark, self.base, self.schema = spark, base, schema
        self.keys = [key] if isinstance(key, str) else list(key)
        self.limit, self.keep = limit, keep

    def buckets(self, batch_id: int) -> list[Bucket]:
        """The buckets as a batch left them, one entry for each. A manifest that cannot be read raises;
        before the first batch there is one empty bucket."""
        if batch_id < 0:
            return [Bucket(0, 0, None)]
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest/b={batch_id}").collect()
        return [Bucket(r.depth, r.prefix, r.v) for r in sorted(rows, key=lambda r: (r.depth, r.prefix))]

    def read(self, buckets: list[Bucket]) -> DataFrame:
        """The rows of the given buckets."""
        paths = [f"{self.base}/{b.folder}" for b in buckets if b.version is not None]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def at(self, batch_id: int) -> DataFrame:
        """The whole table as a batch left it."""
        return self.read(self.buckets(batch_id))

    def placed(self, df: DataFrame, buckets: list[Bucket], keys: list[str] | None = None) -> DataFrame:
        """``df`` with ``__bucket``, the name of the bucket of its ``keys`` (the table's own by default)."""
        depth = max(b.depth for b in buckets)
        if depth == 0:
            return df.withColumn("__bucket", F.lit("0-0"))
        slots = [(p, b.name) for b in buckets
                 for p in range(b.prefix << depth - b.depth, b.prefix + 1 << depth - b.depth)]
        directory = self.spark.createDataFrame(slots, "__slot bigint, __bucket string")
        slot = F.shiftrightunsigned(F.xxhash64(*(keys or self.keys)), 64 - depth)
        return df.withColumn("__slot", slot).join(directory, "__slot").drop("__slot")

    def touched(self, df: DataFrame, buckets: list[Bucket], keys: list[str] | None = None) -> list[Bucket]:
        """The buckets that hold the keys of ``df``."""
        names = {r[0] for r in self.placed(df.select(*(keys or self.keys)), buckets, keys).select("__bucket").distinct().collect()}
        return [b for b in buckets if b.name in names]

    def lookup(self, df: DataFrame, batch_id: int, keys: list[str] | None = None) -> DataFrame:
        """The table's rows, as a batch left it, in the buckets that the ``keys`` of ``df`` are in: what
        a join with ``df`` needs, and little more, whatever the size of the table."""
        return self.read(self.touched(df, self.buckets(batch_id), keys))

    def upsert(self, batch_id: int, updates: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Merges one batch's ``updates``, rewriting only the buckets it touches.

        ``merge`` makes one row per key of the rows there and the updates together; a key that it
        leaves out is gone. All that is written follows from the batch and the manifest before it,
        so a batch that runs again replaces what it wrote; a manifest before it that is not there
        raises, as going on without it would lose its rows.
        """
        names = self.schema.fieldNames()
        before = self.buckets(batch_id - 1)
        new = updates.select(*names).persist()
        try:
            hit = self.touched(new, before)
            merged = merge(self.read(hit).unionByName(new)).select(*names).persist()
            try:
                sizes = {r["__bucket"]: r["count"] for r in self.placed(merged, before).groupBy("__bucket").count().collect()}
                after = [b for b in before if b not in hit]
                for b in hit:
                    more = max(0, math.ceil(math.log2(max(1, sizes.get(b.name, 0)) / self.limit)))
                    after += [Bucket(b.depth + more, (b.prefix << more) + i, batch_id) for i in range(1 << more)]
                out = self.placed(merged, after).withColumnRenamed("__bucket", "h")
                # a bucket without rows has no folder
                left = set(sizes) if len(after) == len(before) else {r.h for r in out.select("h").distinct().collect()}
                out.repartition("h").write.mode("overwrite").partitionBy("h").parquet(f"{self.base}/rows/v={batch_id}")
            finally:
                merged.unpersist()
        finally:
            new.unpersist()
        after = [b if b.version != batch_id or b.name in left else Bucket(b.depth, b.prefix, None) for b in after]
        self.spark.createDataFrame([(b.depth, b.prefix, b.version) for b in after], MANIFEST) \
            .coalesce(1).write.mode("overwrite").parquet(f"{self.base}/manifest/b={batch_id}")
        self._remove_old(batch_id, after)

    def _remove_old(self, batch_id: int, after: list[Bucket]) -> None:
        """Removes the manifest that is kept no longer, and what only that one names."""
        old_id = batch_id - self.keep
        if old_id < 0:
            return
        try:
            old = self.buckets(old_id)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return  # an earlier run of this batch removed it
        kept = set(after).union(*(self.buckets(i) for i in range(old_id + 1, batch_id)))
        versions = {b.version for b in kept}
        gone = [b for b in old if b.version is not None and b not in kept]
        for v in sorted({b.version for b in gone} - versions):
            remove_folder(self.spark, f"{self.base}/rows/v={v}")
        for b in gone:
            if b.version in versions:
                remove_folder(self.spark, f"{self.base}/{b.folder}")
        remove_folder(self.spark, f"{self.base}/manifest/b={old_id}")


def newest(keys: list[str], values: list[str], order: str) -> Callable[[DataFrame], DataFrame]:
    """A merge that keeps each key's row with the largest ``order``; all-null values delete it."""
    def merge(rows: DataFrame) -> DataFrame:
        deleted = F.lit(True)
        for c in values:
            deleted = deleted & F.col(c).isNull()
        return latest_per_key(rows, keys, [*values, order], [order], tombstone=deleted, null_keys=True)

    return merge


def summed(keys: list[str], values: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A merge that adds the values up."""
    return lambda rows: rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
