"""Driver tables as DataFrames.

Reads go through ``spark.read.parquet`` with an explicit column list so the scan's
ReadSchema holds only what a query uses, and filters written after the read reach the
scan as PushedFilters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.session import require_utc, scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def stream_path(sf_dir: str, name: str) -> str:
    """A glob naming one table file: the file stream source wants a folder or a glob."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet*"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """One driver table, pruned to ``columns`` when given. How the scan is split is Spark's
    ``spark.sql.files.maxPartitionBytes``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over parquet files; the explicit schema is required for file
    streams and is never inferred. The rate cap is the caller's to set."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def event_stream(spark: SparkSession, path: str, schema: T.StructType = EVENTS_SCHEMA,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a stream; its times have no zone and are taken as UTC."""
    require_utc(spark)
    return file_stream(spark, path, schema, max_files_per_trigger)


def arriving_table(spark: SparkSession, sf_dir: str, name: str, offset: str, batches: int = 3,
                   files: int = 2, schema: T.StructType | None = None,
                   columns: list[str] | None = None, arrival: Column | None = None) -> DataFrame:
    """A driver table (its ``columns``, the ``offset`` among them) as a stream that arrives in
    ``batches`` micro-batches, in the order of its ``offset`` column (rows without one first), or
    each row in the one that ``arrival`` says (from 0): what arrives together is written after
    what came before, ``files`` files each, to a folder under ``spark.checkpoint.dir``, and each
    trigger reads as many files. Its rows in a file are in no order."""
    require_utc(spark)
    table = read_table(spark, sf_dir, name, columns)
    if schema is not None:
        table = table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    path = scratch_path(spark, "arrivals", name)
    place = arrival
    if place is None:
        lo, hi = table.agg(F.min(offset), F.max(offset)).first()
        lo, hi = (0, 0) if lo is None else (lo, hi)
        edges = [lo + (hi - lo + 1) * k // batches for k in range(1, batches)]
        place = F.coalesce(sum((F.col(offset) >= e).cast("int") for e in edges), F.lit(0)) if edges else F.lit(0)
    for k in range(batches):
        table.filter(place == k).repartition(files).write.mode("append").parquet(path)
    return file_stream(spark, path, table.schema, files)
