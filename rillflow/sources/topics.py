"""Kafka-shaped topic records.

A topic record has the columns of Spark's Kafka source:
``key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp``.
A null value is a delete (tombstone). The Kafka connector jar is optional: when it is on
the classpath :func:`read_topic` reads a live topic; tests and registered queries make
the same columns from a table with :func:`records_from_table`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.hashing import partition_of
from rillflow.functions.jsonio import encode_json

TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def read_topic(spark: SparkSession, topic: str, bootstrap_servers: str,
               streaming: bool = True, starting_offsets: str = "earliest",
               max_offsets_per_trigger: int | None = None,
               assign: str | None = None, **kafka_options: str) -> DataFrame:
    """Records of a Kafka topic, batch or stream.

    ``starting_offsets`` is ``earliest``/``latest`` or the per-partition JSON form;
    ``assign`` (JSON ``{"topic":[0]}``) reads given partitions instead of subscribing;
    ``max_offsets_per_trigger`` caps records per micro-batch. Progress is committed in
    the query's checkpoint, not in the consumer group.
    """
    r = spark.readStream if streaming else spark.read
    r = r.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    r = r.option("assign", assign) if assign else r.option("subscribe", topic)
    r = r.option("startingOffsets", starting_offsets)
    if max_offsets_per_trigger and streaming:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    for k, v in kafka_options.items():
        r = r.option(k, v)
    return r.load().select(*[f.name for f in TOPIC_RECORD.fields])


def records_from_table(df: DataFrame, topic: str, key: Column | str,
                       value_cols: list[str], offset: Column | str,
                       timestamp: Column | str, num_partitions: int = 1,
                       partition: Column | None = None) -> DataFrame:
    """Topic records made from table rows: key as text bytes, value as JSON bytes of
    ``value_cols`` (all null -> null value), a partition from the key's hash unless
    ``partition`` gives one."""
    k = F.col(key) if isinstance(key, str) else key
    part = partition if partition is not None else partition_of(k, num_partitions)
    return df.select(
        k.cast("string").cast("binary").alias("key"),
        encode_json(*value_cols).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        part.cast("int").alias("partition"),
        (F.col(offset) if isinstance(offset, str) else offset).cast("long").alias("offset"),
        (F.col(timestamp) if isinstance(timestamp, str) else timestamp)
        .cast("timestamp").alias("timestamp"),
    )


def topic_values(records: DataFrame) -> DataFrame:
    """Key and value as text, with the record metadata kept."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp")
