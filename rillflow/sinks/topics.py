"""Writing topic records (key, value, topic, partition, ...).

``bootstrap_servers`` given: Spark's Kafka sink (producer settings such as
``kafka.acks``, ``kafka.compression.type``, ``kafka.linger.ms``, ``kafka.batch.size``
pass through). Otherwise the records go to a parquet folder with the same columns, or
(:func:`append_records`, :func:`append_records_stream`) to a topic folder with offsets of its own
(:mod:`rillflow.sources.records`), which is what tests and registered queries use (no Kafka
connector here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rillflow.sources.records import register


def _kafka_columns(records: DataFrame, topic: str | None) -> DataFrame:
    """The columns Spark's Kafka sink reads: key, value, and topic unless one topic is
    given; a ``partition`` column, when present, carries our partitioner's choice."""
    cols = ["key", "value"]
    if topic is None:
        cols.append("topic")
    if "partition" in records.columns:
        cols.append("partition")
    return records.select(*cols)


def write_records(records: DataFrame, path: str | None = None,
                  bootstrap_servers: str | None = None, topic: str | None = None,
                  **kafka_options: str) -> None:
    """Batch write of records."""
    if bootstrap_servers:
        w = _kafka_columns(records, topic) \
            .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
        if topic:
            w = w.option("topic", topic)
        for k, v in kafka_options.items():
            w = w.option(k, v)
        w.save()
        return
    if path is None:
        raise ValueError("give a path or bootstrap_servers")
    records.write.mode("errorifexists").parquet(path)


def write_records_stream(records: DataFrame, checkpoint: str, path: str | None = None,
                         bootstrap_servers: str | None = None, topic: str | None = None,
                         trigger: dict | None = None, **kafka_options: str) -> StreamingQuery:
    """Append a stream of records. The checkpoint makes the file sink exactly-once;
    Spark's Kafka sink is at-least-once (readers dedupe by key and offset)."""
    src = _kafka_columns(records, topic) if bootstrap_servers else records
    w = src.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if trigger:
        w = w.trigger(**trigger)
    if bootstrap_servers:
        w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
        if topic:
            w = w.option("topic", topic)
        for k, v in kafka_options.items():
            w = w.option(k, v)
        return w.start()
    return w.format("parquet").start(path)


_APPENDED = ("key", "value", "partition", "timestamp")


def append_records(records: DataFrame, path: str) -> None:
    """Appends records to a topic folder as one transaction. A topic partition's rows keep their order
    if they come from one task, in which case offsets follow it."""
    register(records.sparkSession)
    records.select(*_APPENDED).write.format("topic_folder").mode("append").option("path", path).save()


def append_records_stream(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Appends a stream of records to a topic folder, each micro-batch as one transaction: an attempt
    that fails leaves nothing, one that runs again after its commit adds nothing."""
    register(records.sparkSession)
    w = records.select(*_APPENDED).writeStream.format("topic_folder").outputMode("append").option("path", path) \
        .option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
