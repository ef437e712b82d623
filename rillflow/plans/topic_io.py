"""Topic records: reading a topic's raw records with their metadata, and writing rows
as key/JSON-value records and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import StreamingQueryException

from rillflow.functions.jsonio import decode_json
from rillflow.functions.time import money
from rillflow.plans.balances import ORACLE as BALANCE_SQL
from rillflow.session import scratch_path
from rillflow.sinks.topics import append_records, append_records_stream, write_records, write_records_stream
from rillflow.sources.records import read_records
from rillflow.sources.tables import EVENTS_SCHEMA, arriving_table, event_stream, read_table, stream_path
from rillflow.sources.topics import TOPIC_RECORD, records_from_table, topic_values
from rillflow.streaming.runner import run_stream
from rillflow.streaming.tables import running_sums

# Fixed values of our mapping: the events topic has three partitions, chosen by the user id. Where
# records are made from the table, the event id stands for the offset; a topic folder has its own.
EVENTS_TOPIC = "events"
EVENTS_PARTITIONS = 3

EVENT_VALUE = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("props", T.StringType()),
])


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    return records_from_table(
        ev, EVENTS_TOPIC, "user_id", ["user_id", "event_type", "props"], "event_id", "ts",
        partition=event_partition())


def event_partition() -> F.Column:
    return F.coalesce(F.pmod(F.col("user_id"), F.lit(EVENTS_PARTITIONS)), F.lit(0))


def _event_topic(spark: SparkSession, sf_dir: str) -> str:
    """The events written to a topic folder, each partition in the order of the event ids."""
    path = scratch_path(spark, "topics", EVENTS_TOPIC)
    records = event_records(spark, sf_dir)
    append_records(records.repartition(EVENTS_PARTITIONS, "partition").sortWithinPartitions("partition", "offset"), path)
    return path


def topic_inspect_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record of a topic as topic, partition, offset, key and value text, by the metadata that
    the topic gave it."""
    records = read_records(spark, _event_topic(spark, sf_dir), EVENTS_TOPIC)
    return topic_values(records).select("topic", "partition", "offset", "key", "value")


#: Where the seeking reader starts, of the partitions it is assigned.
SEEK = {0: 100, 2: 250}


def topic_seek_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of two assigned partitions from an offset of each on, read as a stream."""
    records = read_records(spark, _event_topic(spark, sf_dir), EVENTS_TOPIC, starting_offsets=SEEK, assign=list(SEEK), streaming=True)
    out = topic_values(records).select("partition", "offset", "key", "value")
    return run_stream(spark, out, "topic_seek").wait().result()


def topic_write_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as records to a topic folder (the Kafka sink's columns), read back
    and decoded: the round trip gives the rows again."""
    path = scratch_path(spark, "topics", EVENTS_TOPIC)
    write_records(event_records(spark, sf_dir), path)
    back = spark.read.parquet(path)
    good, _dead = decode_json(back.select(F.col("offset").alias("event_id"), "value"),
                              "value", EVENT_VALUE)
    return good.select("event_id", "user_id", "event_type", "props")


_RECORDS = f"""
    SELECT '{EVENTS_TOPIC}' AS topic, partition, row_number() OVER (PARTITION BY partition ORDER BY event_id) - 1 AS offset,
           CAST(user_id AS VARCHAR) AS key,
           to_json({{'user_id': user_id, 'event_type': event_type, 'props': props}})::VARCHAR AS value
    FROM (SELECT *, CAST(coalesce(user_id % {EVENTS_PARTITIONS}, 0) AS INTEGER) AS partition FROM events)"""

ORACLE = {
    "topic_inspect": _RECORDS,
    "topic_seek": f"""
        SELECT "partition", "offset", "key", "value" FROM ({_RECORDS})
        WHERE {" OR ".join(f'"partition" = {p} AND "offset" >= {o}' for p, o in SEEK.items())}""",
    "topic_write": "SELECT event_id, user_id, event_type, props FROM events",
}

QUERIES = {
    "topic_inspect": topic_inspect_on_tables,
    "topic_seek": topic_seek_on_tables,
    "topic_write": topic_write_on_tables,
}


def topic_round_trip_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams through a topic folder: the first writes event records (the Kafka
    sink's columns, exactly-once file sink), the second reads them back one file per
    trigger (the rate cap), decodes the JSON values and keeps the rows."""
    base = scratch_path(spark, "topic_round_trip")
    ev = event_stream(spark, stream_path(sf_dir, "events"), EVENTS_SCHEMA)
    rec = records_from_table(ev, EVENTS_TOPIC, "user_id", ["user_id", "event_type", "props"],
                             "event_id", "ts",
                             partition=event_partition())
    write_records_stream(rec, f"{base}/write-checkpoint", path=f"{base}/topic",
                         trigger={"availableNow": True}).awaitTermination()
    back = spark.readStream.schema(TOPIC_RECORD).option("maxFilesPerTrigger", 1) \
        .parquet(f"{base}/topic")
    good, _dead = decode_json(back.select(F.col("offset").alias("event_id"), "value"),
                              "value", EVENT_VALUE)
    out = good.select("event_id", "user_id", "event_type", "props")
    return run_stream(spark, out, "topic_read", base=f"{base}/read").wait().result()


ORACLE["topic_round_trip_stream"] = ORACLE["topic_write"]
QUERIES["topic_round_trip_stream"] = topic_round_trip_stream


def _arriving_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = arriving_table(spark, sf_dir, "events", "event_id", schema=EVENTS_SCHEMA)
    value = ["event_id", "user_id", "event_type", "props", "value"]
    return records_from_table(ev, EVENTS_TOPIC, "user_id", value, "event_id", "ts", partition=event_partition())


TOPIC_VALUE = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("props", T.StringType()),
    T.StructField("value", T.DecimalType(18, 2)),
])


def _values(records: DataFrame) -> DataFrame:
    return records.select(F.from_json(F.col("value").cast("string"), TOPIC_VALUE).alias("v")).select("v.*")


def topic_transactions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a topic in transactions, a micro-batch each. The second micro-batch fails at
    first, after it has written records, and is aborted; a second start goes on from the
    checkpoint. Readers see each record once, with offsets that have no gaps."""
    base = scratch_path(spark, "topic_transactions")
    records = _arriving_records(spark, sf_dir)
    last = read_table(spark, sf_dir, "events", ["event_id"]).agg(F.min("event_id"), F.max("event_id")).first()
    middle = None if last[0] is None else (last[0] + last[1]) // 2
    broken = records.withColumn("value", F.when(
        F.col("offset") == middle, F.raise_error("an attempt that fails").cast("binary")).otherwise(F.col("value")))
    try:
        append_records_stream(broken, f"{base}/topic", f"{base}/checkpoint").awaitTermination()
    except StreamingQueryException:
        pass  # the failure that is asked for
    append_records_stream(records, f"{base}/topic", f"{base}/checkpoint").awaitTermination()
    back = read_records(spark, f"{base}/topic", EVENTS_TOPIC)
    gapless = back.groupBy("partition").agg(((F.count("*") == F.count_distinct("offset")) & (F.min("offset") == 0)
                                             & (F.max("offset") + 1 == F.count("*"))).alias("gapless"))
    return back.join(gapless, "partition").select(
        "partition", F.from_json(F.col("value").cast("string"), TOPIC_VALUE)["event_id"].alias("event_id"), "gapless")


def running_balance_through_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two programs at once: one sends events to a topic partitioned by user, the other takes them
    from there and keeps running balances. Both run before the first event arrives; the second is
    stopped when the first has ended and all of the topic is read."""
    base = scratch_path(spark, "through_topic")
    rows = _values(read_records(spark, f"{base}/topic", EVENTS_TOPIC, streaming=True)).select(
        "user_id", "event_id", money("value").alias("amount"))
    balances = running_sums(spark, rows, "user_id", "amount", "event_id", base=f"{base}/balances",
                            trigger={"processingTime": "0 seconds"})
    sender = append_records_stream(_arriving_records(spark, sf_dir), f"{base}/topic", f"{base}/checkpoint")
    try:
        sender.awaitTermination()
        balances.query.processAllAvailable()
    finally:
        balances.query.stop()
    return balances.result(T.StructType([*rows.schema.fields, T.StructField("running_bal", T.DecimalType(28, 2))]))


ORACLE["topic_transactions_stream"] = f"""
    SELECT CAST(coalesce(user_id % {EVENTS_PARTITIONS}, 0) AS INTEGER) AS partition, event_id, true AS gapless FROM events"""
ORACLE["running_balance_through_topic"] = f"""
    SELECT user_id, event_id, amount, running_bal FROM ({BALANCE_SQL["running_balance"]})"""
QUERIES["topic_transactions_stream"] = topic_transactions_stream
QUERIES["running_balance_through_topic"] = running_balance_through_topic
