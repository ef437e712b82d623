"""Queries that start from or end in text: JSON values decoded to typed rows with their dead
letters, times as ISO text, printed lines, and rows sent to partitions by a field."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.jsonio import parse_json
from rillflow.functions.text import upper_all
from rillflow.functions.time import epoch_millis, format_iso_millis, parse_iso
from rillflow.operators.partitioning import co_locate, with_partition
from rillflow.operators.windows import tumbling_count
from rillflow.plans.ranking import ORACLE as RANK_SQL
from rillflow.plans.ranking import parse_top3, top3_news_json_on_tables
from rillflow.plans.windowed import ORACLE as WINDOW_SQL
from rillflow.plans.windowed import TUMBLE
from rillflow.sinks.console import labeled, window_lines
from rillflow.sources.tables import read_table

# Amounts beyond the range of an int, so that a decoder that cuts them shows.
BIG = 3_000_000_007

TRANSACTION = T.StructType([T.StructField("user", T.StringType()), T.StructField("amount", T.LongType()),
                            T.StructField("time", T.StringType())])


def event_texts(ev: DataFrame) -> DataFrame:
    """Every event (``event_id, user_id, ts``) as a JSON text; by its id the amount is a number, a
    quoted number, a fraction or no number, or the text breaks off."""
    amount = (F.col("event_id") * BIG).cast("string")
    form = F.col("event_id") % 5
    shown = F.when(form == 1, F.concat(F.lit('"'), amount, F.lit('"'))).when(form == 2, F.concat(amount, F.lit(".9"))) \
        .when(form == 4, F.lit('"n/a"')).otherwise(amount)
    head = F.concat(F.lit('{"user":"'), F.col("user_id").cast("string"), F.lit('","amount":'))
    time = F.when(form == 4, F.lit("soon")).otherwise(format_iso_millis("ts"))
    value = F.when(form == 3, head).otherwise(F.concat(head, shown, F.lit(',"time":"'), time, F.lit('"}')))
    return ev.select("event_id", value.alias("value"))


def decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows from the texts: whole amounts, event times, and the raw text where it is no
    JSON (the dead letters), in one pass."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts"])
    rows = parse_json(event_texts(ev), "value", TRANSACTION, lenient_ints=True)
    return rows.select("event_id", "user", "amount", epoch_millis(parse_iso("time")).alias("time_ms"), "bad_record")


def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as ISO text and back."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"]).withColumn("iso", format_iso_millis("ts"))
    return ev.select("event_id", "iso", epoch_millis(parse_iso("iso")).alias("back_ms"))


def upper_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element of an array in upper case."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "props"])
    fields = F.array(F.coalesce("event_type", F.lit("")), F.coalesce("props", F.lit("")))
    return ev.select("event_id", F.array_join(upper_all(fields), "|").alias("fields"))


PARTITIONS = 3


def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows sent to partitions by a field: how many rows each value has, in how many partitions
    and in how many of Spark's tasks they are, and whether the numbers are in range."""
    ev = read_table(spark, sf_dir, "events", ["event_type"])
    sent = with_partition(co_locate(ev, "event_type", PARTITIONS), "event_type", PARTITIONS) \
        .withColumn("task", F.spark_partition_id())
    return sent.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("partition").alias("n_partitions"),
        F.count_distinct("task").alias("n_tasks"),
        F.min(F.col("partition").between(0, PARTITIONS - 1)).alias("in_range"))


def top3_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top three as JSON text, read back into rows."""
    rows = top3_news_json_on_tables(spark, sf_dir).select(F.explode(parse_top3("top3_sorted")).alias("t"))
    return rows.select(F.col("t.NewsType").alias("news_type"), F.col("t.Clicks").alias("clicks"))


def labeled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a labelled print shows."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type"])
    return labeled(ev, "events")


def tumbling_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed line of every windowed count."""
    return window_lines(tumbling_count(read_table(spark, sf_dir, "events", ["user_id", "ts"]),
                                       "user_id", "ts", TUMBLE), "user_id")


_HEAD = """'{"user":"' || CAST(user_id AS VARCHAR) || '","amount":'"""

ORACLE = {
    "decoded_events": f"""
        SELECT event_id,
               CASE WHEN event_id % 5 <> 3 THEN CAST(user_id AS VARCHAR) END AS user,
               CASE event_id % 5 WHEN 3 THEN NULL WHEN 4 THEN 0 ELSE event_id * {BIG} END AS amount,
               CASE WHEN event_id % 5 < 3 THEN epoch_us(ts) // 1000 END AS time_ms,
               CASE WHEN event_id % 5 = 3 THEN {_HEAD} END AS bad_record
        FROM events""",
    "iso_times": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso, epoch_us(ts) // 1000 AS back_ms FROM events""",
    "upper_fields": """
        SELECT event_id, upper(coalesce(event_type, '')) || '|' || upper(coalesce(props, '')) AS fields FROM events""",
    "partition_counts": """
        SELECT event_type, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_partitions, CAST(1 AS BIGINT) AS n_tasks,
               true AS in_range FROM events GROUP BY event_type""",
    "top3_parsed": RANK_SQL["top3_news"],
    "labeled_rows": "SELECT 'events' AS label, event_id, event_type FROM events",
    "tumbling_lines": f"""
        SELECT 'name= ' || CAST(user_id AS VARCHAR) || ' window start=' || strftime(window_start, '%Y-%m-%d %H:%M:%S')
               || ' window end=' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || ' count= ' || CAST(count AS VARCHAR) AS line
        FROM ({WINDOW_SQL["tumbling_count"]})""",
}

QUERIES = {
    "decoded_events": decoded_events,
    "iso_times": iso_times,
    "upper_fields": upper_fields,
    "partition_counts": partition_counts,
    "top3_parsed": top3_parsed,
    "labeled_rows": labeled_rows,
    "tumbling_lines": tumbling_lines,
}
