"""Word count, favourite colour and the bank balance (fold and reduce)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.functions.text import WORD_SEPARATOR, java_pieces
from rillflow.operators.aggregates import balance_fold, balance_reduce, count_by
from rillflow.sources.tables import read_table


def word_count(lines: DataFrame, text: str = "text") -> DataFrame:
    """Words of every line (lower-cased, split on non-word runs) counted over all lines.
    Works on a stream too (update or complete mode)."""
    pieces = lines.select(F.split(F.lower(text), WORD_SEPARATOR).alias("__w"))  # one pass over each text
    return count_by(pieces.select(F.explode(java_pieces(F.col("__w"))).alias("word")), "word")


def word_count_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(read_table(spark, sf_dir, "documents", ["text"]))


def favourite_colour(changes: DataFrame, user: str, colour: str, order: str,
                     keep_zero: bool = True) -> DataFrame:
    """Users per *current* colour: the latest colour of each user, counted per colour.
    A user who changes colour moves from the old count to the new one; colours that
    fell to zero stay with 0 when ``keep_zero``.

    One pass: the newest ``order`` of each (user, colour) is a hash aggregate that combines on
    the map side; among a user's few colours the newest is the current one, and the colours
    with none left are the zero rows.
    """
    newest = changes.groupBy(user, colour).agg(F.max(order).alias("__at"))
    last = Window.partitionBy(user).orderBy(F.col("__at").desc())
    current = F.col(user).isNotNull() & (F.row_number().over(last) == 1)
    counts = newest.withColumn("__current", current).filter(F.col(colour).isNotNull()) \
        .groupBy(F.col(colour).alias("colour")).agg(F.count_if("__current").alias("count"))
    return counts if keep_zero else counts.filter("count > 0")


def favourite_colour_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type"])
    return favourite_colour(ev, "user_id", "event_type", "event_id")


def _balance_input(spark, sf_dir):
    return read_table(spark, sf_dir, "events", ["user_id", "value", "ts"])


def bank_balance_aggregate_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance_fold(_balance_input(spark, sf_dir), "user_id", "value", "ts",
                        "txn_count", "balance", "last_time")


def bank_balance_reduce_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance_reduce(_balance_input(spark, sf_dir), "user_id", "value", "ts",
                          "txn_count", "balance", "last_time")


WORDS_SQL = r"""
case when lower(text) = '' then ['']
     when regexp_replace(lower(text), '\W+$', '') = '' then []::varchar[]
     else regexp_split_to_array(regexp_replace(lower(text), '\W+$', ''), '\W+') end
"""

ORACLE = {
    "word_count": f"""
        SELECT word, count(*) AS count
        FROM (SELECT unnest({WORDS_SQL}) AS word FROM documents WHERE text IS NOT NULL)
        GROUP BY word""",
    "favourite_colour": """
        WITH cur AS (SELECT user_id, arg_max_null(event_type, event_id) AS colour
                     FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
             cnt AS (SELECT colour, count(*) AS n FROM cur
                     WHERE colour IS NOT NULL GROUP BY colour),
             seen AS (SELECT DISTINCT event_type AS colour FROM events
                      WHERE event_type IS NOT NULL)
        SELECT seen.colour, coalesce(cnt.n, 0) AS count
        FROM seen LEFT JOIN cnt ON seen.colour = cnt.colour""",
    "bank_balance_aggregate": """
        SELECT user_id, count(*) AS txn_count,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS balance,
               greatest(max(ts), TIMESTAMP '1970-01-01 00:00:00') AS last_time
        FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
    "bank_balance_reduce": """
        SELECT user_id, count(*) AS txn_count,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS balance,
               max(ts) AS last_time
        FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
}

QUERIES = {
    "word_count": word_count_on_tables,
    "favourite_colour": favourite_colour_on_tables,
    "bank_balance_aggregate": bank_balance_aggregate_on_tables,
    "bank_balance_reduce": bank_balance_reduce_on_tables,
}
