"""Windowed counts per user over the event stream: tumbling (30 s, and 1 h for a dense
variant), hopping (30 s every 15 s) and sessions (5 min gap)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillflow.operators.windows import hopping_count, session_count, tumbling_count
from rillflow.sources.tables import read_table

# Fixed values from the reference programs.
TUMBLE = "30 seconds"
HOP_SIZE, HOP_SLIDE = "30 seconds", "15 seconds"
GRACE = "2 minutes"
SESSION_GAP_SECONDS = 300


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", ["user_id", "ts"])


def tumbling_count_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_count(_events(spark, sf_dir), "user_id", "ts", TUMBLE)


def tumbling_count_1h_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_count(_events(spark, sf_dir), "user_id", "ts", "1 hour")


def hopping_count_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hopping_count(_events(spark, sf_dir), "user_id", "ts", HOP_SIZE, HOP_SLIDE)


def session_count_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_count(_events(spark, sf_dir), "user_id", "ts", SESSION_GAP_SECONDS)


def _tumble_sql(seconds: int) -> str:
    us = seconds * 1_000_000
    return f"""
        SELECT user_id, make_timestamp(b * {us}) AS window_start,
               make_timestamp((b + 1) * {us}) AS window_end, count(*) AS count
        FROM (SELECT user_id, floor(epoch_us(ts) / {us})::BIGINT AS b FROM events WHERE user_id IS NOT NULL)
        GROUP BY user_id, b"""


ORACLE = {
    "tumbling_count": _tumble_sql(30),
    "tumbling_count_1h": _tumble_sql(3600),
    "hopping_count": """
        SELECT user_id, make_timestamp(s) AS window_start,
               make_timestamp(s + 30000000) AS window_end, count(*) AS count
        FROM (SELECT user_id, (floor(epoch_us(ts) / 15000000)::BIGINT - k) * 15000000 AS s
              FROM events, (VALUES (0), (1)) AS o(k) WHERE user_id IS NOT NULL)
        GROUP BY user_id, s""",
    "session_count": """
        WITH marked AS (
            SELECT user_id, ts,
                   CASE WHEN lag(ts) OVER w IS NULL
                          OR ts - lag(ts) OVER w > INTERVAL 5 MINUTES THEN 1 ELSE 0 END AS st
            FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        numbered AS (
            SELECT user_id, ts, sum(st) OVER (PARTITION BY user_id ORDER BY ts
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM marked)
        SELECT user_id, min(ts) AS window_start, max(ts) AS window_end, count(*) AS count
        FROM numbered GROUP BY user_id, sid""",
}

QUERIES = {
    "tumbling_count": tumbling_count_on_tables,
    "tumbling_count_1h": tumbling_count_1h_on_tables,
    "hopping_count": hopping_count_on_tables,
    "session_count": session_count_on_tables,
}
