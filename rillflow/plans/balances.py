"""The running balance: every transaction with its user's balance after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.running import running_sum
from rillflow.sources.tables import read_table


def running_balance_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    out = running_sum(ev, "user_id", "value", "event_id", out="running_bal")
    return out.select("user_id", "event_id", "ts", F.col("value").alias("amount"),
                      "running_bal")


ORACLE = {
    "running_balance": """
        SELECT user_id, event_id, ts, CAST(value AS DECIMAL(18,2)) AS amount,
               CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (
                   PARTITION BY user_id ORDER BY event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2))
               AS running_bal
        FROM events WHERE user_id IS NOT NULL""",
}

QUERIES = {"running_balance": running_balance_on_tables}
