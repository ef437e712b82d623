"""The stock filter: a table (latest value per symbol) filtered to a watch list of
keys with a non-empty value. The reference lists two symbols; here the list is a table
(users who are customers of one segment), so the kept share grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.tables import filter_table, latest_per_key
from rillflow.sources.tables import read_table

WATCH_SEGMENT = "BUILDING"


def stock_filter(changes: DataFrame, key: str, value: str, order: list[str],
                 keep_keys) -> DataFrame:
    """Latest value per key, kept when the key is on the watch list and the value is
    not empty. The filter runs on the table, so a key whose latest value became empty or
    null is gone (a delete downstream).

    ``keep_keys`` is either a few literal keys (a filter on the grouping key, which
    Catalyst moves below the aggregation into the scan) or a DataFrame of keys in a
    column named like ``key`` (a left-semi join; Spark broadcasts it only when its size
    check allows)."""
    if isinstance(keep_keys, DataFrame):
        # on the grouping key, so it commutes with the aggregate: unwatched rows go first
        changes = changes.join(keep_keys.select(key).distinct(), key, "left_semi")
        return filter_table(latest_per_key(changes, key, [value], order), F.length(value) > 0)
    table = latest_per_key(changes, key, [value], order)
    return filter_table(table, F.col(key).isin(*keep_keys) & (F.length(value) > 0))


def watch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys to keep: users who are customers of one segment."""
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"]) \
        .filter(F.col("c_mktsegment") == WATCH_SEGMENT) \
        .select(F.col("c_custkey").alias("user_id"))


def stock_filter_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type"])
    return stock_filter(ev, "user_id", "event_type", ["event_id"], watch_list(spark, sf_dir))


WATCH_SQL = f"SELECT c_custkey FROM customer WHERE c_mktsegment = '{WATCH_SEGMENT}'"

ORACLE = {
    "stock_filter": f"""
        SELECT user_id, event_type FROM (
            SELECT user_id, arg_max_null(event_type, event_id) AS event_type
            FROM events GROUP BY user_id)
        WHERE user_id IN ({WATCH_SQL}) AND length(event_type) > 0""",
}

QUERIES = {"stock_filter": stock_filter_on_tables}
