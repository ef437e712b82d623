"""Top-3 news types by ad clicks: clicks look up their inventory's news type, clicks
are counted per type, the three largest counts are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.topk import top_k, top_k_array
from rillflow.sources.tables import read_table

K = 3


def clicks_by_type(clicks: DataFrame, inventories: DataFrame, click_key: str,
                   inv_key: str, news_type: str) -> DataFrame:
    """Clicks per news type. Clicks are first counted per inventory id (a partial
    aggregate: a hot inventory collapses on the map side), then the per-id counts look
    up their type and are summed per type. Same result as join-then-count, since each
    click joins exactly the inventory rows of its id."""
    per_id = clicks.groupBy(F.col(click_key).alias("__id")).agg(
        F.count(F.lit(1)).alias("__n"))
    inv = inventories.select(F.col(inv_key).alias("__id"), F.col(news_type).alias("news_type"))
    return (per_id.join(inv, "__id", "inner")
            .groupBy("news_type").agg(F.sum("__n").alias("clicks")))


def top3_order():
    # clicks descending, then news type ascending
    return [F.col("clicks").desc(), F.col("news_type").asc()]


def top3_news(clicks: DataFrame, inventories: DataFrame, click_key: str, inv_key: str,
              news_type: str, k: int = K) -> DataFrame:
    """The k news types with most clicks, one row each, ranked."""
    counts = clicks_by_type(clicks, inventories, click_key, inv_key, news_type)
    return top_k(counts, top3_order(), k)


def top3_sorted(counts: DataFrame, k: int = K) -> DataFrame:
    """One row: the top k as a sorted ``array<struct<NewsType, Clicks>>`` and as JSON
    text (the top-3 value written to the output topic)."""
    named = counts.select(F.col("news_type").alias("NewsType"),
                          F.col("clicks").alias("Clicks"))
    arr = top_k_array(named, ["NewsType", "Clicks"],
                      [F.col("Clicks").desc(), F.col("NewsType").asc()], k,
                      F.struct((-F.col("Clicks")).alias("c"), F.col("NewsType").alias("t")),
                      "top3")
    return arr.select(F.to_json("top3").alias("top3_sorted"))


TOP3_TYPE = "array<struct<NewsType:string,Clicks:bigint>>"


def parse_top3(text) -> F.Column:
    """The top-3 JSON text back to ``array<struct<NewsType, Clicks>>``."""
    return F.from_json(text, TOP3_TYPE)


def _tables(spark, sf_dir):
    clicks = read_table(spark, sf_dir, "lineitem", ["l_partkey"])
    inv = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    return clicks, inv


def top3_news_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, inv = _tables(spark, sf_dir)
    return top3_news(clicks, inv, "l_partkey", "p_partkey", "p_type")


def top3_news_json_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, inv = _tables(spark, sf_dir)
    return top3_sorted(clicks_by_type(clicks, inv, "l_partkey", "p_partkey", "p_type"))


def clicks_by_type_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, inv = _tables(spark, sf_dir)
    return clicks_by_type(clicks, inv, "l_partkey", "p_partkey", "p_type")


_COUNTS = """(SELECT p_type AS news_type, count(*) AS clicks
             FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type)"""

ORACLE = {
    "top3_news": f"""
        SELECT news_type, clicks FROM {_COUNTS}
        ORDER BY clicks DESC, news_type ASC LIMIT 3""",
    "top3_news_json": f"""
        SELECT to_json(list({{'NewsType': news_type, 'Clicks': clicks}}
                            ORDER BY clicks DESC, news_type ASC))::VARCHAR AS top3_sorted
        FROM (SELECT news_type, clicks FROM {_COUNTS}
              ORDER BY clicks DESC, news_type ASC LIMIT 3)""",
    "clicks_by_type": f"SELECT news_type, clicks FROM {_COUNTS}",
}

QUERIES = {
    "top3_news": top3_news_on_tables,
    "top3_news_json": top3_news_json_on_tables,
    "clicks_by_type": clicks_by_type_on_tables,
}
