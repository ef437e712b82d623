"""Queries run as streams. First the windowed counts: the events table read as a file stream, event
time with a watermark two minutes behind (the reference's grace), append mode (one
final row per window once it closes), run with ``availableNow``.

A window is final once the watermark (latest event time, cut to milliseconds, minus
the grace) reaches its end; windows still open when the input ends are not emitted,
which is what the reference's suppressed output shows too. The oracle SQL applies the
same closing rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.operators.aggregates import balance_fold
from rillflow.operators.joins import lookup_join
from rillflow.operators.tables import latest_per_key
from rillflow.operators.windows import hopping_count, session_count_stream, tumbling_count
from rillflow.plans.counting import ORACLE as COUNT_SQL
from rillflow.plans.counting import word_count
from rillflow.plans.enrich import ORACLE as ENRICH_SQL
from rillflow.plans.enrich import user_table, enriched_text, recharge_match
from rillflow.plans.windowed import (
    GRACE,
    HOP_SIZE,
    HOP_SLIDE,
    ORACLE as WINDOW_SQL,
    SESSION_GAP_SECONDS,
    TUMBLE,
)
from rillflow.sources.tables import EVENTS_SCHEMA, arriving_table
from rillflow.streaming.lookup import enrich_each_batch
from rillflow.streaming.runner import run_stream
from rillflow.streaming.state import read_state

GRACE_SECONDS = 120


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arriving_table(spark, sf_dir, "events", "event_id", schema=EVENTS_SCHEMA)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arriving(spark, sf_dir).select("user_id", "ts")


def tumbling_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tumbling_count(_events(spark, sf_dir), "user_id", "ts", TUMBLE, grace=GRACE)
    return run_stream(spark, s, "tumbling_count").wait().result()


def hopping_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = hopping_count(_events(spark, sf_dir), "user_id", "ts", HOP_SIZE, HOP_SLIDE, grace=GRACE)
    return run_stream(spark, s, "hopping_count").wait().result()


def session_count_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = session_count_stream(_events(spark, sf_dir), "user_id", "ts", SESSION_GAP_SECONDS,
                             grace=GRACE)
    return run_stream(spark, s, "session_count").wait().result()


def _closed(sql: str, end_expr: str = "window_end") -> str:
    return f"""
        SELECT * FROM ({sql})
        WHERE {end_expr} <= (SELECT date_trunc('millisecond', max(ts)) FROM events)
                            - INTERVAL {GRACE_SECONDS} SECONDS"""


ORACLE = {
    "tumbling_count_stream": _closed(WINDOW_SQL["tumbling_count"]),
    "hopping_count_stream": _closed(WINDOW_SQL["hopping_count"]),
    # a session closes when the watermark passes its last event + gap
    "session_count_stream": _closed(WINDOW_SQL["session_count"],
                                    f"window_end + INTERVAL {SESSION_GAP_SECONDS} SECONDS"),
}

QUERIES = {
    "tumbling_count_stream": tumbling_count_stream,
    "hopping_count_stream": hopping_count_stream,
    "session_count_stream": session_count_stream_q,
}


# ---------------------------------------------------------------- keyed counts, joins
# Fixed value: the reference's stream join sets no grace; its library then keeps join
# state 24 hours. Used as the watermark delay of both join sides.
JOIN_GRACE = "24 hours"


def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running word counts in update mode: each batch sends the words whose count
    changed; the sink's table is the newest count per word."""
    docs = arriving_table(spark, sf_dir, "documents", "doc_id", columns=["doc_id", "text"]).select("text")
    return run_stream(spark, word_count(docs), "word_count", mode="update",
                      key_cols=["word"]).wait().result()


def bank_balance_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balance fold in update mode into a compacted output: each batch is merged
    into the newest-row-per-user snapshot, written as a new version."""
    ev = _arriving(spark, sf_dir) \
        .select("user_id", "value", "ts")
    agg = balance_fold(ev, "user_id", "value", "ts", "txn_count", "balance", "last_time")
    return run_stream(spark, agg, "bank_balance", mode="upsert",
                      key_cols=["user_id"]).wait().result()


def recharge_match_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream x stream join within five minutes, both sides watermarked (append)."""
    ev = _arriving(spark, sf_dir) \
        .withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", JOIN_GRACE)

    def side(t):
        return ev.filter(F.col("event_type") == t).select(
            F.col("user_id").alias("user"), F.col("event_id").alias("id"), "ts",
            F.col("props").alias("otp"))
    out = run_stream(spark, recharge_match(side("click"), side("purchase")),
                     "recharge_match").wait().result()
    return out.withColumn("request_ts", F.col("request_ts").cast("timestamp_ntz")) \
        .withColumn("confirm_ts", F.col("confirm_ts").cast("timestamp_ntz"))


def purchase_enrich_left_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream x static table, left (append): each purchase looks up the user table."""
    ev = _arriving(spark, sf_dir)
    purchases = ev.filter(F.col("event_type") == "purchase").select(
        "user_id", "event_id",
        F.concat("event_type", F.lit("("), F.col("event_id").cast("string"), F.lit(")"))
        .alias("purchase"))
    j = lookup_join(purchases, user_table(spark, sf_dir), "user_id", "c_custkey", "left")
    out = j.select("user_id", "event_id",
                   enriched_text(F.col("purchase"), F.col("info")).alias("enriched"))
    return run_stream(spark, out, "purchase_enrich").wait().result()


ORACLE.update({
    "word_count_stream": COUNT_SQL["word_count"],
    "bank_balance_stream": COUNT_SQL["bank_balance_aggregate"],
    "recharge_match_stream": ENRICH_SQL["recharge_match"],
    "purchase_enrich_left_stream": ENRICH_SQL["purchase_enrich_left"],
})

QUERIES.update({
    "word_count_stream": word_count_stream,
    "bank_balance_stream": bank_balance_stream,
    "recharge_match_stream": recharge_match_stream,
    "purchase_enrich_left_stream": purchase_enrich_left_stream,
})


def purchase_enrich_refresh_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream x table, left, with the user table read again for every micro-batch, so a
    changing table is seen as it is when each batch runs."""
    ev = _arriving(spark, sf_dir)
    purchases = ev.filter(F.col("event_type") == "purchase").select(
        "user_id", "event_id",
        F.concat("event_type", F.lit("("), F.col("event_id").cast("string"), F.lit(")"))
        .alias("purchase"))

    def join(batch: DataFrame, users: DataFrame) -> DataFrame:
        j = lookup_join(batch, users, "user_id", "c_custkey", "left")
        return j.select("user_id", "event_id",
                        enriched_text(F.col("purchase"), F.col("info")).alias("enriched"))

    run = enrich_each_batch(spark, purchases, lambda: user_table(spark, sf_dir), join,
                            "purchase_enrich_refresh").wait()
    return run.result(T.StructType([T.StructField("user_id", T.LongType()),
                                    T.StructField("event_id", T.LongType()),
                                    T.StructField("enriched", T.StringType())]))


ORACLE["purchase_enrich_refresh_stream"] = ENRICH_SQL["purchase_enrich_left"]
QUERIES["purchase_enrich_refresh_stream"] = purchase_enrich_refresh_stream


def tumbling_open_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tumbling count's state after its run, read with the state data source: the
    windows the watermark has not closed yet (their counts so far)."""
    s = tumbling_count(_events(spark, sf_dir), "user_id", "ts", TUMBLE, grace=GRACE)
    run = run_stream(spark, s, "tumbling_state").wait()
    st = read_state(spark, run.checkpoint)
    return st.select(F.col("key.user_id").alias("user_id"),
                     F.col("key.window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("key.window.end").cast("timestamp_ntz").alias("window_end"),
                     F.col("value.count").alias("count"))


ORACLE["tumbling_open_state"] = f"""
    SELECT * FROM ({WINDOW_SQL["tumbling_count"]})
    WHERE window_end > (SELECT date_trunc('millisecond', max(ts)) FROM events)
                       - INTERVAL {GRACE_SECONDS} SECONDS"""
QUERIES["tumbling_open_state"] = tumbling_open_state


def latest_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table from a changelog stream: the newest ``event_type`` per user as one
    streaming ``max_by`` aggregation in update mode. Deletes are kept as rows in the
    output (a key whose newest change is a delete must leave the table downstream);
    the sink's table drops them after compaction."""
    ev = _arriving(spark, sf_dir)
    table = latest_per_key(ev, "user_id", ["event_type"], ["event_id"], keep_deletes=True)
    out = run_stream(spark, table, "latest_table", mode="update", key_cols=["user_id"]) \
        .wait().result()
    return out.filter(~F.col("__deleted")).select("user_id", "event_type")


ORACLE["latest_table_stream"] = """
    SELECT user_id, event_type FROM (
        SELECT user_id, arg_max_null(event_type, event_id) AS event_type
        FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
    WHERE event_type IS NOT NULL"""
QUERIES["latest_table_stream"] = latest_table_stream
