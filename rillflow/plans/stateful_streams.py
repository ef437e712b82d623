"""Streams that need keyed state beyond Spark's built-in aggregates: running balance,
table x table join, re-grouped count with retraction, as-of enrichment, time-limited
table output, and the top-3 over a stream-static join. Each runs over the driver
tables read as file streams and returns the table its sink holds afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.time import as_event_time, money
from rillflow.operators.tables import latest_per_key
from rillflow.plans.balances import ORACLE as BALANCE_SQL
from rillflow.plans.counting import ORACLE as COUNT_SQL
from rillflow.plans.enrich import ORACLE as ENRICH_SQL
from rillflow.plans.enrich import enriched_text
from rillflow.plans.ranking import ORACLE as RANK_SQL
from rillflow.plans.ranking import top3_order
from rillflow.plans.table_ops import WATCH_SQL, watch_list
from rillflow.plans.windowed import ORACLE as WINDOW_SQL
from rillflow.plans.windowed import SESSION_GAP_SECONDS
from rillflow.sources.tables import (
    EVENTS_SCHEMA,
    arriving_table,
    file_stream,
    read_table,
)
from rillflow.streaming import stateful as S
from rillflow.streaming.runner import run_stream
from rillflow.streaming.tables import running_sums

# Fixed values from the reference programs: hold table updates one minute; event
# time runs two minutes behind the newest event (the grace).
HOLD_MS = 60_000
GRACE = "2 minutes"
GRACE_MS = 120_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arriving_table(spark, sf_dir, "events", "event_id", schema=EVENTS_SCHEMA)


def running_balance_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running balance over a table of carried balances: DataFrame functions alone, and a user
    with most of a micro-batch's rows is spread over offset buckets."""
    ev = _events(spark, sf_dir).select("user_id", "event_id", "ts", money("value").alias("amount"))
    run = running_sums(spark, ev, "user_id", "amount", "event_id", "running_bal").wait()
    return run.result(T.StructType([*ev.schema.fields, T.StructField("running_bal", T.DecimalType(28, 2))]))


def latest_login_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table_from_changelog(_login_changes(spark, sf_dir)).select(
        F.col("key").alias("user_id"), F.col("value").cast("timestamp_ntz").alias("login_time"))


def latest_login_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row the table join emits: each change of either side, once both are there."""
    return _login_changes(spark, sf_dir).select(
        F.col("key").alias("user_id"), F.col("seq").alias("event_id"),
        F.col("value").cast("timestamp_ntz").alias("login_time"), "deleted")


def _login_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)

    def side(t: str) -> DataFrame:
        return ev.filter(F.col("event_type") == t).select(
            F.col("user_id").alias("key"), as_event_time("ts").alias("ts"),
            F.col("event_id").alias("seq"), F.col("ts").cast("string").alias("value"))

    return run_stream(spark, S.table_join(side("click"), side("purchase")),
                      "latest_login").wait().result()


def favourite_colour_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select(
        F.col("user_id").alias("key"), as_event_time("ts").alias("ts"),
        F.col("event_id").alias("seq"), F.col("event_type").alias("value"))
    # two chained queries: the processor's signed deltas go to a file sink; a second
    # stream sums them per colour (state: one row per colour), so each trigger costs
    # its own batch, never the whole delta history
    deltas = run_stream(spark, S.group_deltas(ev), "favourite_colour").wait()
    delta_stream = file_stream(spark, deltas.output, deltas.schema)
    counts = S.counts_from_deltas(delta_stream, "colour")
    return run_stream(spark, counts, "favourite_colour_counts", mode="update",
                      key_cols=["colour"]).wait().result()


def purchase_asof_left_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    changes = ev.filter(F.col("event_type").isin("signup", "error")).select(
        F.col("user_id").alias("key"), as_event_time("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "signup", F.col("props")).alias("info"))
    purchases = ev.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("key"), as_event_time("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        F.concat("event_type", F.lit("("), F.col("event_id").cast("string"), F.lit(")"))
        .alias("payload"))
    out = run_stream(spark, S.asof_lookup(changes, purchases), "purchase_asof").wait().result()
    return out.select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"),
                      enriched_text(F.col("payload"), F.col("info")).alias("enriched"))


def stock_filter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock filter with its emission held one minute of event time per key: the
    table is filtered (a failing update becomes a delete), updates are held, and the
    newest is sent once the watermark passes the first held update + 1 minute."""
    table = latest_per_key(_stock_emissions(spark, sf_dir), "key", ["value", "deleted"], ["seq"],
                           tombstone=F.col("deleted"))
    return table.select(F.col("key").alias("user_id"), F.col("value").alias("event_type"))


def stock_filter_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every emission of the held stock filter, deletes included."""
    return _stock_emissions(spark, sf_dir).select(
        F.col("key").alias("user_id"), F.col("seq").alias("event_id"),
        F.col("value").alias("event_type"), "deleted")


def _stock_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = (_events(spark, sf_dir).withColumn("__et", as_event_time("ts"))
          .withWatermark("__et", GRACE))
    watched = ev.join(watch_list(spark, sf_dir), "user_id", "left_semi")
    changes = watched.select(
        F.col("user_id").alias("key"), F.col("__et").alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(F.length("event_type") > 0, F.col("event_type")).alias("value"))
    return run_stream(spark, S.hold_newest(changes, HOLD_MS), "stock_filter").wait().result()


def top3_news_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are counted per inventory id in state (update mode), so a micro-batch meets the
    inventory only with the ids whose counts changed; counts per type, and the top 3, come
    from the table of counts."""
    clicks = arriving_table(spark, sf_dir, "lineitem", "l_orderkey", columns=["l_orderkey", "l_partkey"]).select("l_partkey")
    counts = clicks.filter(F.col("l_partkey").isNotNull()).groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("clicks"))
    now = run_stream(spark, counts, "top3_news", mode="update", key_cols=["l_partkey"]).wait().result()
    inv = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    by_type = now.join(inv, now["l_partkey"] == inv["p_partkey"]) \
        .groupBy(F.col("p_type").alias("news_type")).agg(F.sum("clicks").alias("clicks"))
    return by_type.orderBy(*top3_order()).limit(3)


# holds by event time: one opens at the first row from the last one's end on; the newest row
# before its end goes out if the watermark has passed it
_EMISSIONS = f"""
    WITH RECURSIVE w AS (
        SELECT user_id, event_id, epoch_us(ts) // 1000 AS t,
               CASE WHEN length(event_type) > 0 THEN event_type END AS event_type
        FROM events WHERE user_id IN ({WATCH_SQL})),
    holds(user_id, start) AS (
        SELECT user_id, min(t) FROM w GROUP BY user_id
        UNION ALL
        SELECT h.user_id, (SELECT min(w.t) FROM w WHERE w.user_id = h.user_id AND w.t >= h.start + {HOLD_MS})
        FROM holds h WHERE h.start IS NOT NULL)
    SELECT h.user_id, arg_max(w.event_id, (w.t, w.event_id)) AS event_id,
           arg_max_null(w.event_type, (w.t, w.event_id)) AS event_type,
           arg_max_null(w.event_type, (w.t, w.event_id)) IS NULL AS deleted
    FROM holds h JOIN w ON w.user_id = h.user_id AND w.t >= h.start AND w.t < h.start + {HOLD_MS}
    WHERE h.start + {HOLD_MS} <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - {GRACE_MS}
    GROUP BY h.user_id, h.start"""

ORACLE = {
    "running_balance_stream": BALANCE_SQL["running_balance"],
    "latest_login_stream": ENRICH_SQL["latest_login"],
    "favourite_colour_stream": COUNT_SQL["favourite_colour"],
    "purchase_asof_left_stream": ENRICH_SQL["purchase_asof_left"],
    "stock_filter_stream": f"""
        SELECT user_id, event_type FROM (
            SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(deleted, event_id) AS deleted
            FROM ({_EMISSIONS}) GROUP BY user_id) WHERE NOT deleted""",
    "stock_filter_changes_stream": _EMISSIONS,
    "top3_news_stream": RANK_SQL["top3_news"],
}

QUERIES = {
    "running_balance_stream": running_balance_stream,
    "latest_login_stream": latest_login_stream,
    "favourite_colour_stream": favourite_colour_stream,
    "purchase_asof_left_stream": purchase_asof_left_stream,
    "stock_filter_stream": stock_filter_stream,
    "stock_filter_changes_stream": stock_filter_changes_stream,
    "top3_news_stream": top3_news_stream,
}


def session_count_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with every update emitted (merges send deletes for the sessions they
    replace); the current sessions are the newest non-deleted emission per session."""
    cur = S.sessions_from_updates(_session_updates(spark, sf_dir))
    return cur.select(F.col("key").alias("user_id"),
                      F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "count")


def session_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every update of the live sessions, and the delete of each version it replaces."""
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return _session_updates(spark, sf_dir).select(
        F.col("key").alias("user_id"), F.col("seq").alias("event_id"), at("start_us").alias("window_start"),
        at("end_us").alias("window_end"), "count", "deleted")


def _session_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = (_events(spark, sf_dir).withColumn("__et", as_event_time("ts"))
          .withWatermark("__et", GRACE)
          .select(F.col("user_id").alias("key"), F.col("__et").alias("ts"),
                  F.col("event_id").alias("seq")))
    return run_stream(spark, S.live_sessions(ev, SESSION_GAP_SECONDS), "live_sessions").wait().result()


# the events are in the order of their times, so each one is its session's newest version
ORACLE["session_changes_stream"] = f"""
    WITH marked AS (
        SELECT user_id, event_id, ts, lag(ts) OVER w AS before,
               CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {SESSION_GAP_SECONDS} SECONDS
                    THEN 1 ELSE 0 END AS new
        FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    placed AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM marked),
    versions AS (SELECT *, min(ts) OVER s AS window_start, count(*) OVER s AS n FROM placed
                 WINDOW s AS (PARTITION BY user_id, sid ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT user_id, event_id, window_start, ts AS window_end, n AS count, false AS deleted FROM versions
    UNION ALL
    SELECT user_id, event_id, window_start, before, n - 1, true FROM versions WHERE n > 1"""
ORACLE["latest_login_changes_stream"] = """
    SELECT user_id, event_id, login_time, false AS deleted FROM (
        SELECT user_id, event_id,
               last_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) OVER w AS login_time,
               count(*) FILTER (WHERE event_type = 'click') OVER w AS clicks
        FROM events WHERE event_type IN ('click', 'purchase') AND user_id IS NOT NULL
        WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WHERE login_time IS NOT NULL AND clicks > 0"""
QUERIES["session_changes_stream"] = session_changes_stream
QUERIES["latest_login_changes_stream"] = latest_login_changes_stream
ORACLE["session_count_live"] = WINDOW_SQL["session_count"]
QUERIES["session_count_live"] = session_count_live
