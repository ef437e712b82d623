"""Streams whose state is a table, and folds of a user's own: top 3 after every micro-batch, totals
of a table grouped anew, purchases with a table that arrives as a changelog, folded balances."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.time import as_event_time, from_cents, money
from rillflow.operators.folds import Fold, finish_states, fold_by, of_records
from rillflow.plans.counting import ORACLE as COUNT_SQL
from rillflow.plans.enrich import enriched_text
from rillflow.plans.ranking import K
from rillflow.sources.tables import EVENTS_SCHEMA, arriving_table, read_table
from rillflow.streaming import tables as ST

#: Micro-batches that the tables arrive in.
BATCHES = 3


def _edges(table: str, offset: str) -> str:
    """SQL: ``batch`` and the offset that its rows and those of earlier ones are below."""
    return f"""SELECT b AS batch, lo + (hi - lo + 1) * (b + 1) // {BATCHES} AS edge
        FROM (SELECT min({offset}) AS lo, max({offset}) AS hi FROM {table}), range({BATCHES}) r(b)"""


# ---------------------------------------------------------------- top 3 after every micro-batch
def top3_news_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 3 after every micro-batch of clicks: a click's count leaves and re-enters a bounded
    ranking, shard by shard. Clicks are counted per inventory id before they meet the inventory."""
    clicks = arriving_table(spark, sf_dir, "lineitem", "l_orderkey", BATCHES, columns=["l_orderkey", "l_partkey"])
    inventory = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])

    def per_type(batch: DataFrame) -> DataFrame:
        per_id = batch.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
        return per_id.join(inventory, per_id["l_partkey"] == inventory["p_partkey"]).select(F.col("p_type").alias("name"), "n")

    run = ST.ranked(spark, clicks, per_type, K).wait()
    schema = T.StructType.fromDDL("batch bigint, rank bigint, name string, count bigint")
    return run.result(schema).select("batch", "rank", F.col("name").alias("news_type"), F.col("count").alias("clicks"))


# ---------------------------------------------------------------- adder and subtractor
def colour_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of each current colour (their newest event type), and the sum of their newest values: a
    change takes a user's old value off the old colour and adds the new one to the new colour."""
    ev = arriving_table(spark, sf_dir, "events", "event_id", BATCHES, schema=EVENTS_SCHEMA).select(
        "user_id", F.col("event_type").alias("colour"), money("value").alias("value"), "event_id")
    run, totals = ST.regrouped_totals(
        spark, ev, "user_id", "colour", "value", "event_id",
        adder={"people": lambda v: F.lit(1), "total": lambda v: v},
        subtractor={"people": lambda v: F.lit(-1), "total": lambda v: -v},
        types={"people": "bigint", "total": "decimal(28,2)"})
    last = run.wait().last_batch()
    return (totals.at(last) if last >= 0 else spark.createDataFrame([], totals.schema)).select("colour", "people", "total")


# ---------------------------------------------------------------- a table that arrives as a changelog
def purchase_refresh_changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with its user's info as the user table is after the purchase's micro-batch. The
    table itself arrives with the purchases (signups set a user's info, errors delete it)."""
    ev = arriving_table(spark, sf_dir, "events", "event_id", BATCHES, schema=EVENTS_SCHEMA) \
        .filter(F.col("event_type").isin("signup", "error", "purchase")).select(
        "user_id", "event_id", "event_type", F.when(F.col("event_type") == "signup", F.col("props")).alias("info"))
    run = ST.looked_up(spark, ev, F.col("event_type") != "purchase", "user_id", "info", "event_id", "user_id").wait()
    out = run.result(T.StructType.fromDDL("user_id bigint, event_id bigint, event_type string, info string"))
    purchase = F.concat("event_type", F.lit("("), F.col("event_id").cast("string"), F.lit(")"))
    return out.select("user_id", "event_id", enriched_text(purchase, F.col("info")).alias("enriched"))


# ---------------------------------------------------------------- folds of a user's own
def _balance_step(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    return rows.groupby(keys, as_index=False).agg(txn_count=("cents", "size"), cents=("cents", "sum"), micros=("micros", "max"))


def _balance_merge(states: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    return states.groupby(keys, as_index=False).agg(txn_count=("txn_count", "sum"), cents=("cents", "sum"), micros=("micros", "max"))


#: The bank balance as a user would write it: (0, 0, epoch), then count + 1, balance + amount, newest time.
BALANCE = Fold("txn_count bigint, cents bigint, micros bigint", _balance_step, _balance_merge,
               "txn_count bigint, cents bigint, micros bigint", lambda states: states)

#: The largest amounts of a key, each once, in a bounded set: a fold that Spark has no function for.
#: Written with functions of one record: init, step, merge, finish.
LARGEST = of_records(
    init=lambda: ([],),
    step=lambda state, record: (_largest([*state[0], record[0]]),),
    merge=lambda a, b: (_largest([*a[0], *b[0]]),),
    finish=lambda state: (",".join(map(str, state[0])),),
    columns=["cents"], state="top array<bigint>", result="largest string")


def _largest(cents: list) -> list:
    return sorted({int(c) for c in cents if c is not None}, reverse=True)[:K]


def _folded_rows(events: DataFrame) -> DataFrame:
    cents = (money("value") * 100).cast("long")
    return events.select("user_id", F.coalesce(cents, F.lit(0)).alias("cents"),
                         F.greatest(F.unix_micros(as_event_time("ts")), F.lit(0)).alias("micros"))


def _as_balance(folded: DataFrame) -> DataFrame:
    return folded.select("user_id", "txn_count", from_cents("cents").alias("balance"),
                         F.timestamp_micros("micros").cast("timestamp_ntz").alias("last_time"))


def bank_balance_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bank balance by the user's own aggregator."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "value", "ts"])
    return _as_balance(fold_by(_folded_rows(ev), "user_id", BALANCE))


def bank_balance_fold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a stream, states kept in a table."""
    ev = arriving_table(spark, sf_dir, "events", "event_id", BATCHES, schema=EVENTS_SCHEMA)
    run, states = ST.folded(spark, _folded_rows(ev), "user_id", BALANCE)
    last = run.wait().last_batch()
    now = states.at(last) if last >= 0 else spark.createDataFrame([], states.schema)
    return _as_balance(finish_states(now, ["user_id"], BALANCE))


def largest_amounts_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's three largest distinct amounts, in cents."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "value"])
    rows = ev.select("user_id", (money("value") * 100).cast("long").alias("cents"))
    return fold_by(rows, "user_id", LARGEST)


QUERIES = {
    "top3_news_changes_stream": top3_news_changes_stream,
    "colour_totals_stream": colour_totals_stream,
    "purchase_refresh_changelog_stream": purchase_refresh_changelog_stream,
    "bank_balance_fold": bank_balance_fold,
    "bank_balance_fold_stream": bank_balance_fold_stream,
    "largest_amounts_fold": largest_amounts_fold,
}

ORACLE = {
    "top3_news_changes_stream": f"""
        WITH edges AS ({_edges("lineitem", "l_orderkey")}),
        counts AS (SELECT batch, p_type AS news_type, count(*) AS clicks
                   FROM lineitem JOIN part ON l_partkey = p_partkey JOIN edges ON l_orderkey < edge GROUP BY ALL)
        SELECT batch, rank, news_type, clicks FROM (
            SELECT *, row_number() OVER (PARTITION BY batch ORDER BY clicks DESC, news_type) AS rank FROM counts)
        WHERE rank <= {K}""",
    "colour_totals_stream": """
        WITH latest AS (SELECT user_id, arg_max_null(event_type, event_id) AS colour,
                               arg_max_null(CAST(value AS DECIMAL(18,2)), event_id) AS value
                        FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
        seen AS (SELECT DISTINCT event_type AS colour FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL)
        SELECT s.colour, count(l.user_id) AS people, CAST(coalesce(sum(l.value), 0) AS DECIMAL(28,2)) AS total
        FROM seen s LEFT JOIN latest l ON l.colour = s.colour GROUP BY s.colour""",
    "purchase_refresh_changelog_stream": f"""
        WITH edges AS ({_edges("events", "event_id")}),
        purchases AS (SELECT user_id, event_id, (SELECT min(edge) FROM edges WHERE e.event_id < edge) AS edge
                      FROM events e WHERE event_type = 'purchase' AND user_id IS NOT NULL),
        found AS (SELECT p.user_id, p.event_id,
                         (SELECT arg_max_null(CASE WHEN c.event_type = 'signup' THEN c.props END, c.event_id) FROM events c
                          WHERE c.user_id = p.user_id AND c.event_type IN ('signup', 'error') AND c.event_id < p.edge) AS info
                  FROM purchases p)
        SELECT user_id, event_id, 'purchase purchase(' || event_id || ') ' ||
               CASE WHEN info IS NULL THEN 'info=null' ELSE 'info=[' || info || ']' END AS enriched FROM found""",
    "bank_balance_fold": COUNT_SQL["bank_balance_aggregate"],
    "bank_balance_fold_stream": COUNT_SQL["bank_balance_aggregate"],
    "largest_amounts_fold": f"""
        SELECT user_id, coalesce(string_agg(CAST(cents AS VARCHAR), ',' ORDER BY cents DESC), '') AS largest FROM (
            SELECT user_id, cents, row_number() OVER (PARTITION BY user_id ORDER BY cents DESC NULLS LAST) AS n FROM (
                SELECT DISTINCT user_id, CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM events WHERE user_id IS NOT NULL))
        WHERE n <= {K} GROUP BY user_id""",
}
