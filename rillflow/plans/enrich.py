"""Joins of the event stream: recharge matching (stream x stream in a time window),
purchase enrichment (stream x table: inner, left, as-of) and latest login
(table x table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.joins import (
    asof_join,
    interval_join,
    lookup_join,
    snapshot_lookup,
    table_join,
)
from rillflow.operators.tables import latest_per_key
from rillflow.sources.tables import read_table

# Fixed value from the reference program: requests and confirmations match within
# five minutes either way.
RECHARGE_WINDOW_SECONDS = 300


# ---------------------------------------------------------------- recharge match
def recharge_match(requests: DataFrame, confirmations: DataFrame,
                   within_seconds: int = RECHARGE_WINDOW_SECONDS) -> DataFrame:
    """Every (request, confirmation) pair of a user within the window; ``success``
    when both carry the same otp, else ``fail``. Inputs: ``user, id, ts, otp``."""
    r = requests.select(F.col("user").alias("r_user"), F.col("id").alias("request_id"),
                        F.col("ts").alias("request_ts"), F.col("otp").alias("r_otp"))
    c = confirmations.select(F.col("user").alias("c_user"), F.col("id").alias("confirm_id"),
                             F.col("ts").alias("confirm_ts"), F.col("otp").alias("c_otp"))
    j = interval_join(r, c, "r_user", "c_user", "request_ts", "confirm_ts", within_seconds)
    return j.select(F.col("r_user").alias("user_id"), "request_id", "confirm_id",
                    "request_ts", "confirm_ts",
                    F.when(F.col("r_otp") == F.col("c_otp"), "success").otherwise("fail")
                    .alias("result"))


def _recharge_inputs(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    def side(t):
        return ev.filter(F.col("event_type") == t).select(
            F.col("user_id").alias("user"), F.col("event_id").alias("id"), "ts",
            F.col("props").alias("otp"))
    return side("click"), side("purchase")


def recharge_match_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recharge_match(*_recharge_inputs(spark, sf_dir))


# ---------------------------------------------------------------- purchase enrich
# Matched pairs are "success" when the one-time passwords agree, else "fail"
# (above); the enriched text is "purchase <purchase> info=[<info>]", and
# "purchase <purchase> info=null" when the user has no info.
ENRICHED_FORMAT = "purchase %s info=[%s]"
UNMATCHED_FORMAT = "purchase %s info=null"


def enriched_text(purchase: F.Column, info: F.Column) -> F.Column:
    """The enriched purchase text, matched or not."""
    return F.when(info.isNull(), F.format_string(UNMATCHED_FORMAT, purchase)) \
        .otherwise(F.format_string(ENRICHED_FORMAT, purchase, info))


def _purchases(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type"])
    return ev.filter(F.col("event_type") == "purchase").select(
        "user_id", "event_id",
        F.concat("event_type", F.lit("("), F.col("event_id").cast("string"), F.lit(")"))
        .alias("purchase"))


def user_table(spark, sf_dir):
    """The whole user table: every customer."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    return c.select(
        "c_custkey", F.concat(F.lit("name="), "c_name", F.lit(", nation="),
                              F.col("c_nationkey").cast("string")).alias("info"))


def purchase_enrich(purchases: DataFrame, users: DataFrame, how: str) -> DataFrame:
    j = lookup_join(purchases, users, "user_id", "c_custkey", how)
    return j.select("user_id", "event_id", enriched_text(F.col("purchase"), F.col("info"))
                    .alias("enriched"))


def purchase_enrich_inner_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchase_enrich(_purchases(spark, sf_dir), user_table(spark, sf_dir), "inner")


def purchase_enrich_left_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchase_enrich(_purchases(spark, sf_dir), user_table(spark, sf_dir), "left")


def _user_changelog(spark, sf_dir):
    """A user-table changelog derived from the events: a signup sets the user's info
    (its props), an error deletes the user (tombstone)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"])
    return ev.filter(F.col("event_type").isin("signup", "error")).select(
        "user_id", "event_id",
        F.when(F.col("event_type") == "signup", F.col("props")).alias("info"))


def purchase_asof(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    j = asof_join(_purchases(spark, sf_dir), _user_changelog(spark, sf_dir), "user_id",
                  "event_id", ["info"], how=how)
    return j.select("user_id", "event_id", enriched_text(F.col("purchase"), F.col("info"))
                    .alias("enriched"))


def purchase_asof_inner_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchase_asof(spark, sf_dir, "inner")


def purchase_asof_left_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchase_asof(spark, sf_dir, "left")


def purchase_snapshot_left_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changelog, but every purchase sees the final table."""
    return _purchase_snapshot(spark, sf_dir, "left")


def purchase_snapshot_inner_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table again; purchases of users that it lacks are dropped."""
    return _purchase_snapshot(spark, sf_dir, "inner")


def _purchase_snapshot(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    j = snapshot_lookup(_purchases(spark, sf_dir),
                        _user_changelog(spark, sf_dir).withColumnRenamed("user_id", "c_custkey"),
                        "user_id", "c_custkey", ["info"], ["event_id"], how)
    return j.select("user_id", "event_id", enriched_text(F.col("purchase"), F.col("info")).alias("enriched"))


# ---------------------------------------------------------------- latest login
def latest_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table x table: the latest click per user (users-latest-login) joined with the
    latest purchase per user (user-logins); the result keeps the login's time."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    def latest(t, col):
        side = ev.filter(F.col("event_type") == t).select(
            "user_id", "event_id", F.col("ts").alias(col))
        return latest_per_key(side, "user_id", [col], ["event_id"])
    return table_join(latest("click", "last_click"), latest("purchase", "login_time"),
                      "user_id").select("user_id", "login_time")


_PURCHASES = """(SELECT user_id, event_id, ts,
                        event_type || '(' || CAST(event_id AS VARCHAR) || ')' AS purchase
                 FROM events WHERE event_type = 'purchase')"""
_USERS = """(SELECT c_custkey, 'name=' || c_name || ', nation=' || CAST(c_nationkey AS VARCHAR)
                     AS info FROM customer)"""
_ENRICHED = """CASE WHEN info IS NULL THEN 'purchase ' || purchase || ' info=null'
                    ELSE 'purchase ' || purchase || ' info=[' || info || ']' END"""
_CHANGELOG = """(SELECT user_id, ts, event_id,
                        CASE WHEN event_type = 'signup' THEN props END AS info
                 FROM events WHERE event_type IN ('signup', 'error'))"""
_ASOF = f"""
    SELECT p.user_id, p.event_id, p.purchase,
           (SELECT c.info FROM {_CHANGELOG} c
            WHERE c.user_id = p.user_id AND c.event_id < p.event_id
            ORDER BY c.event_id DESC LIMIT 1) AS info
    FROM {_PURCHASES} p WHERE p.user_id IS NOT NULL"""
_TABLE = f"""t AS (SELECT user_id AS c_custkey, arg_max_null(info, event_id) AS info
                   FROM {_CHANGELOG} GROUP BY user_id)"""


def _recharge_sql(seconds: int) -> str:
    return f"""
        SELECT r.user_id, r.event_id AS request_id, c.event_id AS confirm_id,
               r.ts AS request_ts, c.ts AS confirm_ts,
               CASE WHEN r.props = c.props THEN 'success' ELSE 'fail' END AS result
        FROM events r JOIN events c
          ON r.user_id = c.user_id
         AND c.ts BETWEEN r.ts - INTERVAL {seconds} SECONDS AND r.ts + INTERVAL {seconds} SECONDS
        WHERE r.event_type = 'click' AND c.event_type = 'purchase'"""


ORACLE = {
    "recharge_match": _recharge_sql(RECHARGE_WINDOW_SECONDS),
    "purchase_enrich_inner": f"""
        SELECT user_id, event_id, {_ENRICHED} AS enriched
        FROM {_PURCHASES} p JOIN {_USERS} u ON p.user_id = u.c_custkey""",
    "purchase_enrich_left": f"""
        SELECT user_id, event_id, {_ENRICHED} AS enriched
        FROM {_PURCHASES} p LEFT JOIN {_USERS} u ON p.user_id = u.c_custkey
        WHERE p.user_id IS NOT NULL""",
    "purchase_asof_inner": f"""
        SELECT user_id, event_id, {_ENRICHED} AS enriched FROM ({_ASOF}) WHERE info IS NOT NULL""",
    "purchase_asof_left": f"SELECT user_id, event_id, {_ENRICHED} AS enriched FROM ({_ASOF})",
    "purchase_snapshot_left": f"""
        WITH {_TABLE}
        SELECT p.user_id, p.event_id, {_ENRICHED} AS enriched
        FROM {_PURCHASES} p LEFT JOIN t ON p.user_id = t.c_custkey WHERE p.user_id IS NOT NULL""",
    "purchase_snapshot_inner": f"""
        WITH {_TABLE}
        SELECT p.user_id, p.event_id, {_ENRICHED} AS enriched
        FROM {_PURCHASES} p JOIN t ON p.user_id = t.c_custkey WHERE t.info IS NOT NULL""",
    "latest_login": """
        WITH lc AS (SELECT user_id FROM events WHERE event_type = 'click' GROUP BY user_id),
             lp AS (SELECT user_id, arg_max(ts, event_id) AS login_time FROM events
                    WHERE event_type = 'purchase' GROUP BY user_id)
        SELECT lp.user_id, lp.login_time FROM lc JOIN lp ON lc.user_id = lp.user_id""",
}

QUERIES = {
    "recharge_match": recharge_match_on_tables,
    "purchase_enrich_inner": purchase_enrich_inner_on_tables,
    "purchase_enrich_left": purchase_enrich_left_on_tables,
    "purchase_asof_inner": purchase_asof_inner_on_tables,
    "purchase_asof_left": purchase_asof_left_on_tables,
    "purchase_snapshot_inner": purchase_snapshot_inner_on_tables,
    "purchase_snapshot_left": purchase_snapshot_left_on_tables,
    "latest_login": latest_login,
}
