"""Streams in event time: rows that arrive late, times taken from a payload, the versions of a
window's state, and lines printed once for each final window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.jsonio import parse_json
from rillflow.functions.time import parse_iso
from rillflow.operators.windows import session_count_stream, tumbling_count
from rillflow.plans.streams import GRACE_SECONDS
from rillflow.plans.text_io import TRANSACTION, event_texts
from rillflow.plans.windowed import GRACE, SESSION_GAP_SECONDS, TUMBLE, ORACLE as WINDOW_SQL
from rillflow.session import scratch_path
from rillflow.sinks.console import LineFiles, for_each_record, window_lines
from rillflow.sources.tables import EVENTS_SCHEMA, arriving_table, read_table
from rillflow.streaming.runner import run_stream, stream_settings
from rillflow.streaming.state import read_changes, read_state

# ---------------------------------------------------------------- late rows
#: Micro-batches, each one slot of the events' time.
SLOTS = 8
#: How late rows are by their id modulo 10, in hours: a few within the grace, others far beyond it.
DELAYS = {3: 3, 7: 24 * 9}
LATE_GRACE_HOURS = 6
LATE_GRACE = f"{LATE_GRACE_HOURS} hours"


def _late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the order of arrival: each at its time, some later."""
    lo, hi = (x or 0 for x in read_table(spark, sf_dir, "events", ["ts"]).agg(
        *(f(F.unix_micros(F.col("ts").cast("timestamp"))) for f in (F.min, F.max))).first())
    hours = F.coalesce(*[F.when(F.col("event_id") % 10 == m, F.lit(h)) for m, h in DELAYS.items()], F.lit(0))
    at = F.unix_micros(F.col("ts").cast("timestamp")) + hours * 3_600_000_000 - F.lit(lo)
    slot = F.least(F.floor(at * SLOTS / F.lit(hi - lo + 1)), F.lit(SLOTS - 1))
    return arriving_table(spark, sf_dir, "events", "event_id", SLOTS, files=1, schema=EVENTS_SCHEMA, arrival=slot) \
        .select("user_id", "ts")


def late_tumbling_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final tumbling counts with rows late within and beyond the grace: the former count."""
    s = tumbling_count(_late_events(spark, sf_dir), "user_id", "ts", TUMBLE, grace=LATE_GRACE)
    return run_stream(spark, s, "late_tumbling").wait().result()


def late_drops_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events arrived, how many are in final windows or in those still open, and how many
    were dropped for being late."""
    ev = _late_events(spark, sf_dir)
    run = run_stream(spark, tumbling_count(ev, "user_id", "ts", TUMBLE, grace=LATE_GRACE), "late_drops").wait()
    final = run.result().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("final"))
    still = read_state(spark, run.checkpoint).agg(F.coalesce(F.sum("value.count"), F.lit(0)).alias("still_open"))
    arrived = read_table(spark, sf_dir, "events", ["user_id"]).agg(F.count("user_id").alias("arrived"))
    return arrived.join(final).join(still).select("arrived", "final", "still_open",
                                                  (F.col("arrived") - F.col("final") - F.col("still_open")).alias("dropped"))


def late_session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final sessions with rows late within and beyond the grace."""
    s = session_count_stream(_late_events(spark, sf_dir), "user_id", "ts", SESSION_GAP_SECONDS, grace=LATE_GRACE)
    return run_stream(spark, s, "late_sessions").wait().result()


# a row is late by the watermark of two batches before its own: Spark's filter lags a batch
_HOURS = "CASE " + " ".join(f"WHEN event_id % 10 = {m} THEN {h}" for m, h in DELAYS.items()) + " ELSE 0 END"
_ARRIVED = f"""
    span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
    arrived AS (
        SELECT user_id, event_id, ts, CAST(least(floor(CAST((epoch_us(ts) + ({_HOURS}) * 3600000000 - lo) * {SLOTS} AS DOUBLE) / (hi - lo + 1)),
                                         {SLOTS - 1}) AS BIGINT) AS slot FROM events, span),
    marks AS (
        SELECT s AS slot, (SELECT date_trunc('millisecond', max(ts)) - INTERVAL {LATE_GRACE_HOURS} HOURS
                           FROM arrived a WHERE a.slot <= s - 2) AS mark FROM range({SLOTS}) r(s)),
    closing AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL {LATE_GRACE_HOURS} HOURS AS mark FROM events)"""


def _counted(end: str) -> str:
    return f"""counted AS (SELECT a.* FROM arrived a JOIN marks USING (slot)
        WHERE user_id IS NOT NULL AND (mark IS NULL OR {end} > mark))"""


_END = "make_timestamp((epoch_us(ts) // 30000000 + 1) * 30000000)"
_LATE = f"WITH {_ARRIVED}, {_counted(_END)}"

ORACLE = {
    "late_tumbling_stream": f"""
        {_LATE}
        SELECT user_id, window_start, window_end, count FROM ({WINDOW_SQL["tumbling_count"].replace("FROM events", "FROM counted")}), closing
        WHERE window_end <= mark""",
    "late_drops_stream": f"""
        {_LATE},
        ends AS (SELECT {_END} AS e FROM counted)
        SELECT (SELECT count(user_id) FROM events) AS arrived, count(*) FILTER (WHERE e <= mark) AS final,
               count(*) FILTER (WHERE e > mark) AS still_open, (SELECT count(user_id) FROM events) - count(*) AS dropped
        FROM ends, closing""",
    "late_session_stream": f"""
        WITH {_ARRIVED}, {_counted(f"ts + INTERVAL {SESSION_GAP_SECONDS} SECONDS")}
        SELECT user_id, window_start, window_end, count FROM ({WINDOW_SQL["session_count"].replace("FROM events", "FROM counted")}), closing
        WHERE window_end + INTERVAL {SESSION_GAP_SECONDS} SECONDS <= mark""",
}
QUERIES = {
    "late_tumbling_stream": late_tumbling_stream,
    "late_drops_stream": late_drops_stream,
    "late_session_stream": late_session_stream,
}


# ---------------------------------------------------------------- time from the payload
def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts as they arrive, read once: fields, the payload's time, and the text if it is unreadable."""
    ev = arriving_table(spark, sf_dir, "events", "event_id", schema=EVENTS_SCHEMA, columns=EVENTS_SCHEMA.fieldNames())
    rows = parse_json(event_texts(ev.select("event_id", "user_id", "ts")), "value", TRANSACTION, lenient_ints=True)
    return rows.withColumn("at", parse_iso("time"))


def payload_tumbling_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling counts by the time that each JSON text says, with a watermark on it."""
    rows = _payloads(spark, sf_dir).filter("bad_record IS NULL AND at IS NOT NULL")
    out = run_stream(spark, tumbling_count(rows, "user", "at", TUMBLE, grace=GRACE), "payload_tumbling").wait().result()
    return out.select("user", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "count")


def payload_dead_letters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the windowed stream leaves out: texts that are no JSON, and those without a time."""
    rows = _payloads(spark, sf_dir).filter("bad_record IS NOT NULL OR at IS NULL").select("event_id", "bad_record", "time")
    return run_stream(spark, rows, "payload_dead_letters").wait().result()


ORACLE["payload_tumbling_stream"] = f"""
    WITH counted AS (SELECT CAST(user_id AS VARCHAR) AS user_id, date_trunc('millisecond', ts) AS ts FROM events
                     WHERE event_id % 5 < 3 AND user_id IS NOT NULL)
    SELECT user_id AS user, window_start, window_end, count FROM ({WINDOW_SQL["tumbling_count"].replace("FROM events", "FROM counted")})
    WHERE window_end <= (SELECT max(ts) FROM counted) - INTERVAL {GRACE_SECONDS} SECONDS"""
ORACLE["payload_dead_letters_stream"] = """
    SELECT event_id, CASE WHEN event_id % 5 = 3 THEN '{"user":"' || CAST(user_id AS VARCHAR) || '","amount":' END AS bad_record,
           CASE WHEN event_id % 5 = 4 THEN 'soon' END AS time
    FROM events WHERE event_id % 5 >= 3"""
QUERIES["payload_tumbling_stream"] = payload_tumbling_stream
QUERIES["payload_dead_letters_stream"] = payload_dead_letters_stream


# ---------------------------------------------------------------- versions of a window's state
def tumbling_state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of every window's count in the state store, batch by batch, as the store's change
    feed tells them: the count of a window after each micro-batch that changed it."""
    ev = arriving_table(spark, sf_dir, "events", "event_id", schema=EVENTS_SCHEMA).select("user_id", "ts")
    s = tumbling_count(ev, "user_id", "ts", "1 hour", grace=GRACE)
    run = run_stream(spark, s, "tumbling_changes", conf={"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}).wait()
    feed = read_changes(spark, run.checkpoint)
    return feed.filter("change_type = 'update'").select(
        F.col("batch_id").cast("long").alias("batch"), F.col("key.user_id").alias("user_id"),
        F.col("key.window.start").cast("timestamp_ntz").alias("window_start"), F.col("value.count").alias("count"))


ORACLE["tumbling_state_changes"] = """
    WITH edges AS (SELECT b AS batch, lo + (hi - lo + 1) * b // 3 AS a, lo + (hi - lo + 1) * (b + 1) // 3 AS z
                   FROM (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events), range(3) r(b)),
    placed AS (SELECT user_id, event_id, make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS window_start
               FROM events WHERE user_id IS NOT NULL),
    touched AS (SELECT DISTINCT batch, z, user_id, window_start FROM placed JOIN edges ON event_id >= a AND event_id < z)
    SELECT batch, t.user_id, t.window_start, count(*) AS count
    FROM touched t JOIN placed p ON p.user_id = t.user_id AND p.window_start = t.window_start AND p.event_id < t.z
    GROUP BY ALL"""
QUERIES["tumbling_state_changes"] = tumbling_state_changes


# ---------------------------------------------------------------- lines printed once
def tumbling_lines_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line that is printed for every final window, by a writer called for each record, read back
    from what it printed."""
    ev = arriving_table(spark, sf_dir, "events", "event_id", schema=EVENTS_SCHEMA).select("user_id", "ts")
    lines = window_lines(tumbling_count(ev, "user_id", "ts", TUMBLE, grace=GRACE), "user_id")
    base = scratch_path(spark, "printed", "tumbling")
    with stream_settings(spark):
        q = for_each_record(lines, LineFiles(f"{base}/lines"), f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.text(f"{base}/lines").select(F.col("value").alias("line"))


ORACLE["tumbling_lines_stream"] = f"""
    SELECT 'name= ' || CAST(user_id AS VARCHAR) || ' window start=' || strftime(window_start, '%Y-%m-%d %H:%M:%S')
           || ' window end=' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || ' count= ' || CAST(count AS VARCHAR) AS line
    FROM ({WINDOW_SQL["tumbling_count"]})
    WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL {GRACE_SECONDS} SECONDS"""
QUERIES["tumbling_lines_stream"] = tumbling_lines_stream
