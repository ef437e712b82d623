"""Wiring for the stateful processors: tagged inputs, ``transformWithStateInPandas``
calls and the tables rebuilt from their output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.operators.tables import keyed, latest_per_key
from rillflow.streaming import processors as P
from rillflow.streaming.runner import STREAM_CONF


def _keyed(schema: T.StructType, df: DataFrame) -> T.StructType:
    """The processor's output schema with ``key`` typed like the input's key."""
    kt = df.schema["key"].dataType
    return T.StructType([T.StructField(f.name, kt if f.name == "key" else f.dataType, True)
                         for f in schema.fields])


def _bucketed(df: DataFrame):
    """Rows that have a key, grouped for a processor that works on a bucket of keys."""
    return keyed(df, "key").withColumn("__bucket", F.pmod(F.xxhash64("key"), F.lit(P.BUCKETS)).cast("int")) \
        .groupBy("__bucket")


def _key_type(df: DataFrame) -> str:
    return df.schema["key"].dataType.simpleString()


def use_rocksdb_state(spark: SparkSession) -> None:
    """Sets the state store provider that the processors need, for streams that a caller starts
    without ``run_stream``, which sees to it itself."""
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, STREAM_CONF[key])


def running_balance(changes: DataFrame) -> DataFrame:
    """``key, seq, ts, cents`` -> each row with ``running_cents``."""
    return keyed(changes, "key").groupBy("key").transformWithStateInPandas(
        P.RunningBalance(), _keyed(P.RUNNING_OUT, changes), "append", "None")


def table_join(left: DataFrame, right: DataFrame, joiner=None) -> DataFrame:
    """Two changelogs ``key, ts, seq, value`` -> the joined table's changelog. ``joiner`` makes the
    joined values from arrays of left and right ones; the right ones by default."""
    tagged = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    return _bucketed(tagged).transformWithStateInPandas(
        P.TableJoin(_key_type(tagged), joiner), _keyed(P.TABLE_JOIN_OUT, tagged), "append", "None")


def table_from_changelog(out: DataFrame) -> DataFrame:
    """Latest emitted row per key, deletes dropped."""
    return latest_per_key(out, "key", ["value", "deleted"], ["seq"], tombstone=F.col("deleted"))


def group_deltas(changes: DataFrame) -> DataFrame:
    """``key, ts, seq, value`` -> signed ``(group, delta)`` rows."""
    return _bucketed(changes).transformWithStateInPandas(
        P.GroupDeltas(_key_type(changes)), _keyed(P.DELTA_OUT, changes), "append", "None")


def counts_from_deltas(deltas: DataFrame, group_name: str, out: str = "count") -> DataFrame:
    """Current count per group: the deltas summed (a partial aggregate)."""
    return deltas.groupBy(F.col("group").alias(group_name)).agg(
        F.sum("delta").cast("long").alias(out))


def asof_lookup(table_changes: DataFrame, stream_rows: DataFrame) -> DataFrame:
    """Table changes ``key, ts, seq, info`` and stream rows ``key, ts, seq, payload``
    -> stream rows with the table value current at their arrival."""
    t = table_changes.withColumn("side", F.lit(0)).withColumn("payload", F.lit(None).cast("string"))
    s = stream_rows.withColumn("side", F.lit(1)).withColumn("info", F.lit(None).cast("string"))
    u = t.unionByName(s)
    return _bucketed(u).transformWithStateInPandas(
        P.AsOfLookup(_key_type(u)), _keyed(P.ASOF_OUT, u), "append", "None")


def hold_newest(changes: DataFrame, limit_ms: int, max_bytes: int = 100_000) -> DataFrame:
    """``key, ts, seq, value`` with a watermark on ``ts`` -> the newest value of each key, at most
    once per ``limit_ms`` of event time; ``max_bytes`` bounds what waits per key."""
    timed = changes.withColumn("t_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return keyed(timed, "key").groupBy("key").transformWithStateInPandas(
        P.HoldNewest(limit_ms, max_bytes), _keyed(P.SUPPRESS_OUT, changes), "append",
        "EventTime")


def live_sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """``key, ts, seq`` with a watermark on ``ts`` -> session updates and deletes."""
    timed = events.withColumn("t_us", F.unix_micros(F.col("ts").cast("timestamp")))
    return _bucketed(timed).transformWithStateInPandas(
        P.LiveSessionsOfBucket(_key_type(timed), gap_seconds), _keyed(P.LIVE_SESSION_OUT, events), "append", "EventTime")


def sessions_from_updates(out: DataFrame) -> DataFrame:
    """Current sessions: the newest emission of each (key, start, end) that is not a
    delete, with bounds back as timestamps."""
    cur = latest_per_key(out, ["key", "start_us", "end_us"], ["count", "deleted"], ["seq"],
                         tombstone=F.col("deleted"))
    return cur.select("key", F.timestamp_micros("start_us").alias("window_start"),
                      F.timestamp_micros("end_us").alias("window_end"), "count")
