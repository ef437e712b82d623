"""Event-time windows: tumbling, hopping and session counts.

Outputs give the window as two flat columns, ``window_start`` and ``window_end``.
Tumbling and hopping counts are one partial-aggregated ``groupBy(key, window)``; the
same function serves a streaming DataFrame (with ``grace`` it sets the watermark and the
caller picks append mode for final results only). Rows without a key are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.time import as_event_time, as_wall_clock
from rillflow.operators.tables import keyed


def _event_time(df: DataFrame, ts: str, grace: str | None) -> tuple[DataFrame, str]:
    """With a grace (streams) the event-time column must be TIMESTAMP for the
    watermark; batch keeps the column as it is."""
    if grace is None:
        return df, ts
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn("__et", as_event_time(ts))
        ts = "__et"
    return df.withWatermark(ts, grace), ts


def _flat(df: DataFrame, key: str, wcol: str, out: str, ntz: bool,
          end_col: Column | None = None) -> DataFrame:
    start = F.col(f"{wcol}.start")
    end = F.col(f"{wcol}.end") if end_col is None else end_col
    if ntz:
        start, end = as_wall_clock(start), as_wall_clock(end)
    return df.select(key, start.alias("window_start"), end.alias("window_end"), out)


def tumbling_count(df: DataFrame, key: str, ts: str, size: str,
                   grace: str | None = None, out: str = "count") -> DataFrame:
    """Rows per key per tumbling window ``[start, start + size)`` aligned to the epoch."""
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType) and grace is not None
    d, t = _event_time(keyed(df, key), ts, grace)
    g = d.groupBy(key, F.window(t, size).alias("__w")).agg(F.count(F.lit(1)).alias(out))
    return _flat(g, key, "__w", out, ntz)


def hopping_count(df: DataFrame, key: str, ts: str, size: str, slide: str,
                  grace: str | None = None, out: str = "count") -> DataFrame:
    """Rows per key per hopping window of ``size`` advancing by ``slide``; a row is in
    ``size / slide`` windows."""
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType) and grace is not None
    d, t = _event_time(keyed(df, key), ts, grace)
    g = (d.groupBy(key, F.window(t, size, slide).alias("__w"))
         .agg(F.count(F.lit(1)).alias(out)))
    return _flat(g, key, "__w", out, ntz)


def session_count(df: DataFrame, key: str, ts: str, gap_seconds: int,
                  out: str = "count") -> DataFrame:
    """Sessions per key for a batch: rows whose gap to the previous row of the key is
    at most ``gap_seconds`` share a session. ``window_start`` is the first row's time,
    ``window_end`` the last row's time (not last + gap).

    Skew-proof plan: rows are first counted into tumbling buckets as wide as the gap.
    Two rows in one bucket are less than a gap apart, so a bucket never splits a
    session; only bucket edges can. The heavy step is therefore one partial aggregate
    ``groupBy(key, bucket)`` (min, max, count); the session chaining runs on those
    summaries (at most one per gap-wide slice of time per key), so no task ever sorts
    all rows of a hot key.
    """
    gap = F.expr(f"INTERVAL {int(gap_seconds)} SECONDS")
    buckets = (keyed(df, key).groupBy(key, F.window(ts, f"{int(gap_seconds)} seconds").start
                          .alias("__b"))
               .agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"),
                    F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy(key).orderBy("__b")
    starts = (buckets
              .withColumn("__prev_hi", F.lag("__hi").over(w))
              .withColumn("__start", F.when(F.col("__prev_hi").isNull()
                                            | (F.col("__lo") > F.col("__prev_hi") + gap),
                                            F.col("__lo")))
              .withColumn("__session", F.last("__start", ignorenulls=True).over(
                  w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return (starts.groupBy(key, F.col("__session").alias("window_start"))
            .agg(F.max("__hi").alias("window_end"), F.sum("__n").alias(out)))


def session_count_stream(df: DataFrame, key: str, ts: str, gap_seconds: int,
                         grace: str, out: str = "count") -> DataFrame:
    """Session counts on a stream with Spark's session window (append mode: one final
    row per session once the watermark passes it). Spark's window end is last + gap;
    the gap is taken off so the end is the last row's time, as in the batch form."""
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    d, t = _event_time(keyed(df, key), ts, grace)
    g = (d.groupBy(key, F.session_window(t, f"{int(gap_seconds)} seconds").alias("__w"))
         .agg(F.count(F.lit(1)).alias(out)))
    end = F.col("__w.end") - F.expr(f"INTERVAL {int(gap_seconds)} SECONDS")
    return _flat(g, key, "__w", out, ntz, end_col=end)


def closed_windows(result: DataFrame, max_event_time: Column, grace_seconds: int,
                   end_col: str = "window_end") -> DataFrame:
    """Windows a stream has finalised once it saw events up to ``max_event_time``:
    ``window_end + grace <= max time``. Used to compare a stream's final output with
    the batch result over the same input."""
    return result.filter(F.col(end_col) + F.expr(f"INTERVAL {int(grace_seconds)} SECONDS")
                         <= max_event_time)
