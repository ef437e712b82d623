"""Joins on the record key: table lookups, time-bounded stream joins, table x table,
and the as-of lookup.

No broadcast is forced here. Whether a table side is replicated is left to Spark's
size-checked choice (``spark.sql.autoBroadcastJoinThreshold``, re-checked at run time
by AQE on the real shuffle size), with a sort-merge join beyond it and AQE's skew-join
split for a hot key on the large side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.operators.buckets import BITS, bucket_of, carry_over, last_place
from rillflow.operators.tables import latest_per_key


def lookup_join(stream: DataFrame, table: DataFrame, stream_key: Column | str,
                table_key: str, how: str = "inner") -> DataFrame:
    """Each stream row looks up the table row of its key (the key mapper may pick any
    stream column). ``inner`` drops rows with no table row, ``left`` keeps them with
    nulls. Rows with a null key never match; for ``left`` they are dropped first, as a
    keyed lookup would skip them."""
    k = F.col(stream_key) if isinstance(stream_key, str) else stream_key
    if how == "left":
        stream = stream.filter(k.isNotNull())
    return stream.join(table, k == table[table_key], how)


def _bucket(ts: str, width_seconds: int) -> Column:
    return F.window(ts, f"{int(width_seconds)} seconds").start


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, within_seconds: int) -> DataFrame:
    """Pairs with the same key whose times differ by at most ``within_seconds``, both
    ends inclusive; every pair is a result row.

    The key alone would put all rows of a hot key in one task and pair each with all
    others before the time test. Here both sides also carry a time bucket twice as wide
    as the bound. A left row's range ``[t - w, t + w]`` then reaches only its own bucket
    and the nearer neighbour, so each left row is offered to two buckets, and the
    equi-join on ``(key, bucket)`` meets only candidates that are near in time (at most
    twice the range); a hot key is spread over its buckets. Works on streams too
    (watermark both sides first, append mode); the bucket equality also spreads the join
    state of a hot key. Inner only: a left row is offered to two buckets, so an outer
    form would repeat unmatched rows.
    """
    span = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    width = F.expr(f"INTERVAL {2 * int(within_seconds)} SECONDS")
    lb = _bucket(left_ts, 2 * within_seconds)
    near = F.when(F.col(left_ts) < lb + span, lb - width).otherwise(lb + width)
    lcand = left.withColumn("__lb", F.explode(F.array(lb, near)))
    rcand = right.withColumn("__rb", _bucket(right_ts, 2 * within_seconds))
    cond = ((lcand[left_key] == rcand[right_key]) & (lcand["__lb"] == rcand["__rb"])
            & (rcand[right_ts] >= lcand[left_ts] - span)
            & (rcand[right_ts] <= lcand[left_ts] + span))
    return lcand.join(rcand, cond, "inner").drop("__lb", "__rb")


def table_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of two tables on their primary key (each already latest-per-key). The
    result is itself a table keyed by ``key``."""
    return left.join(right, key, how)


def asof_join(stream: DataFrame, changelog: DataFrame, key: str, seq: str, value_cols: list[str],
              how: str = "inner", bits: Sequence[int] = BITS) -> DataFrame:
    """Each stream row sees the table as it was when the row arrived: the latest changelog row
    of its key before it in the order of the offset ``seq``. A delete (all values null) or no
    earlier row means no match (dropped for ``inner``, nulls for ``left``). Rows with a null key
    are dropped (a keyed lookup skips them).

    Both inputs carry ``key`` and ``seq``; the changelog also ``value_cols``. Of a stream row and
    a changelog row with one offset the changelog row comes first.

    Rows are grouped by ``(key, offset bucket)``; inside a group a window carries the last table
    row forward, and the state that a group leaves is carried to the key's later groups in two
    levels (see :mod:`rillflow.operators.buckets`), so a key that is hot on either side is spread
    over its buckets. For batch DataFrames; a stream uses the ``AsOfLookup`` processor
    (``rillflow.streaming.stateful.asof_lookup``).
    """
    for c in value_cols:
        if c in stream.columns:
            raise ValueError(f"stream already has a column named {c}")
    tomb = F.lit(True)
    for c in value_cols:
        tomb = tomb & F.col(c).isNull()
    state = F.struct(*[F.col(c) for c in value_cols], (~tomb).alias("__live"))
    s = stream.filter(F.col(key).isNotNull()).withColumn("__side", F.lit(1))
    t = changelog.filter(F.col(key).isNotNull()).select(key, seq, state.alias("__state")) \
        .withColumn("__side", F.lit(0))
    u = s.unionByName(t, allowMissingColumns=True).withColumn("__b", bucket_of(seq, bits[0]))
    in_bucket = Window.partitionBy(key, "__b").orderBy(seq, "__side")
    seen = u.withColumns({
        "__in": F.last("__state", ignorenulls=True).over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__n": F.row_number().over(in_bucket)})
    # one summary row per (key, bucket), from the same windowed rows: the state at its end
    summary = seen.groupBy(key, "__b").agg(F.max("__side").alias("__has_rows"),
                                                   F.max_by("__in", last_place(stream, "__n", (key, seq))).alias("__last"))
    latest = lambda c, w: F.last(c, ignorenulls=True).over(w)
    carry = carry_over(summary, key, "__last", latest,
                       lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("__b"))),
                       lambda far, near: F.coalesce(near, far), bits) \
        .filter(F.col("__has_rows") == 1).select(key, "__b", "__carry")
    st = F.coalesce(F.col("__in"), F.col("__carry"))
    matched = st.isNotNull() & st["__live"]
    out = seen.filter(F.col("__side") == 1).join(carry, [key, "__b"], "left").select(
        *stream.columns, *[F.when(matched, st[c]).alias(c) for c in value_cols],
        matched.alias("__matched"))
    if how == "inner":
        out = out.filter("__matched")
    return out.drop("__matched")


def snapshot_lookup(stream: DataFrame, changelog: DataFrame, stream_key: str, key: str,
                    value_cols: list[str], order_cols: list[str],
                    how: str = "inner") -> DataFrame:
    """Stream rows against the *final* table of a changelog (the answer when the
    whole table is loaded before the stream is read)."""
    table = latest_per_key(changelog, key, value_cols, order_cols)
    return lookup_join(stream, table, stream_key, key, how)
