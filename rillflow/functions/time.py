"""Time and money helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def EPOCH_ZERO() -> Column:  # noqa: N802 - a constant, built lazily (needs a session)
    """Fixed value: the fold's initial time, the epoch 1970-01-01T00:00:00Z."""
    return F.timestamp_millis(F.lit(0))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 instant text (``2024-01-01T00:00:07.179Z``) to a timestamp; null for other text,
    which the caller sends to its dead letters."""
    return F.try_to_timestamp(_c(text))


def epoch_millis(ts: Column | str) -> Column:
    """Timestamp to epoch milliseconds."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def format_iso_millis(ts: Column | str) -> Column:
    """Timestamp to ISO-8601 text cut to milliseconds, UTC (``...T00:00:07.179Z``)."""
    return F.date_format(
        F.date_trunc("MILLISECOND", F.to_utc_timestamp(_c(ts).cast("timestamp"),
                                                       F.current_timezone())),
        "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def as_event_time(ts: Column | str) -> Column:
    """Event-time column for ``withWatermark``: TIMESTAMP_NTZ is rejected there, so
    cast to TIMESTAMP (under a UTC session the instant is unchanged)."""
    return _c(ts).cast("timestamp")


def as_wall_clock(ts: Column | str) -> Column:
    """Back from TIMESTAMP to TIMESTAMP_NTZ for output."""
    return _c(ts).cast("timestamp_ntz")


def money(amount: Column | str) -> Column:
    """Amounts with at most two decimals as DECIMAL(18,2): sums are exact and equal
    in every engine, whatever the order of addition."""
    return _c(amount).cast("decimal(18,2)")


def from_cents(cents: Column | str) -> Column:
    """Whole cents as an exact decimal amount."""
    return (_c(cents).cast("decimal(28,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(28,2)")
