"""Scalar helpers: ISO time both ways, epoch constant, partition hash, upper-case."""

from datetime import datetime

from pyspark.sql import functions as F

from rillflow.functions import (
    EPOCH_ZERO,
    epoch_millis,
    format_iso_millis,
    parse_iso,
    partition_of,
    upper_all,
)


def test_iso_time_round_trip(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:07.179575Z",)], "t string")
    r = df.select(parse_iso("t").alias("ts")).select(
        epoch_millis("ts").alias("ms"), format_iso_millis("ts").alias("iso")).first()
    assert r.ms == 1704067207179
    assert r.iso == "2024-01-01T00:00:07.179Z"


def test_epoch_zero(spark):
    assert spark.range(1).select(epoch_millis(EPOCH_ZERO()).alias("z")).first().z == 0


def test_partition_never_negative(spark):
    df = spark.createDataFrame([(n,) for n in ["a", "b", "divya", "roshan", "shubham", "x" * 40]],
                               "name string")
    parts = [r.p for r in df.select(partition_of("name", 3).alias("p")).collect()]
    assert all(0 <= p < 3 for p in parts)


def test_upper_all_and_ntz_input(spark):
    df = spark.createDataFrame([(["a", "Bc"],)], "xs array<string>")
    assert df.select(upper_all("xs").alias("u")).first().u == ["A", "BC"]
    ntz = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 1),)], "ts timestamp_ntz")
    assert ntz.select(format_iso_millis(F.col("ts")).alias("i")).first().i == \
        "2024-01-01T00:00:01.000Z"


def test_bad_time_text_is_null_and_cents_are_exact(spark):
    from rillflow.functions.time import from_cents
    df = spark.createDataFrame([("soon", 9007199254740993), (None, -5)], "t string, c long")
    got = df.select(parse_iso("t").alias("ts"), from_cents("c").cast("string").alias("m")).collect()
    assert [(r.ts, r.m) for r in got] == [(None, "90071992547409.93"), (None, "-0.05")]


def test_a_session_in_another_zone_is_refused(spark):
    import pytest

    from rillflow.session import require_utc
    require_utc(spark)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    with pytest.raises(ValueError):
        require_utc(other)
