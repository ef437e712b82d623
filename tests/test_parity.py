"""Batch = stream parity on the driver's events (sf0.001) cut into 1, 3 and 7
micro-batches by event id (arrival order). Tables, as-of lookups and running state are
checked with every third row's ``ts`` set back ten days; windows with ``ts`` in order."""

import os
from datetime import timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import rows
from rillflow.functions.time import as_event_time, from_cents, money
from rillflow.operators.running import running_sum
from rillflow.operators.tables import latest_per_key
from rillflow.operators.windows import hopping_count
from rillflow.plans.counting import favourite_colour
from rillflow.sources.tables import EVENTS_SCHEMA
from rillflow.streaming import stateful as S
from rillflow.streaming.runner import run_stream

EVENTS = "/root/testdata/sf0.001/events.parquet"


def _events(out_of_order=True):
    table = pq.read_table(EVENTS).sort_by("event_id")
    if out_of_order:
        at = table.schema.get_field_index("ts")
        ts = table.column("ts").cast(pa.timestamp("us")).to_pylist()
        ts = [t - timedelta(days=10) if i % 3 == 2 else t for i, t in enumerate(ts)]
        table = table.set_column(at, "ts", pa.array(ts, pa.timestamp("us")))
    return table


def _batch(spark, tmp_dir):
    path = os.path.join(tmp_dir, "all.parquet")
    pq.write_table(_events(), path)
    return spark.read.schema(EVENTS_SCHEMA).parquet(path)


def _cut(tmp_dir, parts, out_of_order=True):
    table = _events(out_of_order)
    folder = os.path.join(tmp_dir, f"in{parts}")
    os.makedirs(folder)
    n = table.num_rows
    for i in range(parts):
        lo, hi = i * n // parts, (i + 1) * n // parts
        path = os.path.join(folder, f"b{i:04d}.parquet")
        pq.write_table(table.slice(lo, hi - lo), path)
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
    return folder


def _stream(spark, folder):
    return spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_running_balance_parity(spark, tmp_dir, parts):
    S.use_rocksdb_state(spark)
    ev = _stream(spark, _cut(tmp_dir, parts)).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"),
        as_event_time("ts").alias("ts"), (money("value") * 100).cast("long").alias("cents"))
    out = run_stream(spark, S.running_balance(ev), "p", base=os.path.join(tmp_dir, "run")).wait()
    got = rows(out.result().select("seq", from_cents("running_cents").alias("b")), "seq", "b")
    batch = running_sum(_batch(spark, tmp_dir), "user_id", "value", "event_id")
    assert got == rows(batch, "event_id", "running_bal")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_favourite_colour_parity(spark, tmp_dir, parts):
    S.use_rocksdb_state(spark)
    ev = _stream(spark, _cut(tmp_dir, parts)).select(
        F.col("user_id").alias("key"), as_event_time("ts").alias("ts"),
        F.col("event_id").alias("seq"), F.col("event_type").alias("value"))
    deltas = run_stream(spark, S.group_deltas(ev), "p", base=os.path.join(tmp_dir, "run")).wait()
    got = rows(S.counts_from_deltas(deltas.result(), "colour"), "colour", "count")
    batch = favourite_colour(_batch(spark, tmp_dir), "user_id", "event_type", "event_id")
    assert got == rows(batch, "colour", "count")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_latest_login_parity(spark, tmp_dir, parts):
    S.use_rocksdb_state(spark)
    ev = _stream(spark, _cut(tmp_dir, parts))

    def side(t):
        return ev.filter(F.col("event_type") == t).select(
            F.col("user_id").alias("key"), as_event_time("ts").alias("ts"),
            F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("value"))
    out = run_stream(spark, S.table_join(side("click"), side("purchase")), "p",
                     base=os.path.join(tmp_dir, "run")).wait().result()
    got = rows(S.table_from_changelog(out), "key", "value")
    static = _batch(spark, tmp_dir)
    clicks = latest_per_key(static.filter("event_type = 'click'"), "user_id", ["event_id"],
                            ["event_id"])
    purch = latest_per_key(static.filter("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("pid")), "user_id", ["pid"], ["pid"])
    want = clicks.join(purch, "user_id").select("user_id", F.col("pid").cast("string"))
    assert got == rows(want, "user_id", "pid")


@pytest.mark.parametrize("parts", [1, 3])
def test_hopping_parity_on_closed_windows(spark, tmp_dir, parts):
    st = hopping_count(_stream(spark, _cut(tmp_dir, parts, False)), "user_id", "ts", "30 seconds",
                       "15 seconds", grace="2 minutes")
    got = run_stream(spark, st, "p", base=os.path.join(tmp_dir, "run")).wait().result()
    static = spark.read.parquet(EVENTS)
    wm = static.agg(F.expr("date_trunc('MILLISECOND', max(ts)) - INTERVAL 2 MINUTES")).first()[0]
    batch = hopping_count(static, "user_id", "ts", "30 seconds", "15 seconds") \
        .filter(F.col("window_end") <= F.lit(wm))
    assert rows(got, "user_id", "window_start", "count") == \
        rows(batch, "user_id", "window_start", "count")


@pytest.mark.parametrize("parts", [1, 3])
def test_session_parity(spark, tmp_dir, parts):
    from rillflow.operators.windows import session_count, session_count_stream
    folder = _cut(tmp_dir, parts, False)
    st = session_count_stream(_stream(spark, folder), "user_id", "ts", 300, grace="2 minutes")
    final = run_stream(spark, st, "s", base=os.path.join(tmp_dir, "run")).wait().result()
    static = spark.read.parquet(EVENTS)
    wm = static.agg(F.expr("date_trunc('MILLISECOND', max(ts)) - INTERVAL 2 MINUTES")).first()[0]
    batch = session_count(static, "user_id", "ts", 300)
    closed = batch.filter(F.col("window_end") + F.expr("INTERVAL 300 SECONDS") <= F.lit(wm))
    cols = ("user_id", "window_start", "window_end", "count")
    assert rows(final, *cols) == rows(closed, *cols)
    # live sessions see every session, open ones included
    S.use_rocksdb_state(spark)
    ev = (_stream(spark, folder).withColumn("__et", as_event_time("ts"))
          .withWatermark("__et", "2 minutes")
          .select(F.col("user_id").alias("key"), F.col("__et").alias("ts"),
                  F.col("event_id").alias("seq")))
    live = run_stream(spark, S.live_sessions(ev, 300), "l",
                      base=os.path.join(tmp_dir, "live")).wait().result()
    cur = S.sessions_from_updates(live).select(
        F.col("key").alias("user_id"), F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "count")
    assert rows(cur, *cols) == rows(batch, *cols)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_asof_parity(spark, tmp_dir, parts):
    from rillflow.operators.joins import asof_join
    S.use_rocksdb_state(spark)
    info = F.when(F.col("event_type") == "signup", F.col("props"))
    is_change = F.col("event_type").isin("signup", "error")
    ev = _stream(spark, _cut(tmp_dir, parts)).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), as_event_time("ts").alias("ts"), "event_type", "props")
    out = run_stream(spark, S.asof_lookup(
        ev.filter(is_change).select("key", "ts", "seq", info.alias("info")),
        ev.filter("event_type = 'purchase'").select("key", "ts", "seq", F.col("event_type").alias("payload"))),
        "a", base=os.path.join(tmp_dir, "run")).wait().result()
    static = _batch(spark, tmp_dir)
    want = asof_join(static.filter("event_type = 'purchase'").select("user_id", "event_id"),
                     static.filter(is_change).select("user_id", "event_id", info.alias("info")),
                     "user_id", "event_id", ["info"], how="left")
    assert rows(out, "seq", "info") == rows(want, "event_id", "info")


@pytest.mark.parametrize("cut", [[5], [1, 1, 1, 1, 1], [2, 2, 1], [1, 4]])
def test_held_output_does_not_depend_on_the_cut(spark, tmp_dir, cut):
    """Updates at 0, 30, 70, 200 and 400 s, held 60 s: 30, 70, 200 and 400 go out."""
    from datetime import datetime

    from helpers import write_batches
    S.use_rocksdb_state(spark)
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    updates = [{"key": "k", "ts": at(s), "seq": s, "value": None if s == 200 else f"v{s}"} for s in (0, 30, 70, 200, 400)]
    batches, i = [], 0
    for n in cut:
        batches.append(updates[i:i + n])
        i += n
    batches[-1] = batches[-1][::-1]  # rows of a batch come in no order
    batches.append([{"key": "other", "ts": at(1000), "seq": 1000, "value": "x"}])  # moves the watermark on
    src = write_batches(os.path.join(tmp_dir, "in"), batches, pa.schema(
        [("key", pa.string()), ("ts", pa.timestamp("us", tz="UTC")), ("seq", pa.int64()), ("value", pa.string())]))
    ch = spark.readStream.schema("key string, ts timestamp, seq long, value string") \
        .option("maxFilesPerTrigger", 1).parquet(src).withWatermark("ts", "2 minutes")
    out = run_stream(spark, S.hold_newest(ch, 60_000), "h", base=os.path.join(tmp_dir, "run")).wait().result()
    assert rows(out, "seq", "value", "deleted") == [(30, "v30", False), (70, "v70", False), (200, None, True), (400, "v400", False)]
