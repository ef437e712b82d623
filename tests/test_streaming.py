"""Streams over micro-batches made by hand: parity with batch, late rows, restart,
and the stateful processors across batches."""

import os
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import rows, write_batches
from rillflow.operators.windows import closed_windows, tumbling_count
from rillflow.streaming import stateful as S
from rillflow.streaming.runner import run_stream

T0 = datetime(2024, 1, 1)
EV = pa.schema([("name", pa.string()), ("ts", pa.timestamp("us", tz="UTC"))])
CH = pa.schema([("key", pa.string()), ("ts", pa.timestamp("us", tz="UTC")),
                ("seq", pa.int64()), ("value", pa.string())])


def at(s):
    from datetime import timezone
    return (T0 + timedelta(seconds=s)).replace(tzinfo=timezone.utc)


def stream_of(spark, folder, schema_ddl):
    return spark.readStream.schema(schema_ddl).option("maxFilesPerTrigger", 1).parquet(folder)


def test_tumbling_stream_matches_batch_closed_windows(spark, tmp_dir):
    batches = [[{"name": n, "ts": at(s)} for n in ("a", "b") for s in range(k * 50, k * 50 + 50, 7)]
               for k in range(4)]
    src = write_batches(os.path.join(tmp_dir, "in"), batches, EV)
    st = tumbling_count(stream_of(spark, src, "name string, ts timestamp"), "name", "ts",
                        "30 seconds", grace="20 seconds")
    got = run_stream(spark, st, "t", base=os.path.join(tmp_dir, "run")).wait().result()
    static = spark.read.parquet(src)
    batch = tumbling_count(static, "name", "ts", "30 seconds")
    want = closed_windows(batch, F.lit(at(199)), 20)
    assert rows(got, "name", "window_start", "count") == rows(want, "name", "window_start", "count")


def _late_run(spark, tmp_dir, batches):
    src = write_batches(os.path.join(tmp_dir, "in"), batches, EV)
    st = tumbling_count(stream_of(spark, src, "name string, ts timestamp"), "name", "ts",
                        "30 seconds", grace="2 minutes")
    run = run_stream(spark, st, "late", base=os.path.join(tmp_dir, "run")).wait()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in run.query.recentProgress if p["stateOperators"])
    return run.result(), dropped


def test_late_row_next_batch_still_counted(spark, tmp_dir):
    res, dropped = _late_run(spark, tmp_dir, [
        [{"name": "a", "ts": at(0)}], [{"name": "a", "ts": at(600)}],
        [{"name": "a", "ts": at(1)}], [{"name": "a", "ts": at(1200)}]])
    assert ("a", T0, 2) in rows(res, "name", "window_start", "count") and dropped == 0


def test_late_row_two_batches_on_is_dropped(spark, tmp_dir):
    res, dropped = _late_run(spark, tmp_dir, [
        [{"name": "a", "ts": at(0)}], [{"name": "a", "ts": at(600)}],
        [{"name": "a", "ts": at(610)}], [{"name": "a", "ts": at(1)}],
        [{"name": "a", "ts": at(1200)}]])
    assert ("a", T0, 1) in rows(res, "name", "window_start", "count") and dropped == 1


def test_restart_from_checkpoint(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    base = os.path.join(tmp_dir, "run")
    write_batches(src, [[{"name": "a", "ts": at(0)}, {"name": "a", "ts": at(5)}]], EV)

    def go():
        st = tumbling_count(stream_of(spark, src, "name string, ts timestamp"), "name", "ts",
                            "30 seconds", grace="10 seconds")
        return run_stream(spark, st, "r", base=base).wait().result()
    assert go().count() == 0
    import pyarrow.parquet as pq
    path = os.path.join(src, "b0001.parquet")
    pq.write_table(pa.Table.from_pylist([{"name": "a", "ts": at(10)}, {"name": "a", "ts": at(100)}],
                                        schema=EV), path)
    got = rows(go(), "name", "window_start", "count")
    assert got == [("a", T0, 3)]


def _changes(spark, tmp_dir, batches):
    src = write_batches(os.path.join(tmp_dir, "in"), batches, CH)
    return stream_of(spark, src, "key string, ts timestamp, seq long, value string")


def test_group_deltas_retract(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    ch = _changes(spark, tmp_dir, [
        [{"key": "stephane", "ts": at(1), "seq": 1, "value": "blue"},
         {"key": "john", "ts": at(2), "seq": 2, "value": "green"}],
        [{"key": "stephane", "ts": at(3), "seq": 3, "value": "red"},
         {"key": "alice", "ts": at(4), "seq": 4, "value": "red"}]])
    deltas = run_stream(spark, S.group_deltas(ch), "fc", base=os.path.join(tmp_dir, "run")).wait()
    got = dict(rows(S.counts_from_deltas(deltas.result(), "colour"), "colour", "count"))
    assert got == {"red": 2, "green": 1, "blue": 0}


def test_running_balance_across_batches(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    batches = [[{"key": n, "ts": at(x * 10 + i), "seq": x * 10 + i, "value": str(m * x)}
                for i, (n, m) in enumerate((("divya", 2), ("roshan", 1), ("shubham", 3)))]
               for x in (1, 2, 3)]
    ch = _changes(spark, tmp_dir, batches).select(
        "key", "seq", "ts", F.col("value").cast("long").alias("cents"))
    out = run_stream(spark, S.running_balance(ch), "rb", base=os.path.join(tmp_dir, "run")).wait()
    by = {}
    for k, s, b in rows(out.result(), "key", "seq", "running_cents"):
        by.setdefault(k, []).append(b)
    assert by == {"divya": [2, 6, 12], "roshan": [1, 3, 6], "shubham": [3, 9, 18]}


def test_table_join_update_and_delete(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    left = [[{"key": "u1", "ts": at(1), "seq": 1, "value": "{}"}], [], []]
    right = [[{"key": "u1", "ts": at(2), "seq": 2, "value": "t1"}],
             [{"key": "u1", "ts": at(3), "seq": 3, "value": "t2"}],
             [{"key": "u1", "ts": at(4), "seq": 4, "value": None}]]
    l_src = write_batches(os.path.join(tmp_dir, "l"), left, CH)
    r_src = write_batches(os.path.join(tmp_dir, "r"), right, CH)
    ddl = "key string, ts timestamp, seq long, value string"
    out = run_stream(spark, S.table_join(stream_of(spark, l_src, ddl), stream_of(spark, r_src, ddl)),
                     "tj", base=os.path.join(tmp_dir, "run")).wait().result()
    assert rows(out, "seq", "value", "deleted") == [(2, "t1", False), (3, "t2", False), (4, None, True)]
    assert S.table_from_changelog(out).count() == 0


def test_asof_lookup_stream_in_arrival_order(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    from test_golden import PURCHASE_LOG
    table, purch = [], []
    for seq, topic, user, value in PURCHASE_LOG:
        (table if topic == "table" else purch).append(
            {"key": user, "ts": at(seq), "seq": seq, "value": value})
    t_src = write_batches(os.path.join(tmp_dir, "t"), [table[:2], table[2:]], CH)
    p_src = write_batches(os.path.join(tmp_dir, "p"), [purch[:3], purch[3:]], CH)
    ddl = "key string, ts timestamp, seq long, value string"
    t = stream_of(spark, t_src, ddl).select("key", "ts", "seq", F.col("value").alias("info"))
    p = stream_of(spark, p_src, ddl).select("key", "ts", "seq", F.col("value").alias("payload"))
    out = run_stream(spark, S.asof_lookup(t, p), "asof", base=os.path.join(tmp_dir, "run")).wait()
    got = rows(out.result().filter("info is not null"), "payload", "info")
    assert got == [("rapple(1)", "first=roshan, last=soni"),
                   ("rorange(3)", "first=roshan, last=sonyy"),
                   ("scherry(5)", "first=shubham, last=soni")]


def test_hold_newest_emits_after_limit(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    ch = _changes(spark, tmp_dir, [
        [{"key": "HDFC", "ts": at(0), "seq": 1, "value": "10"},
         {"key": "HDFC", "ts": at(10), "seq": 2, "value": "11"}],
        [{"key": "HDFC", "ts": at(20), "seq": 3, "value": "12"}],
        [{"key": "AXIS", "ts": at(200), "seq": 4, "value": "5"}]])
    ch = ch.withWatermark("ts", "10 seconds")
    out = run_stream(spark, S.hold_newest(ch, 60_000), "hold",
                     base=os.path.join(tmp_dir, "run")).wait().result()
    # HDFC's three updates are in one hold and give the newest; AXIS is still held
    assert rows(out, "key", "value", "seq") == [("HDFC", "12", 3)]


def test_live_sessions_merge_sends_deletes(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    ch = _changes(spark, tmp_dir, [
        [{"key": "u", "ts": at(0), "seq": 1, "value": None},
         {"key": "u", "ts": at(600), "seq": 2, "value": None}],
        [{"key": "u", "ts": at(300), "seq": 3, "value": None}]])
    ev = ch.select("key", "ts", "seq").withWatermark("ts", "1 hour")
    out = run_stream(spark, S.live_sessions(ev, 300), "live",
                     base=os.path.join(tmp_dir, "run")).wait().result()
    us = 1_000_000
    base = int(at(0).timestamp()) * us
    got = sorted((r.seq, r.start_us - base, r.end_us - base, r["count"], r.deleted)
                 for r in out.collect())
    assert got == [(1, 0, 0, 1, False), (2, 600 * us, 600 * us, 1, False),
                   (3, 0, 0, 1, True), (3, 0, 600 * us, 3, False),
                   (3, 600 * us, 600 * us, 1, True)]
    cur = S.sessions_from_updates(out)
    assert rows(cur, "count") == [(3,)]


def test_hold_newest_flushes_early_when_full(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    ch = _changes(spark, tmp_dir, [
        [{"key": "HDFC", "ts": at(70 * i), "seq": i, "value": "x" * 30} for i in range(4)]])
    ch = ch.withWatermark("ts", "1 hour")
    out = run_stream(spark, S.hold_newest(ch, 60_000, max_bytes=100), "full",
                     base=os.path.join(tmp_dir, "run")).wait().result()
    # four holds of 46 bytes are more than 100: all but the last are sent at once
    assert rows(out, "key", "seq") == [("HDFC", 0), ("HDFC", 1), ("HDFC", 2)]


def test_held_rows_out_of_order_within_the_grace(spark, tmp_dir):
    S.use_rocksdb_state(spark)
    ch = _changes(spark, tmp_dir, [
        [{"key": "k", "ts": at(50), "seq": 1, "value": "a"}, {"key": "k", "ts": at(100), "seq": 2, "value": "b"}],
        [{"key": "k", "ts": at(0), "seq": 3, "value": "c"}, {"key": "k", "ts": at(130), "seq": 4, "value": "d"}],
        [{"key": "z", "ts": at(900), "seq": 5, "value": "z"}]]).withWatermark("ts", "10 minutes")
    out = run_stream(spark, S.hold_newest(ch, 60_000), "ooo", base=os.path.join(tmp_dir, "run")).wait().result()
    # by event time: 0 and 50 in one hold, 100 and 130 in the next
    assert rows(out, "seq", "value") == [(1, "a"), (4, "d")]


def test_join_state_is_cleared_when_both_sides_are_gone(spark, tmp_dir):
    from rillflow.streaming.state import read_state
    S.use_rocksdb_state(spark)
    ddl = "key string, ts timestamp, seq long, value string"
    l_src = write_batches(os.path.join(tmp_dir, "l"), [[{"key": "u", "ts": at(1), "seq": 1, "value": "x"}],
                                                       [{"key": "u", "ts": at(5), "seq": 5, "value": None}]], CH)
    r_src = write_batches(os.path.join(tmp_dir, "r"), [[{"key": "u", "ts": at(2), "seq": 2, "value": "y"}],
                                                       [{"key": "u", "ts": at(3), "seq": 3, "value": None}]], CH)
    run = run_stream(spark, S.table_join(stream_of(spark, l_src, ddl), stream_of(spark, r_src, ddl),
                                         lambda left, right: left + "-" + right),
                     "tj", base=os.path.join(tmp_dir, "run")).wait()
    assert rows(run.result(), "seq", "value", "deleted") == [(2, "x-y", False), (3, None, True)]
    held = spark.read.format("statestore").option("stateVarName", "sides").load(run.checkpoint)
    assert held.count() == 0


def test_unreadable_version_raises(spark, tmp_dir):
    from rillflow.operators.aggregates import count_by
    src, base = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "run")
    write_batches(src, [[{"name": "a", "ts": at(0)}]], EV)

    def go():
        st = count_by(stream_of(spark, src, "name string, ts timestamp"), "name")
        return run_stream(spark, st, "ups", mode="upsert", key_cols=["name"], base=base).wait()
    go()
    os.rename(os.path.join(base, "output", "manifest", "b=0"), os.path.join(base, "output", "gone"))
    import pyarrow.parquet as pq
    pq.write_table(pa.Table.from_pylist([{"name": "b", "ts": at(5)}], schema=EV), os.path.join(src, "b0001.parquet"))
    with pytest.raises(Exception):
        go()


def test_replayed_batch_replaces_itself(spark, tmp_dir):
    """The last batch runs again after its commit is lost: the table is the same."""
    from rillflow.operators.aggregates import count_by
    for mode in ("update", "upsert"):
        src, base = os.path.join(tmp_dir, mode, "in"), os.path.join(tmp_dir, mode, "run")
        write_batches(src, [[{"name": "a", "ts": at(0)}], [{"name": "a", "ts": at(1)}, {"name": None, "ts": at(2)}]], EV)

        def go():
            st = count_by(stream_of(spark, src, "name string, ts timestamp"), "name")
            return run_stream(spark, st, "r", mode=mode, key_cols=["name"], base=base).wait()
        want = sorted(map(repr, go().result().select("name", "count").collect()))
        assert len(want) == 2  # the group without a name is kept
        for f in ("1", ".1.crc"):
            os.remove(os.path.join(base, "checkpoint", "commits", f))
        again = go()
        assert again.last_batch() == 1, mode
        assert sorted(map(repr, again.result().select("name", "count").collect())) == want


def test_update_mode_restart_keeps_newest_per_key(spark, tmp_dir):
    from rillflow.operators.aggregates import count_by
    src = os.path.join(tmp_dir, "in")
    base = os.path.join(tmp_dir, "run")
    write_batches(src, [[{"name": "a", "ts": at(0)}, {"name": "b", "ts": at(1)}]], EV)

    def go():
        st = count_by(stream_of(spark, src, "name string, ts timestamp"), "name")
        return run_stream(spark, st, "u", mode="update", key_cols=["name"], base=base).wait()
    assert rows(go().result(), "name", "count") == [("a", 1), ("b", 1)]
    import pyarrow.parquet as pq
    path = os.path.join(src, "b0001.parquet")
    pq.write_table(pa.Table.from_pylist([{"name": "a", "ts": at(5)}], schema=EV), path)
    assert rows(go().result(), "name", "count") == [("a", 2), ("b", 1)]


def test_upsert_mode_versions_across_restart(spark, tmp_dir):
    from rillflow.operators.aggregates import count_by
    src = os.path.join(tmp_dir, "in")
    base = os.path.join(tmp_dir, "run")
    write_batches(src, [[{"name": "a", "ts": at(0)}], [{"name": "d", "ts": at(1)}]], EV)

    def go():
        st = count_by(stream_of(spark, src, "name string, ts timestamp"), "name")
        return run_stream(spark, st, "ups", mode="upsert", key_cols=["name"], base=base, bucket_rows=1).wait()
    first = go()
    assert first.last_batch() == 1
    assert rows(first.result(), "name", "count") == [("a", 1), ("d", 1)]
    import pyarrow.parquet as pq
    path = os.path.join(src, "b0002.parquet")
    pq.write_table(pa.Table.from_pylist([{"name": "a", "ts": at(5)}], schema=EV), path)
    second = go()
    assert second.last_batch() == 2
    assert rows(second.result(), "name", "count") == [("a", 2), ("d", 1)]
    # the older version is still whole and readable
    assert rows(second.at_batch(1), "name", "count") == [("a", 1), ("d", 1)]
    # only the bucket of "a" was written again (its hash and that of "d" differ in the first bit)
    written = spark.read.parquet(os.path.join(base, "output", "rows", "v=2"))
    assert rows(written, "name") == [("a",)]
    # a restart with nothing new still reads the newest version
    third = go()
    assert third.last_batch() == 2
    assert rows(third.result(), "name", "count") == [("a", 2), ("d", 1)]


def test_lookup_table_is_read_again_per_batch(spark, tmp_dir):
    from rillflow.operators.joins import lookup_join
    from rillflow.streaming.lookup import enrich_each_batch
    from pyspark.sql import types as T
    src = os.path.join(tmp_dir, "in")
    table = os.path.join(tmp_dir, "table")
    base = os.path.join(tmp_dir, "run")
    spark.createDataFrame([("roshan", "last=soni")], "user string, info string") \
        .write.mode("overwrite").parquet(table)
    write_batches(src, [[{"key": "roshan", "ts": at(1), "seq": 1, "value": "rapple(1)"}]], CH)
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("info", T.StringType())])

    def go():
        st = stream_of(spark, src, "key string, ts timestamp, seq long, value string")
        return enrich_each_batch(
            spark, st, lambda: spark.read.parquet(table),
            lambda b, t: lookup_join(b, t, "key", "user", "left").select("seq", "info"),
            "refresh", base=base).wait()
    go()
    spark.createDataFrame([("roshan", "last=sonyy")], "user string, info string") \
        .write.mode("overwrite").parquet(table)
    import pyarrow.parquet as pq
    path = os.path.join(src, "b0001.parquet")
    pq.write_table(pa.Table.from_pylist(
        [{"key": "roshan", "ts": at(5), "seq": 5, "value": "rorange(3)"}], schema=CH), path)
    got = rows(go().result(schema), "seq", "info")
    assert got == [(1, "last=soni"), (5, "last=sonyy")]


def test_table_stream_update_mode_carries_deletes(spark, tmp_dir):
    from rillflow.operators.tables import latest_per_key
    ch = _changes(spark, tmp_dir, [
        [{"key": "a", "ts": at(1), "seq": 1, "value": "x"},
         {"key": "b", "ts": at(2), "seq": 2, "value": "y"}],
        [{"key": "a", "ts": at(3), "seq": 3, "value": None},
         {"key": "b", "ts": at(4), "seq": 4, "value": "z"}]])
    table = latest_per_key(ch, "key", ["value"], ["seq"], keep_deletes=True)
    out = run_stream(spark, table, "tbl", mode="update", key_cols=["key"],
                     base=os.path.join(tmp_dir, "run")).wait().result()
    assert rows(out.filter(~F.col("__deleted")), "key", "value") == [("b", "z")]


def test_live_sessions_in_order_batches_match_batch_sessions(spark, tmp_dir):
    import random
    from rillflow.operators.windows import session_count
    S.use_rocksdb_state(spark)
    rnd = random.Random(21)
    evs, t = [], {k: 0 for k in "abc"}
    for i in range(240):
        k = rnd.choice("abc")
        t[k] += rnd.choice([10, 60, 200, 299, 300, 301, 900])
        evs.append({"key": k, "ts": at(t[k]), "seq": i, "value": None})
    batches = [evs[i:i + 60] for i in range(0, 240, 60)]  # sessions span batch edges
    ch = _changes(spark, tmp_dir, batches)
    ev = ch.select("key", "ts", "seq").withWatermark("ts", "1 hour")
    out = run_stream(spark, S.live_sessions(ev, 300), "live_in_order",
                     base=os.path.join(tmp_dir, "run")).wait().result()
    cur = S.sessions_from_updates(out)
    static = spark.createDataFrame([(e["key"], e["ts"]) for e in evs], "key string, ts timestamp")
    want = session_count(static, "key", "ts", 300)
    assert rows(cur, "key", "window_start", "window_end", "count") == \
        rows(want, "key", "window_start", "window_end", "count")


def test_live_sessions_of_rows_in_any_order():
    """The processor alone, on random batches with late rows, against one row after the other."""
    import random

    import pandas as pd
    from rillflow.streaming.processors import LiveSessions

    class Held:
        def __init__(self):
            self.value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def put(self, v):
            self.value = v

        update = put

        def clear(self):
            self.value = None

    class Handle:
        getListState = getValueState = lambda self, *a: Held()
        registerTimer = deleteTimer = lambda self, *a: None

    r = random.Random(4)
    for _ in range(150):
        p, gap = LiveSessions(10), 10_000_000
        p.init(Handle())
        open_, seq = [], 0
        for _ in range(4):
            t = sorted(r.randrange(0, 200) * 1_000_000 for _ in range(r.randrange(1, 15)))
            want = []
            seqs = list(range(seq, seq + len(t)))
            seq += len(t)
            for at_, s in zip(t, seqs):
                near = [x for x in open_ if x[0] - gap <= at_ <= x[1] + gap]
                new = (min([at_, *(x[0] for x in near)]), max([at_, *(x[1] for x in near)]), 1 + sum(x[2] for x in near))
                want += [(s, *x, True) for x in near] + [(s, *new, False)]
                open_ = [x for x in open_ if x not in near] + [new]
            frame = pd.DataFrame({"key": "k", "ts": pd.to_datetime(t, unit="us"), "t_us": t, "seq": seqs})
            frame = frame.sample(frac=1, random_state=1)
            (out,) = list(p.handleInputRows(("k",), iter([frame]), None))
            got = list(zip(out["seq"], out["start_us"], out["end_us"], out["count"], out["deleted"]))
            assert sorted(got) == sorted(want)
            assert sorted(p.open.get()) == sorted(open_)


def test_streams_skip_null_keys_and_amounts_as_batches_do(spark, tmp_dir):
    """Events without a user, and users without an amount: streams give what the batch queries give."""
    import shutil

    import pyarrow.parquet as pq
    from rillflow.plans import all_queries
    src = os.path.join(tmp_dir, "sf")
    os.makedirs(src)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(120)
    odd = ev.withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id") % 5)) \
        .withColumn("value", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    pq.write_table(odd.toArrow(), os.path.join(src, "events.parquet"))
    for t in ("customer", "part", "lineitem"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", src)
    q = all_queries()
    for batch, stream in (("running_balance", "running_balance_stream"), ("session_count", "session_count_live"),
                          ("bank_balance_aggregate", "bank_balance_stream"), ("running_balance", "running_balance_through_topic")):
        b, s = q[batch](spark, src), q[stream](spark, src)
        cols = [c for c in b.columns if c in s.columns]
        want = sorted(map(repr, b.select(*cols).collect()))
        assert want and sorted(map(repr, s.select(*cols).collect())) == want, stream
    sessions = q["session_changes_stream"](spark, src).filter("NOT deleted").count()
    assert sessions == odd.filter("user_id IS NOT NULL").count()
