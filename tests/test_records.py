"""The topic folder: offsets, seek, assign, transactions that abort or run again, restarts; and
lines printed once."""

import os

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import rows, write_batches
from rillflow.sinks.console import LineFiles
from rillflow.sinks.topics import append_records, append_records_stream
from rillflow.sources import records as R
from rillflow.streaming.runner import run_stream

DDL = "key binary, value binary, partition int, timestamp timestamp"


def some(spark, first, n, parts=3):
    return spark.range(first, first + n, numPartitions=2).select(
        F.col("id").cast("string").cast("binary").alias("key"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("v"), F.col("id")).cast("binary")).alias("value"),
        (F.col("id") % parts).cast("int").alias("partition"), F.timestamp_millis("id").alias("timestamp"))


def got(df):
    return sorted((r.partition, r.offset, r.key.decode(), None if r.value is None else r.value.decode(), r.topic) for r in df.collect())


def test_offsets_are_gapless_over_transactions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    assert R.read_records(spark, path, "t").count() == 0
    append_records(some(spark, 0, 10), path)
    append_records(some(spark, 10, 1), "file://" + path)
    append_records(some(spark, 11, 9), path)
    out = R.read_records(spark, path, "t")
    assert out.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    seen = got(out)
    assert sorted(k for _, _, k, _, _ in seen) == sorted(map(str, range(20)))
    for p in range(3):
        assert [o for q, o, *_ in seen if q == p] == list(range(len([x for x in seen if x[0] == p])))
    assert {v for *_, v, _ in seen if v} == {f"v{i}" for i in range(20) if i % 7} and {t for *_, t in seen} == {"t"}
    assert out.filter("unix_millis(timestamp) <> CAST(CAST(key AS STRING) AS BIGINT)").count() == 0
    assert R.committed_batches(path) == [0, 1, 2]


def test_seek_and_assign(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    for i in range(4):
        append_records(some(spark, 10 * i, 10), path)
    every = got(R.read_records(spark, path, "t"))
    assert got(R.read_records(spark, path, "t", starting_offsets={0: 5, 2: 12}, assign=[0, 2])) == \
        [x for x in every if (x[0], x[1]) >= (0, 5) and x[0] == 0 or x[0] == 2 and x[1] >= 12]
    assert got(R.read_records(spark, path, "t", starting_offsets={1: 3}, ending_offsets={1: 7, 0: 1})) == \
        [x for x in every if x[0] == 1 and 3 <= x[1] < 7 or x[0] == 0 and x[1] < 1 or x[0] == 2]
    assert got(R.read_records(spark, path, "t", starting_offsets={0: 99, 1: 99, 2: 99})) == []
    reader = R.BatchReader({"path": path})
    monkeypatch.setattr(R, "SPLIT", 4)  # a partition is read in several ranges
    ranges = reader.partitions()
    assert len(ranges) > 9 and all(r.last - r.first <= 4 for r in ranges)
    assert sum(b.num_rows for r in ranges for b in reader.read(r)) == 40


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_dir):
    path, base = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "run")

    def go():
        st = R.read_records(spark, path, "t", starting_offsets={0: 2}, streaming=True)
        return run_stream(spark, st.select("partition", "offset", "key"), "s", base=base).wait().result()
    append_records(some(spark, 0, 12), path)
    assert got_places(go()) == [(p, o) for p in range(3) for o in range(4) if p or o >= 2]
    append_records(some(spark, 12, 6), path)
    assert got_places(go()) == [(p, o) for p in range(3) for o in range(6) if p or o >= 2]
    assert got_places(go()) == [(p, o) for p in range(3) for o in range(6) if p or o >= 2]  # nothing new


def got_places(df):
    return sorted((r.partition, r.offset) for r in df.collect())


def test_aborted_attempts_leave_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    append_records(some(spark, 0, 6), path)
    bad = some(spark, 6, 6).withColumn("value", F.when(F.col("key") == b"11", F.raise_error("no").cast("binary")).otherwise(F.col("value")))
    with pytest.raises(Exception):
        append_records(bad, path)
    assert R.committed_batches(path) == [0] and R.read_records(spark, path, "t").count() == 6
    append_records(some(spark, 6, 6), path)
    assert [k for _, _, k, _, _ in sorted(got(R.read_records(spark, path, "t")), key=lambda x: int(x[2]))] == list(map(str, range(12)))


def test_a_batch_runs_again_after_its_commit(spark, tmp_dir):
    """The sink committed, the query's own commit is lost: the batch runs again and adds nothing."""
    src = write_batches(os.path.join(tmp_dir, "in"), [
        [{"key": f"{10 * b + i}".encode(), "value": b"x", "partition": i % 2} for i in range(6)] for b in range(3)],
        pa.schema([("key", pa.binary()), ("value", pa.binary()), ("partition", pa.int32())]))
    path, ckpt = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "c")

    def go(broken=False):
        st = spark.readStream.schema("key binary, value binary, partition int").option("maxFilesPerTrigger", 1).parquet(src) \
            .withColumn("timestamp", F.timestamp_millis(F.lit(0)))
        if broken:
            st = st.withColumn("value", F.when(F.col("key") == b"15", F.raise_error("no").cast("binary")).otherwise(F.col("value")))
        append_records_stream(st, path, ckpt).awaitTermination()
    with pytest.raises(StreamingQueryException):
        go(broken=True)
    assert R.committed_batches(path) == [0] and R.read_records(spark, path, "t").count() == 6
    go()
    whole = got(R.read_records(spark, path, "t"))
    assert len(whole) == 18
    for f in ("2", ".2.crc"):
        os.remove(os.path.join(ckpt, "commits", f))
    go()
    assert got(R.read_records(spark, path, "t")) == whole


def test_lines_are_printed_once(tmp_path):
    folder = str(tmp_path / "lines")

    def attempt(partition, epoch, lines, error=None):
        w = LineFiles(folder)
        if w.open(partition, epoch):
            for line in lines:
                w.process({"line": line})
        w.close(error)
    read = lambda: sorted(x for f in os.listdir(folder) for x in open(os.path.join(folder, f)).read().split())
    attempt(0, 0, ["a", "b"])
    attempt(1, 0, ["c"], error=ValueError())  # failed: nothing is seen
    assert read() == ["a", "b"]
    attempt(1, 0, ["c"])
    attempt(0, 0, ["a", "b"])  # the epoch runs again
    attempt(0, 1, ["a"])
    assert read() == ["a", "a", "b", "c"]


def test_printed_stream_replays(spark, tmp_dir):
    from rillflow.sinks.console import for_each_record
    src = write_batches(os.path.join(tmp_dir, "in"), [[{"line": "x"}, {"line": "y"}], [{"line": "z"}]], pa.schema([("line", pa.string())]))
    lines, ckpt = os.path.join(tmp_dir, "lines"), os.path.join(tmp_dir, "c")

    def go():
        st = spark.readStream.schema("line string").option("maxFilesPerTrigger", 1).parquet(src)
        for_each_record(st, LineFiles(lines), ckpt, trigger={"availableNow": True}).awaitTermination()
        return rows(spark.read.text(lines), "value")
    assert go() == [("x",), ("y",), ("z",)]
    for f in ("1", ".1.crc"):
        os.remove(os.path.join(ckpt, "commits", f))
    assert go() == [("x",), ("y",), ("z",)]
