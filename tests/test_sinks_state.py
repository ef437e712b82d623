"""Sinks (records, upserts, labels), state inspection, partitioning, JSON round trips."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from rillflow.operators.partitioning import co_locate, with_partition
from rillflow.operators.windows import tumbling_count
from rillflow.plans.ranking import parse_top3, top3_sorted
from rillflow.sinks.console import labeled, window_lines
from rillflow.sinks.tables import CompactedTable, newest, summed
from rillflow.sinks.topics import write_records
from rillflow.sources.topics import records_from_table, topic_values
from rillflow.streaming.runner import run_stream
from rillflow.streaming.state import read_state, state_metadata

T0 = datetime(2024, 1, 1)


def test_records_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 5), (2, None, None)], "id long, name string, amount int")
    rec = records_from_table(df, "t", "id", ["name", "amount"], "id", F.current_timestamp(), 3)
    path = os.path.join(tmp_dir, "topic")
    write_records(rec, path)
    back = topic_values(spark.read.parquet(path))
    assert rows(back, "key", "value", "offset") == [("1", '{"name":"a","amount":5}', 1),
                                                     ("2", None, 2)]
    assert all(0 <= r.partition < 3 for r in back.collect())


ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("o", T.LongType())])


def test_compacted_table_deletes_and_replays(spark, tmp_dir):
    table = CompactedTable(spark, tmp_dir, ROW, "k", limit=1)
    batches = [[("a", 1, 0), ("b", 2, 0), (None, 3, 0)], [("a", None, 1)], [("c", 5, 2), ("b", 6, 2)], []]
    want = [{"a": 1, "b": 2, None: 3}, {"b": 2, None: 3}, {"b": 6, "c": 5, None: 3}, {"b": 6, "c": 5, None: 3}]
    for i, given in enumerate(batches):
        for _ in range(2):  # the same batch again changes nothing
            table.upsert(i, spark.createDataFrame(given, ROW), newest(["k"], ["n"], "o"))
        assert {r.k: r.n for r in table.at(i).collect()} == want[i]
        if i:  # the version before is whole
            assert {r.k: r.n for r in table.at(i - 1).collect()} == want[i - 1]


def test_buckets_split_and_old_versions_go(spark, tmp_dir):
    """A table of one bucket and one of many that split agree; after 20 batches the disk holds little
    more than the last versions."""
    def stored(base):
        return sum(len([f for f in files if f.endswith(".parquet")]) for _, _, files in os.walk(base))

    tables = [CompactedTable(spark, os.path.join(tmp_dir, str(n)), ROW, "k", limit=n) for n in (1_000_000, 20)]
    total = {}
    for i in range(20):
        given = [(f"k{j * (i + 1) % 500}", j, i) for j in range(0, 60)]
        for k, n, _ in given:
            total[k] = total.get(k, 0) + n
        for t in tables:
            t.upsert(i, spark.createDataFrame(given, ROW),
                     lambda df: summed(["k"], ["n"])(df).withColumn("o", F.lit(0).cast("long")))
    for t in tables:
        assert {r.k: r.n for r in t.at(19).collect()} == total
        buckets = t.buckets(19)
        rows_in = {b.name: t.read([b]).count() for b in buckets if t.limit < 100}
        assert all(n <= t.limit for n in rows_in.values())
        assert sum(2.0 ** -b.depth for b in buckets) == 1  # the buckets are all keys, none twice
        assert stored(os.path.join(t.base, "rows")) <= 3 * len(buckets)
        assert sorted(os.listdir(os.path.join(t.base, "manifest"))) == ["b=18", "b=19"]


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_dir):
    table = CompactedTable(spark, tmp_dir, ROW, "k", limit=3)
    table.upsert(0, spark.createDataFrame([(f"k{j}", j, 0) for j in range(100)], ROW), newest(["k"], ["n"], "o"))
    wanted = spark.createDataFrame([("k7",), ("nobody",)], "fk string")
    found = table.lookup(wanted, 0, ["fk"])
    assert len(found.inputFiles()) <= 2 < 10 < len(table.at(0).inputFiles())
    assert [r.n for r in found.filter("k = 'k7'").collect()] == [7]


def test_state_of_a_windowed_count(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame([("a", T0), ("a", T0 + timedelta(seconds=1))],
                          "name string, ts timestamp").write.parquet(src)
    st = tumbling_count(spark.readStream.schema("name string, ts timestamp").parquet(src),
                        "name", "ts", "30 seconds", grace="1 hour")
    run = run_stream(spark, st, "s", base=os.path.join(tmp_dir, "run")).wait()
    assert run.result().count() == 0  # window still open
    state = read_state(spark, run.checkpoint)
    assert state.count() == 1
    assert state_metadata(spark, run.checkpoint).count() >= 1


def test_partitioning_and_labels(spark):
    df = spark.createDataFrame([("divya",), ("roshan",), ("shubham",)], "name string")
    parts = [r.partition for r in with_partition(df, "name", 2).collect()]
    assert all(p in (0, 1) for p in parts)
    assert co_locate(df, "name", 2).rdd.getNumPartitions() == 2
    assert labeled(df, "KT1").columns == ["label", "name"]
    w = spark.createDataFrame([("a", T0, T0 + timedelta(seconds=30), 2)],
                              "name string, window_start timestamp, window_end timestamp, count long")
    assert window_lines(w, "name").first().line.startswith("name= a window start=2024-01-01")


def test_top3_json_round_trip(spark):
    counts = spark.createDataFrame([("x", 3), ("y", 9)], "news_type string, clicks long")
    js = top3_sorted(counts)
    back = js.select(parse_top3("top3_sorted").alias("a")).first().a
    assert [(e.NewsType, e.Clicks) for e in back] == [("y", 9), ("x", 3)]


def test_console_and_per_record_sinks_run(spark, tmp_dir):
    from rillflow.sinks.console import for_each_record, print_stream
    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long").write.parquet(src)
    stream = spark.readStream.schema("name string, n long").parquet(src)
    q = print_stream(stream, os.path.join(tmp_dir, "c1"), label="KT1",
                     trigger={"availableNow": True})
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 2
    marks = os.path.join(tmp_dir, "marks")
    os.makedirs(marks)

    def touch(row, folder=marks):  # runs on the Python workers, once per row
        open(os.path.join(folder, row["name"]), "w").close()

    q2 = for_each_record(stream, touch, os.path.join(tmp_dir, "c2"))
    q2.processAllAvailable()
    q2.stop()
    assert sorted(os.listdir(marks)) == ["a", "b"]
