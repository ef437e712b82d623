"""A topic as a folder: records with a partition and gapless offsets, written in transactions.

``TopicFolder`` is a data source for batch and stream, reading and writing, under the name
``topic_folder`` (:func:`register`). A writer's task appends one file per topic partition; nothing
of it is seen until the commit of its batch writes a manifest, which gives each file the
offsets behind the newest ones of its partition. An aborted attempt's files are removed (a task
that was killed may leave one behind, which no manifest names and nobody reads), and a batch
that was committed before and runs again adds nothing. So a reader meets every record of a
committed batch once, and the offsets of a partition have no gaps.

A reader has one input partition per topic partition and range of offsets. Options:
``startingOffsets`` (``earliest`` or JSON ``{"0": 5}``, an offset per partition; partitions not named
start at 0), ``endingOffsets`` (JSON, batch only), ``assign`` (JSON list of partitions, all by
default). A stream's progress is its checkpoint; ``startingOffsets`` counts when that is new.

Folders are reached through Arrow's file systems, by the same path from all tasks: local or shared
disks, HDFS, S3, GCS. Writer options: ``path``, ``topic``; a row needs ``key``, ``value``,
``partition`` and ``timestamp``.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

# Ship these classes inside the job itself, so that they run where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
#: Records that one input partition reads at most.
SPLIT = 1_000_000


def _files(path: str):
    """The file system of a path, and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _manifests(path: str, after: int = -1) -> list[dict]:
    """The committed batches after one, in order: ``batch``, ``next`` (the offset behind each
    partition's last), ``files`` of ``name, partition, first, count``."""
    from pyarrow import fs

    files, base = _files(path)
    listed = files.get_file_info(fs.FileSelector(f"{base}/manifests", allow_not_found=True))
    ids = sorted(int(f.base_name.removesuffix(".json")) for f in listed if f.base_name.endswith(".json"))
    out = []
    for i in ids:
        if i > after:
            with files.open_input_stream(f"{base}/manifests/{i:012d}.json") as f:
                out.append(json.loads(f.read()))
    return out


@dataclass
class Range(InputPartition):
    """Offsets from ``first`` up to ``last`` of a topic partition, and the files that hold them."""

    partition: int
    first: int
    last: int
    files: list

    def __init__(self, partition: int, first: int, last: int, files: list):
        super().__init__(None)
        self.partition, self.first, self.last, self.files = partition, first, last, files


class _Reading:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.topic = options.get("topic", "")
        self.assign = json.loads(options["assign"]) if options.get("assign") else None
        start = options.get("startingOffsets", "earliest")
        self.start = {} if start == "earliest" else {int(p): o for p, o in json.loads(start).items()}
        self.end = {int(p): o for p, o in json.loads(options.get("endingOffsets") or "{}").items()}

    def ends(self) -> dict[int, int]:
        """The offset behind the last one of each partition that is read."""
        last = _manifests(self.path)[-1:]
        ends = {int(p): o for m in last for p, o in m["next"].items()}
        return {p: o for p, o in ends.items() if self.assign is None or p in self.assign}

    def ranges(self, start: dict[int, int], end: dict[int, int]) -> list[Range]:
        files: dict[int, list] = {}
        for m in _manifests(self.path):
            for f in m["files"]:
                files.setdefault(f["partition"], []).append(f)
        out = []
        for p, last in sorted(end.items()):
            for a in range(start.get(p, 0), last, SPLIT):
                b = min(a + SPLIT, last)
                out.append(Range(p, a, b, [f for f in files.get(p, []) if f["first"] < b and f["first"] + f["count"] > a]))
        return out

    def read(self, partition: Range | None) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        if partition is None:  # what Spark asks for where there are no ranges
            return
        files, base = _files(self.path)
        for f in sorted(partition.files, key=lambda f: f["first"]):
            at = f["first"]
            with files.open_input_file(f"{base}/{f['name']}") as source:
                for batch in pq.ParquetFile(source).iter_batches(10_000, columns=["key", "value", "timestamp"]):
                    a, b = max(partition.first - at, 0), min(partition.last - at, batch.num_rows)
                    if a < b:
                        rows = batch.slice(a, b - a)
                        n = rows.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [rows.column("key"), rows.column("value"), pa.array([self.topic] * n, pa.string()),
                             pa.array([partition.partition] * n, pa.int32()), pa.array(range(at + a, at + b), pa.int64()),
                             rows.column("timestamp")], names=["key", "value", "topic", "partition", "offset", "timestamp"])
                    at += batch.num_rows


class BatchReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Range]:
        end = {p: min(o, self.end.get(p, o)) for p, o in self.ends().items()}
        return self.ranges(self.start, end)


class StreamReader(_Reading, DataSourceStreamReader):
    """Offsets are ``{"<partition>": next offset}``; a partition not named there begins at 0."""

    def initialOffset(self) -> dict:
        return {str(p): o for p, o in self.start.items()}

    def latestOffset(self) -> dict:
        return {**self.initialOffset(), **{str(p): o for p, o in self.ends().items()}}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.ranges({int(p): o for p, o in start.items()}, {int(p): o for p, o in end.items()})


@dataclass
class Written(WriterCommitMessage):
    """A task's files: ``name, partition, count`` of each."""

    files: list


class _Writing:
    """What the batch and the stream writer share."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator) -> Written:
        """Appends a task's rows to one file for each topic partition, in their order."""
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        files, base = _files(self.path)
        files.create_dir(f"{base}/data", recursive=True)
        attempt = uuid.uuid4().hex
        schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", tz="UTC"))])
        open_files: dict[int, tuple] = {}
        counts: dict[int, int] = {}
        try:
            for batch in iterator:
                for p in pc.unique(batch.column("partition")).to_pylist():
                    mine = batch.filter(pc.equal(batch.column("partition"), p))
                    if p not in open_files:
                        sink = files.open_output_stream(f"{base}/data/{p}-{attempt}.parquet")
                        open_files[p] = (sink, pq.ParquetWriter(sink, schema))
                    rows = [mine.column(f.name).cast(f.type) for f in schema]
                    open_files[p][1].write_batch(pa.RecordBatch.from_arrays(rows, schema=schema))
                    counts[p] = counts.get(p, 0) + mine.num_rows
        except BaseException:  # a task that fails has no message by which its files could be removed
            for p, (sink, _) in open_files.items():
                sink.close()
                files.delete_file(f"{base}/data/{p}-{attempt}.parquet")
            raise
        for sink, writer in open_files.values():
            writer.close()
            sink.close()
        return Written([{"name": f"data/{p}-{attempt}.parquet", "partition": p, "count": n} for p, n in sorted(counts.items())])

    def remove(self, messages: list) -> None:
        """Removes what an attempt wrote."""
        files, base = _files(self.path)
        for m in messages:
            for f in m.files if m else []:
                files.delete_file(f"{base}/{f['name']}")

    def publish(self, messages: list, batch_id: int | None) -> None:
        """Writes the manifest of a batch, which makes its records seen at once."""
        done = _manifests(self.path)
        if batch_id is None:
            batch_id = done[-1]["batch"] + 1 if done else 0
        if any(m["batch"] == batch_id for m in done):
            self.remove(messages)  # committed before: this is a second run
            return
        following = {int(p): o for p, o in done[-1]["next"].items()} if done else {}
        given = []
        for m in messages:
            for f in m.files if m else []:
                first = following.get(f["partition"], 0)
                given.append({**f, "first": first})
                following[f["partition"]] = first + f["count"]
        files, base = _files(self.path)
        files.create_dir(f"{base}/manifests", recursive=True)
        name = f"{base}/manifests/{batch_id:012d}.json"
        unseen = f"{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(unseen) as f:
            f.write(json.dumps({"batch": batch_id, "next": following, "files": given}).encode())
        files.move(unseen, name)


class BatchWriter(_Writing, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self.publish(messages, None)

    def abort(self, messages: list) -> None:
        self.remove(messages)


class StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.remove(messages)


class TopicFolder(DataSource):
    """The data source; one writer at a time commits to a topic."""

    @classmethod
    def name(cls) -> str:
        return "topic_folder"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes ``topic_folder`` known to the session."""
    spark.dataSource.register(TopicFolder)


def read_records(spark: SparkSession, path: str, topic: str, starting_offsets: dict[int, int] | None = None,
                 ending_offsets: dict[int, int] | None = None, assign: list[int] | None = None,
                 streaming: bool = False) -> DataFrame:
    """Records of the topic in a folder: from an offset of each partition on (the first by default),
    up to one (batch only), of some partitions or all."""
    register(spark)
    r = (spark.readStream if streaming else spark.read).format("topic_folder").option("path", path).option("topic", topic)
    if starting_offsets is not None:
        r = r.option("startingOffsets", json.dumps(starting_offsets))
    if ending_offsets is not None:
        r = r.option("endingOffsets", json.dumps(ending_offsets))
    if assign is not None:
        r = r.option("assign", json.dumps(assign))
    return r.load()


def committed_batches(path: str) -> list[int]:
    """Ids of the batches that readers see."""
    return [m["batch"] for m in _manifests(path)]
