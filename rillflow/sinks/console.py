"""Printing streams (with an optional label) and per-record side effects."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Ship what runs on executors inside the job itself, so that it runs where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def labeled(df: DataFrame, label: str | None) -> DataFrame:
    """Rows with the label as a first column (``[label]: key, value`` prints)."""
    return df if label is None else df.select(F.lit(label).alias("label"), *df.columns)


def print_stream(df: DataFrame, checkpoint: str, label: str | None = None,
                 mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Console sink."""
    w = (labeled(df, label).writeStream.format("console").outputMode(mode)
         .option("truncate", "false").option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def for_each_record(df: DataFrame, fn: Callable, checkpoint: str,
                    mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Call ``fn(row)``, or the writer ``fn`` (``open``, ``process``, ``close``), for every output row on the
    executors (``writeStream.foreach``)."""
    w = df.writeStream.foreach(fn).outputMode(mode).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


class LineFiles:
    """A per-record effect that happens once: every row's ``line`` is printed to a file of its
    (partition, epoch), for ``writeStream.foreach``.

    ``open`` skips a (partition, epoch) that was closed before, as when a batch runs again after its
    effect but before its commit; ``process`` prints a line to a file nobody reads; ``close``
    gives that file its name, unless the attempt failed. Spark deals a batch that runs again into
    the same partitions if the input is the same, which files and topics are.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        from pyarrow import fs

        path = self.folder
        if path.startswith("file:"):
            path = "/" + path.removeprefix("file:").lstrip("/")
        self.files, base = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
        self.name = f"{base}/{epoch_id}-{partition_id}.txt"
        self.skips = self.files.get_file_info(self.name).type != fs.FileType.NotFound
        if self.skips:
            return False
        self.files.create_dir(base, recursive=True)
        self.unseen = f"{base}/_{epoch_id}-{partition_id}-{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.unseen)
        return True

    def process(self, row) -> None:
        self.out.write(f"{row['line']}\n".encode())

    def close(self, error: Exception | None) -> None:
        if self.skips:
            return
        self.out.close()
        if error is None:
            self.files.move(self.unseen, self.name)
        else:
            self.files.delete_file(self.unseen)


# The printed line of a windowed count (a form of our own).
WINDOW_LINE_FORMAT = "name= %s window start=%s window end=%s count= %d"


def window_lines(df: DataFrame, key: str, count: str = "count") -> DataFrame:
    """One text line per windowed count: key, window bounds and count."""
    return df.select(F.format_string(WINDOW_LINE_FORMAT,
                                     F.col(key).cast("string"),
                                     F.col("window_start").cast("string"),
                                     F.col("window_end").cast("string"),
                                     F.col(count)).alias("line"))
