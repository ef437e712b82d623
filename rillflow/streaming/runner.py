"""Run a streaming DataFrame into a sink under the shared checkpoint folder.

* ``append``: a parquet file sink. Its commit log makes output exactly-once; readers
  see only committed files.
* ``update`` / ``complete``: ``foreachBatch`` writes each micro-batch to a folder named
  by its batch id with overwrite, so a replayed batch replaces itself (idempotent,
  exactly-once). The current table is the newest row per key over all batches
  (update) or the last batch (complete).
* ``upsert`` (a compacted output): each update-mode batch is merged into the buckets of
  the table that it touches (see :class:`rillflow.sinks.tables.CompactedTable`), so a batch costs
  what it changes; readers read one whole version, that of the last batch.

Checkpoints and output live under ``spark.checkpoint.dir`` (shared storage on a
cluster), so a restarted driver or lost executor resumes from the last commit.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillflow.operators.tables import latest_per_key
from rillflow.session import scratch_path
from rillflow.sinks.tables import LIMIT, CompactedTable, newest


#: What every stream here runs with: state in RocksDB (the processors need it), and a hot key's
#: rows merged into partial sessions before the shuffle of a session window.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


@contextmanager
def stream_settings(spark: SparkSession, more: dict | None = None):
    """The settings (and ``more``) while a stream starts: it keeps those it started with, and the session
    gets its own back, so no query depends on which others ran before it."""
    wanted = {**STREAM_CONF, **(more or {})}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _missing(e: AnalysisException) -> bool:
    """Whether the folder is not there, as before the first batch; anything else is an error."""
    return e.getCondition() == "PATH_NOT_FOUND"


@dataclass
class StreamRun:
    spark: SparkSession
    query: StreamingQuery
    output: str
    checkpoint: str
    mode: str
    schema: object
    key_cols: list[str] | None = None
    bucket_rows: int = LIMIT

    def wait(self) -> StreamRun:
        self.query.awaitTermination()
        return self

    def last_batch(self) -> int | None:
        """Id of the last committed batch: from this run's progress, else (a restart
        that found no new data) the newest batch folder an earlier run wrote."""
        # an idle trigger also reports progress (with the next batch id) but runs
        # nothing; a batch that ran has an addBatch time
        done = [p["batchId"] for p in self.query.recentProgress
                if "addBatch" in p.get("durationMs", {})]
        if done:
            return max(done)
        folder, col = ((f"{self.output}/manifest", "b") if self.mode == "upsert"
                       else (f"{self.output}/batches", "__b"))
        try:
            return self.spark.read.parquet(folder).agg(F.max(col)).first()[0]
        except AnalysisException as e:
            if not _missing(e):
                raise
            return None

    def at_batch(self, batch_id: int) -> DataFrame:
        """The compacted table as a batch left it (upsert mode)."""
        return self.table().at(batch_id).select(*self.schema.fieldNames())

    def table(self) -> CompactedTable:
        """The compacted table that an upsert-mode run writes."""
        schema = T.StructType([*self.schema.fields, T.StructField("__batch", T.LongType())])
        return CompactedTable(self.spark, self.output, schema, self.key_cols, self.bucket_rows)

    def result(self) -> DataFrame:
        """The sink's current content as a static DataFrame."""
        if self.mode == "append":
            return self.spark.read.schema(self.schema).parquet(self.output)
        names = self.schema.fieldNames()
        if self.mode == "upsert":
            last = self.last_batch()
            if last is None:
                return self.spark.createDataFrame([], self.schema)
            return self.at_batch(last)
        try:
            batches = self.spark.read.parquet(f"{self.output}/batches")
        except AnalysisException as e:
            if not _missing(e):
                raise
            return self.spark.createDataFrame([], self.schema)  # no batch written yet
        if self.mode == "complete":
            # each batch holds the whole result: only the last committed one is read
            last = self.last_batch()
            if last is None:
                return self.spark.createDataFrame([], self.schema)
            return batches.filter(F.col("__b") == F.lit(last)).select(*names)
        batches = batches.select(*names, "__batch")
        values = [c for c in names if c not in self.key_cols]
        return latest_per_key(batches, self.key_cols, values, ["__batch"],
                              tombstone=F.lit(False), null_keys=True).select(*names)


def run_stream(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append",
               key_cols: list[str] | None = None, trigger: dict | None = None,
               base: str | None = None, bucket_rows: int = LIMIT, conf: dict | None = None) -> StreamRun:
    """Start ``stream`` into a fresh sink folder; ``trigger`` defaults to
    ``availableNow`` (process what is there, then stop). ``bucket_rows`` is the size beyond which
    a bucket of a compacted output is split, ``conf`` more settings of the stream."""
    base = base or scratch_path(spark, "streams", name)
    out, ckpt = f"{base}/output", f"{base}/checkpoint"
    trig = trigger or {"availableNow": True}
    schema = stream.schema
    if mode == "append":
        w = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", ckpt).trigger(**trig).option("path", out))
    elif mode == "upsert":
        if not key_cols:
            raise ValueError("upsert mode needs key_cols")
        values = [c for c in schema.fieldNames() if c not in key_cols]
        table = CompactedTable(spark, out, T.StructType([*schema.fields, T.StructField("__batch", T.LongType())]), key_cols, bucket_rows)

        def upsert_batch(batch: DataFrame, batch_id: int) -> None:
            rows = batch.withColumn("__batch", F.lit(batch_id).cast("long"))
            table.upsert(batch_id, rows, newest(key_cols, values, "__batch"))

        w = (stream.writeStream.outputMode("update").foreachBatch(upsert_batch)
             .option("checkpointLocation", ckpt).trigger(**trig))
    else:
        if mode == "update" and not key_cols:
            raise ValueError("update mode needs key_cols to rebuild the table")

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            (batch.withColumn("__batch", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").parquet(f"{out}/batches/__b={batch_id}"))

        w = (stream.writeStream.outputMode(mode).foreachBatch(write_batch)
             .option("checkpointLocation", ckpt).trigger(**trig))
    with stream_settings(spark, conf):
        q = w.start()
    return StreamRun(spark, q, out, ckpt, mode, schema, key_cols, bucket_rows)
