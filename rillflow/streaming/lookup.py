"""Stream x table lookups where the table changes while the stream runs.

A stream-static join plans its static side from a file listing taken once; a replicated
table that keeps changing must be read again for each micro-batch. ``foreachBatch``
does that: each batch loads the table's current version, joins, and writes its result
to a folder named by the batch id (overwrite, so a replayed batch replaces itself).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillflow.session import scratch_path


@dataclass
class LookupRun:
    spark: SparkSession
    query: StreamingQuery
    output: str

    def wait(self) -> LookupRun:
        self.query.awaitTermination()
        return self

    def last_batch(self) -> int:
        """Id of the last batch that ran here; -1 if none did."""
        return max((p["batchId"] for p in self.query.recentProgress if "addBatch" in p.get("durationMs", {})), default=-1)

    def result(self, schema) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.output}/batches") \
                .select(*schema.fieldNames())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # no batch written yet


def enrich_each_batch(spark: SparkSession, stream: DataFrame,
                      load_table: Callable[[], DataFrame],
                      join: Callable[[DataFrame, DataFrame], DataFrame], name: str,
                      trigger: dict | None = None, base: str | None = None) -> LookupRun:
    """Run ``join(batch, load_table())`` for every micro-batch of ``stream``."""
    base = base or scratch_path(spark, "lookups", name)
    out, ckpt = f"{base}/output", f"{base}/checkpoint"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        join(batch, load_table()).write.mode("overwrite") \
            .parquet(f"{out}/batches/__b={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
         .trigger(**(trigger or {"availableNow": True})).start())
    return LookupRun(spark, q, out)
