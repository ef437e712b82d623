"""Reading a streaming query's state (the named materialisation of an aggregate).

State lives under the query's checkpoint; Spark's ``statestore`` data source reads it
as a table (key, value, partition_id) without touching the running query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_state(spark: SparkSession, checkpoint: str, operator_id: int = 0,
               store_name: str | None = None, batch_id: int | None = None,
               state_var: str | None = None) -> DataFrame:
    """State rows of one stateful operator (``stateVarName`` for state API v2
    processors)."""
    r = spark.read.format("statestore").option("operatorId", operator_id)
    if store_name:
        r = r.option("storeName", store_name)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    if state_var:
        r = r.option("stateVarName", state_var)
    return r.load(checkpoint)


def read_changes(spark: SparkSession, checkpoint: str, first_batch: int = 0, last_batch: int | None = None,
                 operator_id: int = 0) -> DataFrame:
    """What each micro-batch changed in the state: ``batch_id, change_type, key, value, partition_id``.
    RocksDB keeps it if the stream ran with changelog checkpoints."""
    r = spark.read.format("statestore").option("operatorId", operator_id).option("readChangeFeed", True) \
        .option("changeStartBatchId", first_batch)
    if last_batch is not None:
        r = r.option("changeEndBatchId", last_batch)
    return r.load(checkpoint)


def state_metadata(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Which stateful operators and stores a checkpoint holds."""
    return spark.read.format("state-metadata").load(checkpoint)
