"""Streams whose state is a table: each micro-batch reads the buckets that its keys are in, joins
or sums with DataFrame functions, and writes those buckets again.

No row passes a Python worker (but for a user's own fold), and no key's rows are gathered: a key
with most of a micro-batch's rows is summed before the shuffle or spread over offset buckets. The
state is a :class:`~rillflow.sinks.tables.CompactedTable` per stream, in the shared folder; a
batch that runs again reads what the batch before left and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.time import money
from rillflow.operators.folds import Fold, fold_states, merge_states, state_schema
from rillflow.operators.running import running_sum
from rillflow.session import scratch_path
from rillflow.sinks.tables import LIMIT, CompactedTable, newest, summed
from rillflow.streaming.lookup import LookupRun
from rillflow.streaming.runner import stream_settings


def each_batch(spark: SparkSession, stream: DataFrame, base: str, work: Callable[[DataFrame, int], DataFrame | None],
               trigger: dict | None = None) -> LookupRun:
    """Runs ``work(batch, batch id)`` for every micro-batch, the batch being read once; what it returns
    goes to a folder named by the batch id (overwritten when the batch runs again)."""
    out = f"{base}/output"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            result = work(batch, batch_id)
            if result is not None:
                result.write.mode("overwrite").parquet(f"{out}/batches/__b={batch_id}")
        finally:
            batch.unpersist()

    with stream_settings(spark):
        q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(**(trigger or {"availableNow": True})).start())
    return LookupRun(spark, q, out)


def running_sums(spark: SparkSession, stream: DataFrame, key: str, amount: str, seq: str, out: str = "running_bal",
                 base: str | None = None, limit: int = LIMIT, trigger: dict | None = None) -> LookupRun:
    """Each row with its key's sum of ``amount`` up to and including it, in the order of arrival: the
    bucketed sum of :func:`~rillflow.operators.running.running_sum` inside a micro-batch, on top
    of what the key's earlier batches left. Null amounts add nothing; rows without a key are
    skipped."""
    base = base or scratch_path(spark, "running_sums")
    schema = T.StructType([stream.schema[key], T.StructField("balance", T.DecimalType(38, 2))])
    balances = CompactedTable(spark, f"{base}/balances", schema, key, limit)

    def work(batch: DataFrame, batch_id: int) -> DataFrame:
        batch = batch.filter(F.col(key).isNotNull())
        sums = batch.groupBy(key).agg(F.coalesce(F.sum(money(amount)), F.lit(0)).cast("decimal(38,2)").alias("balance"))
        before = balances.lookup(batch, batch_id - 1).select(F.col(key).alias("__key"), F.col("balance").alias("__before"))
        rows = running_sum(batch, key, amount, seq, out="__here")
        rows = rows.join(before, rows[key] == before["__key"], "left").withColumn(
            out, (F.col("__here") + F.coalesce("__before", F.lit(0))).cast("decimal(28,2)"))
        balances.upsert(batch_id, sums, lambda df: summed([key], ["balance"])(df).withColumn("balance", F.col("balance").cast("decimal(38,2)")))
        return rows.select(*batch.columns, out)

    return each_batch(spark, stream, base, work, trigger)


def looked_up(spark: SparkSession, stream: DataFrame, is_change: Column, key: str, value: str, seq: str, row_key: str,
              base: str | None = None, limit: int = LIMIT) -> LookupRun:
    """Rows of ``stream`` that are no changes with ``value`` from the table that its changes make (``key``,
    ``value``, ``seq``; a null value deletes), as it is after the row's micro-batch; null where
    the table has no such key. A batch reads the buckets of its rows' ``row_key``, any foreign
    key, and rewrites those of its changes."""
    base = base or scratch_path(spark, "looked_up")
    table = lookup_table(spark, base, stream, key, value, seq, limit)

    def work(batch: DataFrame, batch_id: int) -> DataFrame:
        changes = batch.filter(is_change & F.col(key).isNotNull()).select(key, value, seq)
        table.upsert(batch_id, changes, newest([key], [value], seq))
        rows = batch.filter(~is_change & F.col(row_key).isNotNull()).drop(value)
        wanted = rows.select(F.col(row_key).cast(stream.schema[key].dataType).alias(key))
        now = table.lookup(wanted, batch_id).select(F.col(key).alias("__key"), value)
        return rows.join(now, rows[row_key] == now["__key"], "left").drop("__key")

    return each_batch(spark, stream, base, work)


def lookup_table(spark: SparkSession, base: str, stream: DataFrame, key: str, value: str, seq: str, limit: int = LIMIT) -> CompactedTable:
    """The table that :func:`looked_up` keeps at ``base``."""
    return CompactedTable(spark, f"{base}/table", T.StructType([stream.schema[c] for c in (key, value, seq)]), key, limit)


#: Shards of a ranking: the leading bits of the hash of a name.
SHARD_BITS = 4


def ranked(spark: SparkSession, stream: DataFrame, deltas: Callable[[DataFrame], DataFrame], k: int = 3,
           base: str | None = None, limit: int = LIMIT) -> LookupRun:
    """The ``k`` names with the highest counts after every micro-batch: ``batch, rank, name, count``
    (count descending, then name).

    ``deltas`` makes signed ``name, n`` rows of a batch. Counts are a table; so are the rankings of
    each shard of names, ``k`` entries at most. A changed count leaves its shard's ranking and
    enters it again with the new count; where an entry fell, one that was ranked out before may
    come back, and only then the shard's counts are read. The shards' rankings are merged
    above: ``k`` entries of each, however many names there are. A count of 0 leaves.
    """
    base = base or scratch_path(spark, "ranked")
    counts = CompactedTable(spark, f"{base}/counts", T.StructType.fromDDL("name string, count bigint"), "name", limit)
    entry = "array<struct<name:string,count:bigint>>"
    rankings = CompactedTable(spark, f"{base}/rankings", T.StructType.fromDDL(f"shard bigint, top {entry}, batch bigint"), "shard", limit)
    shard = F.shiftrightunsigned(F.xxhash64("name"), 64 - SHARD_BITS)
    by_rank = [F.desc("count"), F.asc("name")]

    def work(batch: DataFrame, batch_id: int) -> DataFrame:
        changed = deltas(batch).filter("name IS NOT NULL").groupBy("name").agg(F.sum("n").cast("long").alias("count"))
        changed = changed.withColumn("shard", shard).persist()
        try:
            before = counts.lookup(changed, batch_id - 1).select(F.col("name").alias("__name"), F.col("count").alias("__old"))
            entering = changed.join(before, changed["name"] == before["__name"], "left").select(
                "shard", "name", (F.col("count") + F.coalesce("__old", F.lit(0))).alias("count")).persist()
            try:
                counts.upsert(batch_id, changed.select("name", "count"), lambda df: summed(["name"], ["count"])(df).filter("count <> 0"))
                ranks = rankings.lookup(changed, batch_id - 1).join(changed.select("shard").distinct(), "shard", "left_semi") \
                    .select("shard", F.explode("top").alias("e")).select("shard", "e.*")
                now = entering.select(F.col("name").alias("__name"), F.col("count").alias("__now"))
                fell = ranks.join(now, ranks["name"] == now["__name"]).filter("__now < count").select("shard").distinct()
                shards = [r.shard for r in fell.collect()]
                below = counts.read(_of_shards(counts.buckets(batch_id), shards)).withColumn("shard", shard) \
                    .filter(F.col("shard").isin(shards)).select("shard", "name", "count")
                staying = ranks.join(now, ranks["name"] == now["__name"], "left_anti")
                cands = staying.unionByName(entering).unionByName(below).distinct().filter("count > 0")
                best = cands.withColumn("rank", F.row_number().over(Window.partitionBy("shard").orderBy(*by_rank))).filter(F.col("rank") <= k)
                top = best.groupBy("shard").agg(F.transform(
                    F.sort_array(F.collect_list(F.struct("rank", "name", "count"))), lambda x: F.struct(x["name"].alias("name"), x["count"].alias("count"))).alias("top"))
                # a shard that lost its last entry is empty from now on
                top = changed.select("shard").distinct().join(top, "shard", "left").select(
                    "shard", F.coalesce("top", F.array().cast(entry)).alias("top"), F.lit(batch_id).cast("long").alias("batch"))
                rankings.upsert(batch_id, top, newest(["shard"], ["top"], "batch"))
            finally:
                entering.unpersist()
        finally:
            changed.unpersist()
        merged = rankings.at(batch_id).select(F.explode("top").alias("e")).select("e.*").orderBy(*by_rank).limit(k)
        return merged.withColumn("rank", F.row_number().over(Window.orderBy(*by_rank)).cast("long")) \
            .select(F.lit(batch_id).cast("long").alias("batch"), "rank", "name", "count")

    return each_batch(spark, stream, base, work)


def _of_shards(buckets: list, shards: list[int]) -> list:
    """The buckets that hold names of the shards: both go by leading bits of the same hash."""
    def overlaps(b) -> bool:
        bits = min(b.depth, SHARD_BITS)
        return any(b.prefix >> b.depth - bits == s >> SHARD_BITS - bits for s in shards)

    return [b for b in buckets if overlaps(b)]


def regrouped_totals(spark: SparkSession, stream: DataFrame, key: str, group: str, value: str, seq: str,
                     adder: dict[str, Callable[[Column], Column]], subtractor: dict[str, Callable[[Column], Column]],
                     types: dict[str, str], base: str | None = None, limit: int = LIMIT) -> tuple[LookupRun, CompactedTable]:
    """A table grouped anew and aggregated by an adder and a subtractor.

    The changelog ``key, group, value, seq`` makes a table of each key's newest row (a null group
    deletes it). When a key's row changes, the subtractor of its old value goes to its old group
    and the adder of its new value to its new one. Both give, for every total by name, what is
    added to it, of the SQL type in ``types``. Groups that no key is in any more stay, with what
    is left of their totals. Returns the run and the table ``group`` -> totals.
    """
    base = base or scratch_path(spark, "regrouped")
    current = CompactedTable(spark, f"{base}/current", T.StructType([stream.schema[c] for c in (key, group, value, seq)]), key, limit)
    names = list(adder)
    schema = T.StructType([stream.schema[group], *T.StructType.fromDDL(", ".join(f"`{n}` {types[n]}" for n in names))])
    totals = CompactedTable(spark, f"{base}/totals", schema, group, limit)

    def shares(rows: DataFrame, side: dict[str, Callable[[Column], Column]] | None) -> DataFrame:
        zero = lambda n: F.lit(0).cast(types[n])
        return rows.filter(F.col(group).isNotNull()).select(group, *[
            (F.coalesce(side[n](F.col(value)).cast(types[n]), zero(n)) if side else zero(n)).alias(n) for n in names])

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy(group).agg(*[F.sum(n).cast(types[n]).alias(n) for n in names])

    def work(batch: DataFrame, batch_id: int) -> None:
        rows = batch.filter(F.col(key).isNotNull()).select(key, group, value, seq)
        last = rows.groupBy(key).agg(F.max_by(F.struct(group, value, seq), seq).alias("__r")).select(key, "__r.*").persist()
        try:
            old = current.lookup(last, batch_id - 1).join(last.select(key), key, "left_semi")
            seen = rows.select(group, value).filter(F.col(group).isNotNull()).dropDuplicates([group])
            change = shares(old, subtractor).unionByName(shares(last, adder)).unionByName(shares(seen, None))
            totals.upsert(batch_id, added(change), added)
            current.upsert(batch_id, last, newest([key], [group, value], seq))
        finally:
            last.unpersist()

    return each_batch(spark, stream, base, work), totals


def folded(spark: SparkSession, stream: DataFrame, key: str | list[str], fold: Fold, base: str | None = None,
           limit: int = LIMIT) -> tuple[LookupRun, CompactedTable]:
    """A user's fold over a stream: each micro-batch's states are merged into the table of states.
    Returns the run and that table; :func:`~rillflow.operators.folds.finish_states` gives results."""
    keys = [key] if isinstance(key, str) else list(key)
    base = base or scratch_path(spark, "folded")
    states = CompactedTable(spark, f"{base}/states", state_schema(stream, keys, fold), keys, limit)

    def work(batch: DataFrame, batch_id: int) -> None:
        states.upsert(batch_id, fold_states(batch, keys, fold), lambda df: merge_states(df, keys, fold))

    return each_batch(spark, stream, base, work), states

