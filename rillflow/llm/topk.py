"""Exact top-k search by integer inner product, block at a time.

Vectors are stored in blocks of rows in the order of the table, each a forward index (ids and
a matrix) with the largest and smallest value of every dimension. For a query the sum over its
dimensions of the larger of (its value times the block's maximum, its value times the minimum)
bounds every score in the block. A query takes the blocks in the order of their bounds and stops
when a bound is below its k-th score so far; at an equal bound a block is skipped if its ids
are all larger than the k-th one's. So the result is exact.

Blocks are dealt into shards and queries into groups; one task has one shard and one group,
both of bounded size, and gives back at most k rows a query. Nothing is broadcast.

Rows: vectors that are null or have a null or non-finite component, and rows without an id,
take no part; a repeated row is a row of its own, so a query can find its repeats, with its own
id; shorter vectors count as filled up with zeros; an empty table gives an empty result; scores
beyond the range of a long are cut to it. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import stored

BLOCK_ROWS = 512
SHARD_BLOCKS = 32
GROUP_QUERIES = 4096
EXACT = 2.0 ** 53


def _blocks(vectors: DataFrame, vec_id: str, embedding: str, scale: int, size: int) -> DataFrame:
    """``n, dims, ids, matrix, low, high`` per block, arrays as bytes (ids int64, else float64:
    the floor of a double is one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            keep = pc.and_(ids.is_valid(), lists.is_valid())
            ids, lists = ids.filter(keep), lists.filter(keep)
            if not len(ids):
                continue
            flat = lists.flatten()
            lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lens)), lens)
            good = np.ones(len(lens), bool)
            good[row[~np.isfinite(values)]] = False
            dims = int(lens.max()) if len(lens) else 0
            m = np.zeros((len(lens), dims))
            m[row, np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)] = values
            ids = ids.to_numpy(zero_copy_only=False)[good]
            m = np.floor(scale * m[good])
            order = np.argsort(ids, kind="stable")
            ids, m = ids[order], m[order]
            for a in range(0, len(ids), size):
                part = m[a:a + size]
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(part)], pa.int32()), pa.array([dims], pa.int32()),
                    pa.array([ids[a:a + size].astype(np.int64).tobytes()], pa.binary()),
                    pa.array([part.tobytes()], pa.binary()), pa.array([part.min(axis=0).tobytes()], pa.binary()),
                    pa.array([part.max(axis=0).tobytes()], pa.binary())],
                    names=["n", "dims", "ids", "matrix", "low", "high"])

    cols = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = cols.mapInArrow(run, "n int, dims int, ids binary, matrix binary, low binary, high binary")
    return stored(rows.withColumn("block", F.monotonically_increasing_id()), "topk_blocks")


def _matrix(rows: pd.DataFrame, column: str, dims: int) -> np.ndarray:
    """The rows' matrices one below the other, filled up to ``dims`` columns."""
    out = [np.zeros((0, dims))]
    for data, d in zip(rows[column], rows["dims"]):
        m = np.frombuffer(data).reshape(-1, d) if d else np.zeros((0, 0))
        out.append(np.pad(m, ((0, 0), (0, dims - d))))
    return np.concatenate(out)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, of whole numbers, exactly: by Python's numbers where doubles
    might round. Cut to the range of a long."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    return np.clip(whole(a).dot(whole(b).T), -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def search(queries: np.ndarray, own: np.ndarray, blocks: list[tuple], k: int, size: int):
    """The k best (score, id) of each query over the blocks (number, ids, matrix, low, high),
    without the row whose place ``own`` names; places are block number times the block's most
    rows, plus the row. Missing ones have found = False."""
    nq, nb = len(queries), len(blocks)
    best = np.full((nq, k), np.iinfo(np.int64).min)
    ids = np.full((nq, k), np.iinfo(np.int64).max)
    found = np.zeros((nq, k), bool)
    if not nb or not nq:
        return best, ids, found
    low, high = np.stack([b[3] for b in blocks]), np.stack([b[4] for b in blocks])
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = product(np.hstack([plus, minus]), np.hstack([high, low]))
    order = np.argsort(-bound, axis=1, kind="stable")
    first_id = np.array([b[1].min() for b in blocks])
    going = np.ones(nq, bool)
    everyone = np.arange(nq)
    for r in range(nb):
        at = order[:, r]
        limit = bound[everyone, at]
        full = found[:, -1]
        going &= ~full | (limit >= best[:, -1])
        wants = going & (~full | (limit > best[:, -1]) | (first_id[at] <= ids[:, -1]))
        if not going.any():
            break
        for b in np.unique(at[wants]):
            number, b_ids, matrix, _, _ = blocks[b]
            q = np.flatnonzero(wants & (at == b))
            score = product(queries[q], matrix)
            place = own[q] - number * size
            mine = (place >= 0) & (place < len(b_ids))
            ok = np.ones(score.shape, bool)
            ok[np.flatnonzero(mine), place[mine]] = False
            better = ((score >= best[q, -1:]) & ok).any(axis=1)  # unfilled places hold the least long
            q, score, ok = q[better], score[better], ok[better]
            if not len(q):
                continue
            # the ids ascend, so a stable sort leaves ties to the smaller
            top = np.lexsort((np.where(ok, -score.astype(float), np.inf),), axis=1) if abs(score).max(initial=0) < EXACT \
                else np.lexsort((~score, ~ok), axis=1)
            top = top[:, :k]
            rows = np.arange(len(q))[:, None]
            s = np.hstack([best[q], score[rows, top]])
            i = np.hstack([ids[q], b_ids[top]])
            f = np.hstack([found[q], ok[rows, top]])
            keep = np.lexsort((i, ~s, ~f), axis=1)[:, :k]
            best[q], ids[q], found[q] = s[rows, keep], i[rows, keep], f[rows, keep]
    return best, ids, found


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id",
          embedding: str = "embedding", block_rows: int = BLOCK_ROWS, shard_blocks: int = SHARD_BLOCKS,
          group_queries: int = GROUP_QUERIES) -> DataFrame:
    """The ``k`` best scores of each query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column ``vec_id``. Components become
    floor(scale * x); candidates are all rows but the query's own; ties go to the smaller id.
    """
    blocks = _blocks(vectors, vec_id, embedding, scale, block_rows)
    flat = blocks.select("block", F.col("n"), "dims", "ids", "matrix")

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples():
                ids = np.frombuffer(r.ids, np.int64)
                yield pd.DataFrame({"block": r.block, "place": np.arange(len(ids)), "vec_id": ids, "dims": r.dims,
                                    "vector": [x.tobytes() for x in np.frombuffer(r.matrix).reshape(len(ids), r.dims)]})

    chosen = flat.mapInPandas(pick, "block bigint, place bigint, vec_id bigint, dims int, vector binary")
    chosen = chosen.filter(is_query).select((F.col("block") * block_rows + F.col("place")).alias("own"),
                                            F.col("vec_id").alias("query_id"), "dims", "vector")
    chosen = stored(chosen, "topk_queries")
    shards = max(1, -(-blocks.count() // shard_blocks))
    groups = max(1, -(-chosen.count() // group_queries))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    to = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    none = F.lit(None)
    left = blocks.select(to("block", shards).alias("shard"), every(groups).alias("grp"), F.col("block").alias("number"),
                         none.cast("long").alias("query_id"), "dims", "ids", "matrix", "low", "high")
    right = chosen.select(every(shards).alias("shard"), to("own", groups).alias("grp"), F.col("own").alias("number"),
                          "query_id", "dims", none.cast("binary").alias("ids"), F.col("vector").alias("matrix"),
                          none.cast("binary").alias("low"), none.cast("binary").alias("high"))

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["query_id"].notna()
        q, b = rows[asked], rows[~asked]
        dims = int(rows["dims"].max())
        pad = lambda data: np.pad(np.frombuffer(data), (0, dims - len(data) // 8))
        held = [(int(r.number), np.frombuffer(r.ids, np.int64),
                 np.pad(np.frombuffer(r.matrix).reshape(-1, r.dims), ((0, 0), (0, dims - r.dims)))
                 if r.dims else np.zeros((len(r.ids) // 8, dims)), pad(r.low), pad(r.high)) for r in b.itertuples()]
        asked_by = np.stack([pad(x) for x in q["matrix"]]) if len(q) else np.zeros((0, dims))
        own = q["number"].to_numpy(np.int64)
        best, ids, found = search(asked_by, own, held, k, block_rows)
        at, nth = np.nonzero(found)
        return pd.DataFrame({"own": own[at], "query_id": q["query_id"].to_numpy(np.int64)[at],
                             "vec_id": ids[at, nth], "score": best[at, nth]})

    found = left.unionByName(right).groupBy("shard", "grp").applyInPandas(
        cell, "own bigint, query_id bigint, vec_id bigint, score bigint")
    best_first = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_topk(spark, sf_dir: str) -> DataFrame:
    """The 5 best rows for every vector whose id is divisible by 50."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.own, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.own <> c.own),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
