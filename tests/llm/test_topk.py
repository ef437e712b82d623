"""Exact top-k against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import topk as K

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(np.float32(x))) for x in v]

    ok = [(d, whole(v)) for d, v, *_ in rows if d is not None and whole(v) is not None]
    out = []
    for i, (q, a) in enumerate(ok):
        if q % every == 0:
            best = sorted((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), d)
                          for j, (d, b) in enumerate(ok) if j != i)[:k]
            out += [(q, r + 1, d, -s) for r, (s, d) in enumerate(best)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit(1)).withColumn("score", F.lit("x"))
    return got(K.top_k(df.repartition(3), F.col("vec_id") % 50 == 0, **kw))


def vectors(seed, n, dims=8, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(dims)], 0) for i in range(n)]


@pytest.mark.parametrize("rows,shard,group", [(512, 32, 4096), (16, 2, 3)])
def test_equals_brute_force(spark, rows, shard, group):
    data = vectors(1, 400) + [(1000 + i, [0.5] * 8, 0) for i in range(120)]  # many ties
    data += [(50, [0.1] * 8, 0), (50, [0.1] * 8, 0), (-100, [-1.0] * 8, 0)]  # repeated rows, negative id
    data += [(2000, None, 0), (2050, [1.0, None], 0), (2100, [float("nan")] * 8, 0), (2150, [float("inf")] * 8, 0),
             (None, [9.0] * 8, 0), (2200, [3.0], 0), (2250, [], 0)]
    assert run(spark, data, block_rows=rows, shard_blocks=shard, group_queries=group) == brute(data)


def test_few_rows_and_empty_table(spark):
    assert run(spark, [(0, [1.0, 2.0], 0)]) == []
    data = [(0, [1.0], 0), (1, [2.0], 0), (50, [3.0], 0)]
    assert run(spark, data) == brute(data)
    df = spark.createDataFrame([], SCHEMA)
    assert got(K.top_k(df, F.col("vec_id") % 50 == 0)) == []


def test_large_components_stay_exact(spark):
    data = [(0, [1e7, 1.0], 0), (1, [1e7, 2.0], 0), (2, [1e7, 3.0], 0), (3, [-1e17, 1.0], 0), (50, [1e17, 1.0], 0)]
    assert run(spark, data) == brute(data)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(K.op2_topk(spark, sf)) == brute(data)


def test_blocks_are_skipped():
    r = np.random.default_rng(0)
    blocks = []
    for n in range(40):  # each block near a direction of its own
        m = np.floor(r.normal(0, 3, (64, 16)) + 200 * np.eye(16)[n % 16] * (1 + n // 16))
        blocks.append((n, np.arange(64) + 64 * n, m, m.min(axis=0), m.max(axis=0)))
    seen = []
    real, K_product = K.product, lambda a, b: (seen.append(len(b)), real(a, b))[1]
    K.product = K_product
    try:
        q = np.floor(256 * np.eye(16)[:4])
        best, ids, found = K.search(q, np.full(4, -1), blocks, 5, 64)
    finally:
        K.product = real
    everything = np.concatenate([b[2] for b in blocks])
    for i in range(4):
        want = sorted(zip((-(q[i] @ everything.T)).tolist(), range(len(everything))))[:5]
        assert [(-s, d) for s, d in zip(best[i].tolist(), ids[i].tolist())] == [(s, d) for s, d in want]
    assert len(seen) - 1 < 4 * 40 / 4  # far fewer than all blocks were scored
