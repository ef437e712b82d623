"""Near duplicates by SimHash fingerprints, linked exactly through vantage-point trees.

Equal fingerprints are one point, so a group of copies costs one. A vantage-point tree, fitted
on a bounded sample of points, sends each point to a leaf by its distance to a vantage point
at every node: below the node's radius to the left, else to the right. Points within reach of
the boundary also visit the other side, by the triangle inequality, so that every pair within
``reach`` bits meets in the leaf of its first point. A leaf with more points than a task should
compare is dealt into blocks, each pair of blocks being compared in a task of its own: there
is no limit on a leaf. Inside a task the distances to one more vantage point prune again.

A task gives back the forest of its links, at most a row for each of its points, however many
pairs there are; the components of all forests are those of all links.

Rows: a null or empty text, or one of white space, has fingerprint 0, linked like any other; a
null ``doc_id`` takes part, but names a component only if none of its documents has an id
(then the component's id is null); repeated rows are repeated in the result; an empty table
gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.arrowtext import joined, mixed, slices, split_words
from rillflow.llm.common import set_aside, stored
from rillflow.llm.components import components

#: Points that the tree is fitted on, at most; all points are sent through it.
SAMPLE = 20_000
#: Points for which a leaf is meant, and levels of the tree at most.
LEAF = 4_096
DEPTH = 14
#: Points on either side of a comparison in one task.
BLOCK = 16_384


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """64-bit fingerprints as unsigned numbers."""
    import xxhash

    w = split_words(texts, lower=True)
    buf, at = joined(w)
    n = np.diff(w.first)
    # a text with fewer words than a shingle is one shingle; one without words has none
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    of_text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(of_text)) - np.repeat(np.cumsum(count) - count, count)
    begin = w.first[:-1][of_text] + nth
    last = np.minimum(begin + shingle, w.first[1:][of_text])
    data, digest = buf.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(data[a:b], 42) for a, b in zip(at[begin].tolist(), (at[last] - 1).tolist())),
                    np.uint64, len(begin))
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        heads = (np.cumsum(count) - count)[some]
        for bit in range(64):
            ones = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), heads)
            out[some] |= (2 * ones > count[some]).astype(np.uint64) << np.uint64(bit)
    return out


def with_fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs`` without ``text`` and with ``fp``, the fingerprint's bits as a long."""
    kept = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = fingerprints_of(part.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(fp)], names=[*kept, "fp"])

    return docs.mapInArrow(run, schema)


def distance(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def fit_tree(sample: np.ndarray, points: int, reach: int) -> list[tuple[np.uint64, int]]:
    """Vantage point and radius of each node of a complete tree, the root first and node i's
    children at 2 i + 1 and 2 i + 2. Of several vantage points and radii that part the node's
    sample about evenly it takes the one with the fewest points near the boundary; a node
    with hardly any sample gets a made-up vantage point and the radius that parts random
    fingerprints evenly."""
    depth = min(DEPTH, max(0, math.ceil(math.log2(max(points, 1) / LEAF))))
    nodes: list[tuple[np.uint64, int]] = []
    parts = {0: sample}
    for i in range(2 ** depth - 1):
        own = parts.pop(i, sample[:0])
        best = (2.0, mixed(np.array([i], np.uint64))[0], 32)
        if len(own) >= 16:
            for v in own[np.linspace(0, len(own) - 1, 8).astype(int)]:
                d = distance(own, v)
                for m in range(1, 65):
                    left = np.mean(d < m)
                    if 0.3 <= left <= 0.7:
                        near = np.mean((d >= m - reach) & (d < m + reach))
                        best = min(best, (near + abs(left - 0.5) / 2, v, m), key=lambda x: x[0])
        nodes.append((best[1], best[2]))
        d = distance(own, best[1])
        parts[2 * i + 1], parts[2 * i + 2] = own[d < best[2]], own[d >= best[2]]
    return nodes


def send(points: np.ndarray, nodes: list, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, places in ``points``, whether each is at home there). Two points within ``reach``
    meet in the home of one of them."""
    todo = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        i, at, home = todo.pop()
        if not len(at):
            continue
        if i >= len(nodes):
            yield i - len(nodes), at, home
            continue
        v, m = nodes[i]
        d = distance(points[at], v).astype(np.int16)
        # a point whose home is on the right looks for partners on the left; one at home on the
        # left is found by them. A visitor looks wherever a partner may be.
        left = np.where(home, d < m, False)
        visits = np.where(home, (d >= m) & (d < m + reach), d < m + reach)
        todo.append((2 * i + 1, at[left | visits], left[left | visits]))
        right = np.where(home, d >= m, d >= m - reach)
        todo.append((2 * i + 2, at[right], home[right]))


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[i] and b[i]; ``root`` leads each place to a smaller or equal one, and
    is flat before and after."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def forest(index: np.ndarray, queries: np.ndarray, reach: int, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, root) that join the same points as all links of a query and an indexed
    point within ``reach``. Only indexed points whose distance to a vantage point differs by
    at most ``reach`` from the query's are compared, ``most`` pairs at a time."""
    points = np.unique(np.concatenate([index, queries]))
    root = np.arange(len(points))
    if len(index):
        v = index[len(index) // 2]
        index = index[np.argsort(distance(index, v), kind="stable")]
        d_index, d_query = distance(index, v).astype(np.int64), distance(queries, v)
        place = np.searchsorted(points, index)
        for t in np.unique(d_query).astype(np.int64):
            lo, hi = np.searchsorted(d_index, t - reach), np.searchsorted(d_index, t + reach, side="right")
            own = queries[d_query == t]
            step = max(1, most // max(1, hi - lo))
            for k in range(0, len(own) if hi > lo else 0, step):
                some = own[k:k + step]
                q, x = np.nonzero(distance(some[:, None], index[None, lo:hi]) <= reach)
                if len(q):
                    merge(root, np.searchsorted(points, some)[q], place[lo:hi][x])
    linked = np.flatnonzero(root != np.arange(len(points)))
    return points[linked], points[root[linked]]


def links(points: DataFrame, reach: int) -> DataFrame:
    """Distinct ``fp`` -> links ``a, b`` that join what pairs within ``reach`` bits join."""
    n = points.count()
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    nodes = fit_tree(np.array([r.fp for r in sample], np.int64).view(np.uint64), n, reach)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for leaf, at, home in send(fp.view(np.uint64), nodes, reach):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), leaf, np.int32)), pa.array(fp[at]),
                                                  pa.array(home)], names=["leaf", "fp", "home"])

    sent = stored(points.select("fp").mapInArrow(route, "leaf int, fp bigint, home boolean"), "simhash_leaves")
    # a leaf's points in blocks: at most 2^DEPTH rows, so the table may be broadcast
    size = sent.groupBy("leaf").agg(F.ceil(F.count_if("home") / BLOCK).cast("int").alias("homes"),
                                    F.ceil(F.count("*") / BLOCK).cast("int").alias("all"))
    block = lambda n: F.pmod(F.xxhash64("fp"), n).cast("int")
    one = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("home").alias("index"), F.lit(True).alias("query"))
    as_query = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda x: F.struct(
        x.alias("x"), block(F.col("all")).alias("y"), F.lit(False).alias("index"), F.lit(True).alias("query")))
    as_index = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda y: F.struct(
        block(F.col("homes")).alias("x"), y.alias("y"), F.lit(True).alias("index"), F.lit(False).alias("query")))
    cells = F.when(F.col("all") == 1, F.array(one)).when(F.col("home"), F.concat(as_query, as_index)).otherwise(as_query)
    dealt = sent.join(F.broadcast(size), "leaf").filter("homes > 0").select("leaf", "fp", F.explode(cells).alias("c"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        fp = part["fp"].to_numpy().view(np.uint64)
        a, b = forest(fp[part["index"].to_numpy()], fp[part["query"].to_numpy()], reach)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.select("leaf", "fp", "c.*").groupBy("leaf", "x", "y").applyInPandas(compare, "a bigint, b bigint")


def rooted(fps: DataFrame, reach: int) -> DataFrame:
    """Each distinct ``fp`` once, with ``least`` (its smallest doc_id) and the ``root`` of its component."""
    points = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_points")
    roots = components(links(points, reach), "simhash_components")
    return stored(points.join(roots, points.fp == roots.node, "left")
                  .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash_rooted")


def near_duplicates(docs: DataFrame, shingle: int = 3, reach: int = 2) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, fingerprint, component_id (its smallest doc_id)."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fps = stored(with_fingerprints(given, shingle), "simhash_fingerprints")
    points = rooted(fps, reach)
    names = points.groupBy("root").agg(F.min("least").alias("component_id"))
    named = points.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def simhash_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays; columns as given.

    That is the one with the smallest (``doc_id``, null last; hash of the text; fingerprint; hash
    of all columns), so which one stays does not depend on how the rows are dealt. Rows that
    are equal throughout are one. Ids choose among a component's documents and nothing else:
    documents with one id and unrelated texts are documents of their own.
    """
    given, names = set_aside(docs, ("doc_id", "text"))
    hashable = [f.name for f in given.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    marked = given.withColumns({"of_text": F.xxhash64("text"), "of_row": F.xxhash64(F.lit(1), *hashable)})
    fps = stored(with_fingerprints(marked.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "of_text", "of_row"), 3),
                 "simhash_fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "of_text", "fp", "of_row")
    first = fps.join(rooted(fps, 2).select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("one"))
    kept = first.select("one.of_text", "one.of_row")
    return marked.join(kept, ["of_text", "of_row"], "left_semi").dropDuplicates(["of_text", "of_row"]).select(*names).toDF(*docs.columns)
