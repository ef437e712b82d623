"""Connected components of links by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Links ``a, b`` (long) -> ``node, root`` for every node but the roots; a component's root
    is its smallest node.

    A step hangs each node's larger neighbours under its smallest one (large-star), then its
    smaller ones (small-star), until all that is left are stars. The number of steps grows
    with the logarithm of the longest path. Each round is written to the shared scratch folder;
    nothing but its row count and a check sum reaches the driver. A node with very many links
    only ever meets their minimum, which is taken before the shuffle, and the join back to
    its links is one that Spark can split.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                   .distinct(), name)
    state = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m"))
        large = both.join(least, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = stored(large, name)
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")) \
            .unionByName(least.select("v", F.col("m").alias("u"))).distinct()
        edges = stored(small, name)
        before, state = state, _digest(edges)
        if state == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    """Row count and an order-free check sum."""
    h = F.xxhash64("v", "u")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())
