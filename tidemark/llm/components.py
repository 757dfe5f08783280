"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of an edge; component is the smallest node that can be reached.

    edges: columns src, dst (long). Self-loops and repeated edges are allowed, nulls are ignored.
    A node's smallest neighbour comes from a map-side combined min and is joined back, so no neighbour list is ever
    gathered: a node with very many edges is a skewed join side, which adaptive execution splits.
    Each round is checkpointed; the loop ends when a round changes nothing.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    pairs = edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    )
    pairs = pairs.distinct().checkpoint()
    seen = None
    while (now := _state(pairs)) != seen:
        seen = now
        if not now[0]:
            break
        # large star: every larger neighbour of u goes to the smallest node around u
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
        large = both.join(low, both.u == low.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low, large.u == low.k)
        pairs = (
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
            .distinct().checkpoint()
        )
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(pairs: DataFrame) -> tuple:
    r = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return r[0], r[1]
