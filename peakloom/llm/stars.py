"""Connected components by alternating large-star and small-star.

A large-star step links every larger neighbour of a node to the smallest node around it, a small-star step
links the smaller neighbours. Both need the minimum of a neighbourhood only, which is combined before the
shuffle, so a node with a third of all edges is no heavier than others. Each round is written under the
checkpoint folder; rounds end when count and hash sums of the edges stay the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from peakloom.session import Scratch


def _large(edges: DataFrame) -> DataFrame:
    around = edges.select(F.col("low").alias("node"), F.col("high").alias("other")).unionAll(
        edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    )
    least = around.groupBy("node").agg(F.min("other").alias("other_least"))
    least = least.select("node", F.least("node", "other_least").alias("least"))
    linked = around.join(least, "node").where(F.col("other") > F.col("node"))
    return linked.select(F.col("least").alias("low"), F.col("other").alias("high"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").where(F.col("low") != F.col("least"))
    moved = moved.select(F.col("least").alias("low"), F.col("low").alias("high"))
    return moved.unionAll(least.select(F.col("least").alias("low"), "high")).distinct()


def _write(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, tuple]:
    seen = Observation()
    total = [F.sum(F.xxhash64("low", "high", F.lit(i)).cast("decimal(38,0)")).alias(f"sum{i}") for i in (1, 2)]
    saved = scratch.save(edges.observe(seen, F.count(F.lit(1)).alias("n"), *total), "star")
    return saved, tuple(sorted(seen.get.items()))


def components(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of all nodes in ``pairs`` (left, right); the root is the smallest node reachable."""
    edges = pairs.select(F.least("left", "right").alias("low"), F.greatest("left", "right").alias("high"))
    edges, before = _write(_small(edges.where(F.col("low") < F.col("high"))), scratch)
    while True:
        after, now = _write(_small(_large(edges)), scratch)
        scratch.drop(edges)
        edges = after
        if now == before:
            break
        before = now
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionAll(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
