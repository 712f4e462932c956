"""Connected components by alternating star steps (Kiveris et al., 2014).

Each round is two aggregate-and-join passes over the edge table. No node's neighbours are ever
gathered: only their minimum is, which combines before the shuffle, so a node with a third of
all edges costs no more than others. Every round is written, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from peakloom.session import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each strictly larger neighbour to the smallest node of the neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(smallest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect the smaller neighbours, and the node itself, to the smallest of them."""
    down = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(smallest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(smallest.select("u", F.col("m").alias("v"))).distinct()


def _save(edges: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, tuple]:
    """Write an edge table; its row count and hash sum are observed on the way, without a job."""
    seen = Observation()
    hashes = [F.sum(F.xxhash64(*pair).cast("decimal(38,0)")) for pair in (("u", "v"), ("v", "u"))]
    watched = edges.observe(seen, F.count("*").alias("n"), hashes[0].alias("a"), hashes[1].alias("b"))
    table = scratch.save(watched, name)
    return table, tuple(sorted(seen.get.items()))


def components(edges: DataFrame, scratch: Scratch, left: str = "u", right: str = "v") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node reachable."""
    first = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where(
        F.col("u") != F.col("v")
    )
    stars, seen = _save(_small_star(first), scratch, "stars")
    while True:
        moved, now = _save(_small_star(_large_star(stars)), scratch, "stars")
        scratch.drop(stars)
        stars = moved
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
