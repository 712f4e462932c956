"""Merging one clustering result into the cluster tables.

A row of a clustering result (see ``operators.cluster``) is routed by what it stands for:
``consensus`` rows are representatives or samples of known clusters and carry ``ref_cluster``,
other rows are members of a temporary cluster or noise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.operators.ids import allocate, dense_index
from peakloom.session import Scratch

KNOWN_SOURCES = ("consensus", "sample")
NOISE = -1


@dataclass(frozen=True)
class Merge:
    """Outcome of a merge: rows to append to the scan list, left-over rows, the id map,
    representatives under their lasting ids, and pairs of known clusters that met."""

    members: DataFrame
    singletons: DataFrame
    id_map: DataFrame
    representatives: DataFrame | None
    merge_candidates: DataFrame


def route(temp_cluster: Column, known: Column) -> Column:
    """First match wins, so a noise row of a known cluster still counts as ``consensus``."""
    return F.when(known, "consensus").when(temp_cluster != NOISE, "member").otherwise("noise")


def routed(rows: DataFrame) -> DataFrame:
    known = F.coalesce(F.col("source").isin(*KNOWN_SOURCES), F.lit(False))
    return rows.withColumn("route", route(F.col("temp_cluster"), known))


def known_map(rows: DataFrame) -> DataFrame:
    """(temp_cluster, cluster_id): the smallest known cluster seen in each temporary cluster.

    Rows whose cluster id was unreadable, and noise, map nothing.
    """
    return (
        rows.where((F.col("route") == "consensus") & (F.col("temp_cluster") != NOISE))
        .where(F.col("ref_cluster").isNotNull())
        .groupBy("temp_cluster")
        .agg(F.min("ref_cluster").alias("cluster_id"))
    )


def met_clusters(rows: DataFrame) -> DataFrame:
    """(kept_id, other_id): known clusters that fell into one temporary cluster.

    They are not merged; new members go to the smaller id.
    """
    seen = rows.where((F.col("route") == "consensus") & (F.col("temp_cluster") != NOISE)).where(
        F.col("ref_cluster").isNotNull()
    )
    return (
        seen.select("temp_cluster", F.col("ref_cluster").alias("other_id"))
        .distinct()
        .join(known_map(rows).withColumnRenamed("cluster_id", "kept_id"), "temp_cluster")
        .where("other_id <> kept_id")
        .select("kept_id", "other_id")
        .distinct()
    )


def id_map(rows: DataFrame, base: int, scratch: Scratch) -> DataFrame:
    """(temp_cluster, cluster_id, is_new): known ids, then base + rank for the others."""
    known = known_map(rows)
    fresh = (
        rows.where(F.col("route") == "member")
        .select("temp_cluster")
        .distinct()
        .join(known.select("temp_cluster"), "temp_cluster", "left_anti")
    )
    new = allocate(fresh, "temp_cluster", base, scratch)
    return known.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))


def check_known(mapping: DataFrame, clusters: DataFrame) -> None:
    """Fail when a row refers to a cluster that the tables do not hold."""
    stray = (
        mapping.where("not is_new").join(clusters.select("cluster_id").distinct(), "cluster_id", "left_anti")
    )
    missing = [r["cluster_id"] for r in stray.select("cluster_id").take(5)]
    if missing:
        raise ValueError(f"clustering result refers to unknown clusters, such as {missing}")


def initial_clusters(
    rows: DataFrame, scratch: Scratch, shift: int = 1, singletons_as_clusters: bool = False
) -> Merge:
    """First batch: cluster id = temporary id + shift; noise rows are kept apart as singletons.

    With ``singletons_as_clusters`` each noise row becomes a cluster of one, numbered after the
    largest id in (path, scan) order.
    """
    rows = routed(rows)
    members = rows.where(F.col("route") == "member").withColumn("cluster_id", F.col("temp_cluster") + shift)
    singles = rows.where(F.col("route") == "noise")
    mapping = (
        members.select("temp_cluster", "cluster_id").distinct().withColumn("is_new", F.lit(True))
    )
    if singletons_as_clusters:
        members, singles = _singles_to_clusters(members, singles, 0, scratch)
    return Merge(members, singles, mapping, None, met_clusters(rows))


def merge_clusters(
    rows: DataFrame,
    base: int,
    scratch: Scratch,
    representatives: DataFrame | None = None,
    clusters: DataFrame | None = None,
    singletons_as_clusters: bool = False,
) -> Merge:
    """Later batch: ``base`` is the largest cluster id on entry.

    ``representatives`` (by temp_cluster) come back under lasting ids; those of noise or of
    unmapped clusters are left out. Samples may lie apart from their representative, so that two
    temporary clusters stand for one known; the first of them gives its representative.
    ``clusters`` is the table to check known ids against.
    """
    rows = routed(rows)
    mapping = scratch.save(id_map(rows, base, scratch), "id-map")
    if clusters is not None:
        check_known(mapping, clusters)
    ids = mapping.select("temp_cluster", "cluster_id")
    members = rows.where(F.col("route") == "member").join(ids, "temp_cluster")
    singles = rows.where(F.col("route") == "noise")
    lasting = None
    if representatives is not None:
        firsts = ids.groupBy("cluster_id").agg(F.min("temp_cluster").alias("temp_cluster"))
        lasting = representatives.where(F.col("temp_cluster") != NOISE).join(firsts, "temp_cluster").drop("temp_cluster")
    if singletons_as_clusters:
        members, singles = _singles_to_clusters(members, singles, base, scratch)
    return Merge(members, singles, mapping, lasting, met_clusters(rows))


def _singles_to_clusters(
    members: DataFrame, singles: DataFrame, base: int, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    top = members.agg(F.coalesce(F.max("cluster_id"), F.lit(base)).alias("m")).first()["m"]
    numbered = dense_index(singles, [F.col("path"), F.col("scan")], "cluster_id", scratch, max(top, base))
    return members.unionByName(numbered.select(*members.columns)), singles.limit(0)


def overwrite(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key ``new`` lacks. ``new`` is unique by key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def append_distinct(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``old`` plus the rows of ``new`` with keys not yet there; the first by ``order`` wins."""
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    fresh = first.select(*keys, "_row.*").join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def with_map(rows: DataFrame, maps: DataFrame) -> DataFrame:
    """Resolve short map keys to full paths; rows whose key is unknown drop out."""
    return rows.join(maps, "path_key")


def union_maps(*maps: DataFrame) -> DataFrame:
    """Union of path maps, one row per key."""
    both = maps[0]
    for other in maps[1:]:
        both = both.unionByName(other)
    return both.groupBy("path_key").agg(F.min("full_path").alias("full_path"))
