"""Member samples of large clusters, and which spectra the next batch will need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_SIZE = 5


def draw_order(seed: str, *parts: str) -> Column:
    """A fixed shuffle: rows sort by the MD5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(p).cast("string") for p in parts]))


def top_per_group(rows: DataFrame, group: str, order: list[Column], size: int, name: str) -> DataFrame:
    """First ``size`` rows per group, numbered from 1.

    Spark applies the limit per input partition before the shuffle, so a group with a third of all
    rows sends at most ``size`` rows per task.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(window)).where(F.col(name) <= size)


def large_clusters(scan_list: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    return scan_list.groupBy("cluster_id").agg(F.count("*").alias("n")).where(F.col("n") > size).select("cluster_id")


def draw_samples(
    scan_list: DataFrame, sampled: DataFrame | None = None, size: int = SAMPLE_SIZE, seed: str = "0"
) -> DataFrame:
    """Samples for clusters above ``size`` members that have none yet; ``sample_no`` from 1.

    Samples are drawn once: clusters in ``sampled`` are left alone.
    """
    due = large_clusters(scan_list, size)
    if sampled is not None:
        due = due.join(sampled.select("cluster_id").distinct(), "cluster_id", "left_anti")
    rows = scan_list.join(due, "cluster_id", "left_semi")
    order = [draw_order(seed, "path", "scan"), F.col("path"), F.col("scan")]
    return top_per_group(rows, "cluster_id", order, size, "sample_no")


def samples_of_clusters(samples: DataFrame, scan_list: DataFrame) -> DataFrame:
    """Sample rows whose cluster is in the scan list."""
    return samples.join(scan_list.select("cluster_id").distinct(), "cluster_id", "left_semi")


def scans_to_keep(
    scan_list: DataFrame, samples: DataFrame, singletons: DataFrame, batch_id: int, size: int = SAMPLE_SIZE
) -> DataFrame:
    """Distinct (path, scan) of the current batch that a later batch may read again.

    Samples of large clusters, all members of small ones (they may grow), and all singletons.
    """
    big = large_clusters(scan_list, size)
    current = F.col("batch_id") == batch_id
    sampled = samples.where(current).join(big, "cluster_id", "left_semi")
    small = scan_list.where(current).join(big, "cluster_id", "left_anti")
    return (
        sampled.select("path", "scan")
        .unionAll(small.select("path", "scan"))
        .unionAll(singletons.where(current).select("path", "scan"))
        .distinct()
    )


def renumbered_pool(scan_list: DataFrame, size: int = 10, seed: str = "0") -> DataFrame:
    """Older export rule: from ``size`` members on, ``size`` samples numbered from 1 and the
    representative last; below that the representative alone, under the plain cluster id.

    Gives (cluster_id, out_id, kind, path, scan); path and scan are null for representatives.
    """
    counts = scan_list.groupBy("cluster_id").agg(F.count("*").alias("n"))
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    full = counts.where(F.col("n") >= size)
    picked = top_per_group(
        scan_list.join(full.select("cluster_id"), "cluster_id", "left_semi"),
        "cluster_id",
        [draw_order(seed, "path", "scan"), F.col("path"), F.col("scan")],
        size,
        "_no",
    )
    text = F.col("cluster_id").cast("string")
    return (
        picked.select(
            "cluster_id", F.concat_ws("_", text, F.col("_no").cast("string")).alias("out_id"),
            F.lit("sample").alias("kind"), "path", "scan",
        )
        .unionByName(
            counts.select(
                "cluster_id",
                F.when(F.col("n") >= size, F.concat_ws("_", text, F.lit(str(size + 1)))).otherwise(text).alias("out_id"),
                F.lit("representative").alias("kind"),
                none_s.alias("path"),
                none_l.alias("scan"),
            )
        )
    )


def size_policy(scan_list: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """Older export rule by size: a lone member is exported raw, up to ``size`` members give the
    representative, more give the representative and fresh samples."""
    n = F.col("members")
    return scan_list.groupBy("cluster_id").agg(F.count("*").alias("members")).withColumn(
        "export",
        F.when(n == 1, "raw").when(n <= size, "representative").otherwise("representative+samples"),
    )
