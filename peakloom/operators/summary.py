"""Result tables: one row per scan and one row per cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.functions.text import basename

# Fixed column titles of the published result tables.
INFO_TITLES = {
    "cluster": "cluster",
    "filename": "filename",
    "scan": "scan",
    "precursor_mz": "precursor_mz",
    "retention_time": "retention_time",
    "new_batch": "new_batch",
}
SUMMARY_TITLES = {
    "cluster_index": "cluster index",
    "n_spectra": "number of spectra",
    "parent_mass": "parent mass",
    "precursor_charge": "precursor charge",
    "precursor_mass": "precursor mass",
    "sum_precursor_intensity": "sum(precursor intensity)",
    "rt_mean": "RTMean",
}


def yes_no(test: Column) -> Column:
    return F.when(test, "yes").otherwise("no")


def cluster_info(scan_list: DataFrame, batch_id: int | None = None, batch_files: DataFrame | None = None) -> DataFrame:
    """Per-scan table. ``new_batch`` goes by batch id; given ``batch_files`` (column
    ``filename``), by base name instead, as older results did."""
    name = basename(F.col("path"))
    if batch_files is None:
        flagged = scan_list.withColumn("new_batch", yes_no(F.col("batch_id") == F.lit(batch_id)))
    else:
        names = batch_files.select(F.col("filename").alias("_file")).distinct().withColumn("_new", F.lit(True))
        flagged = scan_list.join(names, name == F.col("_file"), "left").withColumn(
            "new_batch", yes_no(F.coalesce("_new", F.lit(False)))
        )
    return flagged.select(
        F.col("cluster_id").alias("cluster"),
        name.alias("filename"),
        "scan",
        F.coalesce("precursor_mz", F.lit(0.0)).alias("precursor_mz"),
        F.coalesce("retention_time", F.lit(0.0)).alias("retention_time"),
        "new_batch",
    )


def cluster_summary(scan_list: DataFrame, consensus: DataFrame) -> DataFrame:
    """Per-cluster table. The mass is the representative's, or the first member's when that is
    missing or zero; first means lowest (batch, path, scan)."""
    members = scan_list.groupBy("cluster_id").agg(
        F.count("*").alias("n_spectra"),
        F.min(F.struct("batch_id", "path", "scan", "precursor_mz")).alias("_first"),
        F.avg(F.coalesce("retention_time", F.lit(0.0))).alias("rt_mean"),
    )
    reps = consensus.select(
        "cluster_id", F.nullif(F.col("precursor_mz"), F.lit(0.0)).alias("_mass"), F.col("charge").alias("_charge")
    )
    mass = F.coalesce("_mass", "_first.precursor_mz", F.lit(0.0))
    return members.join(reps, "cluster_id", "left").select(
        F.col("cluster_id").alias("cluster_index"),
        "n_spectra",
        mass.alias("parent_mass"),
        F.coalesce("_charge", F.lit(1)).alias("precursor_charge"),
        mass.alias("precursor_mass"),
        F.lit(0).alias("sum_precursor_intensity"),
        "rt_mean",
    )


def cluster_means(rows: DataFrame) -> DataFrame:
    """Count and means of mass, time and charge per cluster."""
    return rows.groupBy("cluster_id").agg(
        F.count("*").alias("n"),
        F.avg("precursor_mz").alias("mean_mz"),
        F.avg("retention_time").alias("mean_rt"),
        F.avg("charge").alias("mean_charge"),
    )


def noise_last(cluster: Column) -> Column:
    """Sort key that puts the noise label after all clusters."""
    return F.when(cluster != -1, cluster).asc_nulls_last()


def titled(df: DataFrame, titles: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(name).alias(title) for name, title in titles.items()])


def nested(scan_list: DataFrame, page_size: int = 1000) -> DataFrame:
    """Members as arrays, for callers that want them nested: (cluster_id, page, scan_list).

    A cluster is cut into pages of about ``page_size`` members by a hash of the scan, so no row and
    no task holds a whole large cluster.
    """
    pages = scan_list.groupBy("cluster_id").agg(F.ceil(F.count("*") / page_size).cast("bigint").alias("_pages"))
    return (
        scan_list.join(pages, "cluster_id")
        .withColumn("page", F.pmod(F.xxhash64("path", "scan"), F.col("_pages")).cast("int"))
        .groupBy("cluster_id", "page")
        .agg(F.sort_array(F.collect_list(F.struct("path", "scan", "precursor_mz", "retention_time"))).alias("scan_list"))
    )


def flattened(clusters: DataFrame) -> DataFrame:
    """Inverse of ``nested``."""
    return clusters.select("cluster_id", F.explode("scan_list").alias("m")).select("cluster_id", "m.*")


def clusters_with_consensus(scan_list: DataFrame, consensus: DataFrame) -> DataFrame:
    """Every cluster of the scan list with its size and its representative's columns, if it has one."""
    sizes = scan_list.groupBy("cluster_id").agg(F.count("*").alias("n_spectra"))
    return sizes.join(consensus, "cluster_id", "left")


def scans_per_file(scan_list: DataFrame) -> DataFrame:
    """Scans and distinct clusters of each file."""
    return scan_list.groupBy("filename").agg(
        F.count("*").alias("n_scans"), F.countDistinct("cluster_id").alias("n_clusters")
    )
