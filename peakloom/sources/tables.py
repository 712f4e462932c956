"""Clustering CSV, assignment TSV and result tables as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom import schemas
from peakloom.functions import text
from peakloom.operators.summary import INFO_TITLES, SUMMARY_TITLES, noise_last, titled
from peakloom.session import shuffles_freed

CONSENSUS_FILE = "consensus.mzML"


def read_clustering_csv(spark: SparkSession, path: str) -> DataFrame:
    """Clustering result: cluster, precursor_mz, retention_time, identifier; ``#`` comments.

    Columns are taken by header name, so their order and further columns do not matter.
    """
    raw = spark.read.option("header", True).option("comment", "#").csv(path)
    return schemas.conform(raw, schemas.CLUSTERING_CSV)


def with_scan_reference(clustering: DataFrame) -> DataFrame:
    """Add filename and scan text, taken from the identifier."""
    return clustering.withColumn("filename", text.identifier_filename(F.col("identifier"))).withColumn(
        "scan", text.identifier_scan(F.col("identifier"))
    )


def read_assignment_tsv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    return schemas.conform(raw, schemas.ASSIGNMENT_TSV)


def assignment_rows(assigned: DataFrame, folder: str) -> DataFrame:
    """An imported assignment as merge input (see ``operators.merge``).

    Rows of the representatives' file refer to clusters; others name a spectrum, by a composite
    scan text with its path or by a plain number within ``folder``.
    """
    known = F.col("filename") == CONSENSUS_FILE
    scan = F.col("scan")
    path = F.coalesce(text.composite_path(scan), F.concat(F.lit(folder.rstrip("/") + "/"), F.col("filename")))
    return assigned.select(
        F.col("cluster").alias("temp_cluster"),
        path.alias("path"),
        text.basename(path).alias("filename"),
        F.when(~known, text.composite_scan(scan)).alias("scan"),
        F.when(known, "consensus").otherwise("batch").alias("source"),
        F.when(known, text.consensus_scan(scan)).alias("ref_cluster"),
        text.or_zero(F.col("precursor_mz")).alias("precursor_mz"),
        text.or_zero(F.col("retention_time")).alias("rt_sec"),
    )


def in_noise_last_order(assigned: DataFrame, *ties: str) -> DataFrame:
    """Global order: clusters ascending, noise after them, ties by the given columns."""
    return assigned.orderBy(noise_last(F.col("cluster")), *ties)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated part files, each with a header."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Part files read back as one table: one header counts, as in a merge that keeps it."""
    return spark.read.option("header", True).option("sep", "\t").csv(path)


def write_cluster_info(info: DataFrame, path: str) -> None:
    write_tsv(titled(info, INFO_TITLES), path)


def write_cluster_summary(summary: DataFrame, path: str) -> None:
    write_tsv(titled(summary, SUMMARY_TITLES), path)


def register_views(info: DataFrame, summary: DataFrame) -> None:
    info.createOrReplaceTempView("cluster_info")
    summary.createOrReplaceTempView("cluster_summary")
