"""The spectrum store: an append-only table where the last write of a (path, scan) counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["path", "scan"]
# Fixed values of the earlier binary layout: header bytes per spectrum and bytes per peak.
HEADER_BYTES = 24
PEAK_BYTES = 8


def latest(store: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """Last write per key. Spark cuts each input partition to one row per key before the shuffle."""
    window = Window.partitionBy(*(keys or KEY)).orderBy(*[F.col(c).desc() for c in order])
    return store.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def lookup(store: DataFrame, wanted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Stored rows of the wanted keys; a key asked for twice comes once."""
    keys = keys or KEY
    return store.join(wanted.select(*keys).distinct(), keys, "left_semi")


def lookup_report(store: DataFrame, wanted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Wanted keys, once each, with ``found``."""
    keys = keys or KEY
    there = store.select(*keys).distinct().withColumn("found", F.lit(True))
    return wanted.select(*keys).distinct().join(there, keys, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def remove(store: DataFrame, listed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or KEY
    return store.join(listed.select(*keys).distinct(), keys, "left_anti")


def record_bytes(peak_count: Column) -> Column:
    return F.lit(HEADER_BYTES) + peak_count * PEAK_BYTES


def stats(store: DataFrame, peak_count: Column) -> DataFrame:
    """One row: spectrum count, peaks, bytes and megabytes of the earlier binary layout."""
    total = F.coalesce(F.sum(record_bytes(peak_count)), F.lit(0)).cast("bigint")
    return store.agg(
        F.count("*").alias("spectrum_count"),
        F.coalesce(F.sum(peak_count), F.lit(0)).cast("bigint").alias("peak_count"),
        total.alias("total_size"),
        (total / F.lit(1048576.0)).alias("total_size_mb"),
    )


def point(store: DataFrame, **key) -> DataFrame:
    """Rows of one key; the filter reaches the file scan."""
    for name, value in key.items():
        store = store.where(F.col(name) == value)
    return store.limit(1)


def present(store: DataFrame, **key) -> bool:
    return not point(store, **key).isEmpty()
