"""Dense numbering in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.session import Scratch

_ROW_BITS = 33


def highest_id(column: str = "cluster_id") -> Column:
    """Aggregate: the largest id, 0 for an empty table."""
    return F.coalesce(F.max(column), F.lit(0)).cast("bigint")


def max_id(df: DataFrame, column: str = "cluster_id") -> int:
    """The largest id as a number. Reads one column."""
    return df.agg(highest_id(column)).first()[0]


def dense_index(df: DataFrame, keys: list[Column], name: str, scratch: Scratch, base: int = 0) -> DataFrame:
    """Add ``name`` = base + 1, base + 2, ... in the order of ``keys``.

    A range shuffle sorts the rows; each partition numbers its own, and the offsets come from one
    count per partition. Only those counts (at most one row per partition) are broadcast.
    """
    spark = df.sparkSession
    # Without a fixed number, so that small neighbouring ranges may be read by one task, in order.
    placed = scratch.save(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS)),
        name,
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n")).orderBy("_part").collect()
    offsets, total = [], base
    for row in counts:
        offsets.append((row["_part"], total))
        total += row["_n"]
    table = spark.createDataFrame(
        offsets,
        T.StructType([T.StructField("_part", T.LongType()), T.StructField("_offset", T.LongType())]),
    )
    within = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.join(F.broadcast(table), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_at", "_part", "_offset")
    )


def allocate(fresh: DataFrame, key: str, base: int, scratch: Scratch, name: str = "cluster_id") -> DataFrame:
    """New ids for distinct keys: base + dense rank of the key."""
    return dense_index(fresh.select(key).distinct(), [F.col(key)], name, scratch, base)
