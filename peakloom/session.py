"""Session settings and the scratch area for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: runtime re-planning with skew-join splitting, UTC times,
# and Arrow batches small enough for rows that carry peak arrays.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(name: str = "peakloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="peakloom-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir()


# Spark's setting by which the shuffle files of a query go when it ends, not when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """For writes: what a written table was made from is not read again, so its shuffle files go at once."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write Parquet; only the table itself stays on disk."""
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).option("compression", SETTINGS["spark.sql.parquet.compression.codec"]).parquet(path)


class Scratch:
    """Tables written under the checkpoint folder to cut lineage.

    A written table survives lost executors, and its file size gives the planner true
    statistics, so a later broadcast is chosen only for a side whose size is known.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{checkpoint_root(spark)}/tables-{uuid.uuid4().hex}"
        self._count = 0

    def inner(self, name: str) -> Scratch:
        """An area inside this one, to be cleared as soon as a step has written its results."""
        self._count += 1
        return Scratch(self.spark, f"{self.root}/{self._count:03d}-{name}")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        write_table(df, path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, table: DataFrame) -> None:
        delete(self.spark, table._scratch_path)

    def clear(self) -> None:
        delete(self.spark, self.root)


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system it lies on."""
    system, target = _hadoop_path(spark, path)
    return system.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop_path(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    system, target = _hadoop_path(spark, path)
    system.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    system, target = _hadoop_path(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _hadoop_path(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file so that it appears whole: to a side name, then renamed."""
    system, target = _hadoop_path(spark, path)
    _, side = _hadoop_path(spark, path + ".part")
    stream = system.create(side, True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    if system.exists(target):
        system.delete(target, False)
    if not system.rename(side, target):
        raise OSError(f"could not move {side} to {target}")
