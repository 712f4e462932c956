"""Import of checkpoints of the earlier file layout: feather lists, consensus and spectrum files.

Each file is read in pieces by tasks (record batches, row ranges of the index); the driver only
learns how many pieces there are. Paths must be visible to all executors.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom import schemas
from peakloom.functions.peaks import list_column
from peakloom.functions.text import basename

# Fixed values of the blob layout: precursor m/z, time, charge, peak count; then float32 pairs.
HEADER = "<ddii"
ROWS_PER_TASK = 10000

BLOB = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("scan", T.LongType()),
        T.StructField("precursor_mz", T.DoubleType()),
        T.StructField("rt_sec", T.DoubleType()),
        T.StructField("charge", T.IntegerType()),
        *schemas.PEAKS,
    ]
)


def _pieces(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(0, count, 1, max(1, count))


def read_feather(spark: SparkSession, path: str, schema: T.StructType = schemas.SCAN_LIST) -> DataFrame:
    """A feather list as a scan-list frame; columns that old files lack become null, masses 0."""
    with pa.OSFile(path) as source:
        reader = pa.ipc.open_file(source)
        count, names = reader.num_record_batches, set(reader.schema.names)
    if not names:
        return spark.createDataFrame([], schema)
    wanted = T.StructType(
        [
            T.StructField("cluster_id", T.LongType()),
            T.StructField("filename", T.StringType()),
            T.StructField("scan", T.LongType()),
            T.StructField("precursor_mz", T.DoubleType()),
            T.StructField("retention_time", T.DoubleType()),
        ]
    )
    kinds = {"cluster_id": pa.int64(), "filename": pa.string(), "scan": pa.int64()}

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.column("id").to_pylist():
                with pa.OSFile(path) as source:
                    table = pa.ipc.open_file(source).get_batch(piece)
                    columns = []
                    for field in wanted.fields:
                        kind = kinds.get(field.name, pa.float64())
                        if field.name in table.schema.names:
                            columns.append(table.column(field.name).cast(kind))
                        else:
                            columns.append(pa.nulls(table.num_rows, kind))
                    yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in wanted.fields])

    rows = _pieces(spark, count).mapInArrow(load, wanted)
    rows = rows.withColumn("path", F.col("filename")).withColumn("filename", basename(F.col("path")))
    for name in ("precursor_mz", "retention_time"):
        rows = rows.withColumn(name, F.coalesce(name, F.lit(0.0)))
    return schemas.conform(rows.withColumn("batch_id", F.lit(0)), schema)


def decode_arrays(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Decode binary columns of raw float32 values into arrays: {binary column: new column}."""
    passed = [f for f in df.schema.fields if f.name not in pairs]
    schema = T.StructType([*passed, *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in pairs.values()]])
    names = [f.name for f in schema.fields]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f.name) for f in passed]
            for old in pairs:
                parts = [np.frombuffer(v or b"", dtype="<f4") for v in batch.column(old).to_pylist()]
                rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                flat = np.concatenate(parts).astype(np.float64) if parts else np.zeros(0)
                columns.append(list_column(flat, rows, len(parts), pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(kernel, schema)


def read_consensus(spark: SparkSession, path: str, batch_id: int = 0) -> DataFrame:
    """Representatives of the earlier consensus file."""
    raw = spark.read.parquet(path).select(
        F.col("cluster_id").cast("bigint"),
        F.col("precursor_mz").cast("double"),
        F.col("rtinseconds").cast("double").alias("rt_sec"),
        F.col("charge").cast("int"),
        "title",
        "spectrum_mz",
        "spectrum_intensity",
    )
    peaks = decode_arrays(raw, {"spectrum_mz": "mz", "spectrum_intensity": "intensity"})
    return schemas.conform(peaks.withColumn("updated_batch", F.lit(batch_id)), schemas.CONSENSUS)


def read_member_pools(spark: SparkSession, path: str) -> DataFrame:
    """Member spectra that the oldest layout kept per cluster: one row per non-empty member."""
    raw = spark.read.parquet(path).select("cluster_id", "spec_pool_mz", "spec_pool_intensity")
    members = raw.select(
        F.col("cluster_id").cast("bigint"), F.posexplode(F.arrays_zip("spec_pool_mz", "spec_pool_intensity"))
    ).select("cluster_id", F.col("pos").alias("member_no"), "col.spec_pool_mz", "col.spec_pool_intensity")
    full = members.where(F.length("spec_pool_mz") > 0)
    return decode_arrays(full, {"spec_pool_mz": "mz", "spec_pool_intensity": "intensity"})


def unpack_blob(data: bytes) -> tuple[float, float, int, np.ndarray]:
    mass, time, charge, count = struct.unpack_from(HEADER, data)
    peaks = np.frombuffer(data, dtype="<f4", count=2 * count, offset=struct.calcsize(HEADER)).reshape(-1, 2)
    return mass, time, charge, peaks.astype(np.float64)


def read_spectrum_store(spark: SparkSession, folder: str) -> DataFrame:
    """Spectra of ``spectra.bin`` by its index file ``spectra_index.db``."""
    index, blob = f"{folder}/spectra_index.db", f"{folder}/spectra.bin"
    with sqlite3.connect(f"file:{index}?mode=ro", uri=True) as db:
        last = db.execute("SELECT COALESCE(MAX(rowid), 0) FROM spectrum_index").fetchone()[0]
    names = [f.name for f in BLOB.fields]
    step = ROWS_PER_TASK

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.column("id").to_pylist():
                db = sqlite3.connect(f"file:{index}?mode=ro", uri=True)
                try:
                    found = db.execute(
                        "SELECT filename, scan, offset, size FROM spectrum_index "
                        "WHERE rowid > ? AND rowid <= ? ORDER BY offset",
                        (piece * step, (piece + 1) * step),
                    ).fetchall()
                finally:
                    db.close()
                columns: list[list] = [[] for _ in names]
                with open(blob, "rb") as source:
                    for path, scan, offset, size in found:
                        source.seek(offset)
                        mass, time, charge, peaks = unpack_blob(source.read(size))
                        row = (path, scan, mass, time, charge, peaks[:, 0], peaks[:, 1])
                        for column, value in zip(columns, row, strict=True):
                            column.append(value)
                kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int32()]
                kinds += [pa.list_(pa.float64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    rows = _pieces(spark, -(-last // step)).mapInArrow(load, BLOB)
    return schemas.conform(
        rows.withColumn("filename", basename(F.col("path"))).withColumn("ms_level", F.lit(2)).withColumn("batch_id", F.lit(0)),
        schemas.STORE,
    )


def stored_or_consensus(wanted: DataFrame, store: DataFrame, consensus: DataFrame) -> DataFrame:
    """Spectra of (path, scan) requests, where a path ``consensus_<id>`` means a representative."""
    cluster: Column = F.regexp_extract("path", r"consensus_(\d+)$", 1)
    asked = wanted.select("path", "scan").distinct().withColumn("cluster_id", cluster.try_cast("bigint"))
    peaks = ["precursor_mz", "rt_sec", "charge", "mz", "intensity"]
    from_consensus = asked.where(F.col("cluster_id").isNotNull()).join(
        consensus.select("cluster_id", *peaks), "cluster_id"
    )
    from_store = asked.where(F.col("cluster_id").isNull()).join(store.select("path", "scan", *peaks), ["path", "scan"])
    return from_consensus.select("path", "scan", *peaks).unionByName(from_store.select("path", "scan", *peaks))
