"""Cosine-similarity joins over sparse unit vectors.

Candidates come from a prefix filter, which is exact: order all features by one global order,
and give each vector the shortest prefix of its features whose remainder has length below the
threshold t. Two vectors with similarity >= t share a feature of both prefixes, since otherwise
all they share lies in the remainder of one of them, and that remainder times a unit vector is
below t. Rare features come first in the order, so prefixes rarely meet by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.functions.peaks import list_column, list_lengths, list_parts
from peakloom.session import Scratch

# Feature counts are kept in this many slots at most, so what is collected and broadcast is
# bounded whatever the data. Slots only shape the order of features, never the result.
FREQUENCY_SLOTS = 1 << 20
# Rounding margin on similarity bounds; survivors are always scored exactly afterwards.
MARGIN = 1e-9


def feature_counts(vectors: DataFrame) -> np.ndarray:
    """How many vectors hold a feature, per slot; at most FREQUENCY_SLOTS numbers."""
    table = (
        vectors.select(F.explode("bins").alias("bin"))
        .groupBy(F.pmod("bin", F.lit(FREQUENCY_SLOTS)).cast("int").alias("slot"))
        .agg(F.count("*").alias("n"))
        .toPandas()
    )
    counts = np.zeros(FREQUENCY_SLOTS, dtype=np.int64)
    counts[table["slot"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    return counts


def prefixes(vectors: DataFrame, threshold: float, counts: np.ndarray) -> DataFrame:
    """Add ``prefix`` (features), ``prefix_weights`` and ``rest`` (length of the remainder).

    Prefixes are as short as exactness allows, so vectors that share nothing but frequent features
    never meet. Map-only; other columns pass through.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(counts)
    keep = [f for f in vectors.schema.fields if f.name not in ("bins", "weights")]
    schema = T.StructType(
        [
            *keep,
            T.StructField("prefix", T.ArrayType(T.LongType())),
            T.StructField("prefix_weights", T.ArrayType(T.DoubleType())),
            T.StructField("rest", T.DoubleType()),
        ]
    )
    names = [f.name for f in keep]
    slots, cut = FREQUENCY_SLOTS, threshold - MARGIN

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = shared.value
        for batch in batches:
            count = batch.num_rows
            bins, rows = list_parts(batch.column("bins"))
            weights, _ = list_parts(batch.column("weights"))
            bins = bins.astype(np.int64)
            order = np.lexsort((bins, frequency[bins % slots], rows))
            bins, weights = bins[order], weights[order]
            mass = np.cumsum(weights * weights)
            starts = np.searchsorted(rows, np.arange(count))
            before = np.r_[0.0, mass][starts]
            through = mass - before[rows]
            ahead = through - weights * weights
            # A feature belongs to the prefix while the part from it onwards is long enough.
            inside = np.sqrt(np.clip(1.0 - ahead, 0.0, None)) >= cut
            used = np.bincount(rows[inside], weights[inside] ** 2, count)
            rest = np.sqrt(np.clip(1.0 - used, 0.0, None))
            columns = [
                *[batch.column(n) for n in names],
                list_column(bins[inside], rows[inside], count, pa.int64()),
                list_column(weights[inside], rows[inside], count, pa.float64()),
                pa.array(rest, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return vectors.mapInArrow(kernel, schema)


def explode_prefixes(table: DataFrame) -> DataFrame:
    """One row per prefix feature: the table's other columns, ``feature`` and ``w``."""
    rest = [c for c in table.columns if c not in ("prefix", "prefix_weights")]
    return (
        table.select(*rest, F.explode(F.arrays_zip("prefix", "prefix_weights")).alias("_p"))
        .select(*rest, F.col("_p.prefix").alias("feature"), F.col("_p.prefix_weights").alias("w"))
    )
