"""Peak-list expressions and the binning kernel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.params import ClusterParams

# Fixed values of the multiplicative (golden ratio) hash on 32 bits.
HASH_FACTOR = 2654435761
HASH_SPACE = 4294967296
VECTORISED = 1 << 18  # peaks of the rows that are vectorised at once, about


def as_pairs(mz: Column, intensity: Column) -> Column:
    """Two parallel arrays as one array of (mz, intensity)."""
    return F.zip_with(mz, intensity, lambda m, i: F.struct(m.alias("mz"), i.alias("intensity")))


def usable_peaks(pairs: Column, min_mz: float | None = None, max_mz: float | None = None) -> Column:
    """Peaks whose two numbers are finite, optionally inside an m/z range."""

    def keep(p: Column) -> Column:
        test = F.lit(True)
        for name in ("mz", "intensity"):
            v = p[name]
            test = test & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
        if min_mz is not None:
            test = test & (p["mz"] >= min_mz)
        if max_mz is not None:
            test = test & (p["mz"] <= max_mz)
        return test

    return F.filter(pairs, keep)


def clean_peaks(df: DataFrame, min_mz: float | None = None, max_mz: float | None = None) -> DataFrame:
    """Replace the peak arrays by their usable part."""
    pairs = usable_peaks(as_pairs(F.col("mz"), F.col("intensity")), min_mz, max_mz)
    return (
        df.withColumn("_p", pairs)
        .withColumn("mz", F.col("_p.mz"))
        .withColumn("intensity", F.col("_p.intensity"))
        .drop("_p")
    )


def hash_bin(bin_no: Column, length: int) -> Column:
    """Fold a bin number into ``length`` dimensions; integer arithmetic only."""
    mixed = (bin_no.cast("bigint") * F.lit(HASH_FACTOR)) % F.lit(HASH_SPACE)
    return F.shiftright(mixed * F.lit(length), 32)


def list_parts(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, row number of each value) of a list column; null lists count as empty."""
    lengths = list_lengths(column)
    values = column.flatten()
    flat = values.to_numpy(zero_copy_only=False)
    return flat, np.repeat(np.arange(len(lengths)), lengths)


def list_lengths(column: pa.Array) -> np.ndarray:
    return pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)


def runs(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Consecutive rows that hold about ``most`` elements together; a larger row stands alone."""
    total, start = np.r_[0, np.cumsum(sizes)], 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + most, "right")) - 1)
        yield slice(start, stop)
        start = stop


def row_order(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Stable order by (row, whole number): ``np.lexsort((values, rows))``, as one sort of packed numbers if they fit."""
    if not len(rows):
        return np.zeros(0, np.int64)
    low, high = int(values.min()), int(values.max())
    bits, wide = len(rows).bit_length(), (high - low).bit_length()
    if int(rows.max()).bit_length() + wide + bits > 62:
        return np.lexsort((values, rows))
    packed = (((rows.astype(np.int64) << wide) | (values.astype(np.int64) - low)) << bits) | np.arange(len(rows))
    packed.sort()
    return packed & ((1 << bits) - 1)


def list_column(values: np.ndarray, rows: np.ndarray, count: int, kind: pa.DataType) -> pa.Array:
    """Inverse of ``list_parts``; ``rows`` must be sorted."""
    offsets = np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def vectorise(df: DataFrame, params: ClusterParams) -> DataFrame:
    """Add ``bins`` and ``weights``: binned, optionally hashed, unit-length peak vectors.

    Peaks outside the m/z range or not finite do not count; spectra whose remaining peaks span
    less than ``min_mz_range`` are left out. A map-only Arrow kernel: no shuffle of peaks. Arrays are made for
    runs of rows of bounded peaks, so that memory does not follow the peaks of a batch.
    """
    min_mz, max_mz, width = params.min_mz, params.max_mz, params.fragment_tol
    min_range, hash_len, most = params.min_mz_range, params.hash_len, VECTORISED
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("bins", T.ArrayType(T.LongType())),
            T.StructField("weights", T.ArrayType(T.DoubleType())),
        ]
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in runs(list_lengths(batch.column("mz")), most):
                yield batch.slice(rows.start, rows.stop - rows.start)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            count = batch.num_rows
            mz, rows = list_parts(batch.column("mz"))
            inten, rows_i = list_parts(batch.column("intensity"))
            if len(rows) != len(rows_i) or (rows != rows_i).any():
                raise ValueError("m/z and intensity arrays differ in length")
            mz = mz.astype(np.float64)
            inten = inten.astype(np.float64)
            good = np.isfinite(mz) & np.isfinite(inten) & (mz >= min_mz) & (mz <= max_mz)
            mz, inten, rows = mz[good], inten[good], rows[good]
            low, high = np.full(count, np.inf), np.full(count, -np.inf)
            np.minimum.at(low, rows, mz)
            np.maximum.at(high, rows, mz)
            span = np.where(high >= low, high - low, 0.0)
            bins = np.floor(mz / width).astype(np.int64)
            if hash_len:
                bins = (((bins * HASH_FACTOR) % HASH_SPACE) * hash_len) >> 32
            order = row_order(rows, bins)
            bins, rows, inten = bins[order], rows[order], inten[order]
            if len(bins):
                first = np.r_[True, (bins[1:] != bins[:-1]) | (rows[1:] != rows[:-1])]
                starts = np.flatnonzero(first)
                inten = np.add.reduceat(inten, starts)
                bins, rows = bins[starts], rows[starts]
            live = inten > 0
            bins, rows, inten = bins[live], rows[live], inten[live]
            norm = np.sqrt(np.bincount(rows, inten * inten, count))
            weights = inten / norm[rows]
            out = pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    list_column(bins, rows, count, pa.int64()),
                    list_column(weights, rows, count, pa.float64()),
                ],
                names=[*batch.schema.names, "bins", "weights"],
            )
            yield out.filter(pa.array(span >= min_range))

    return df.mapInArrow(kernel, schema)


#: Peak filter before networking: how many stronger peaks within how far, and how far from the precursor.
WINDOW, WINDOW_PEAKS, PRECURSOR_GAP = 50.0, 6, 17.0
_AT_ONCE = 1 << 21


def strong_peaks(mz: np.ndarray, intensity: np.ndarray, rows: np.ndarray, precursor: np.ndarray) -> np.ndarray:
    """Mask of peaks with fewer than ``WINDOW_PEAKS`` stronger ones within ``WINDOW``, and away from the precursor.

    Peaks near the precursor go first, so they take no place in a window. ``rows`` ascend, and ``mz`` within
    a row; ``precursor`` has one mass per row, null or NaN where there is none.
    """
    mass = precursor.astype(np.float64)[rows]
    keep = ~(np.abs(mz - mass) <= PRECURSOR_GAP)
    left = np.flatnonzero(keep)
    mz, intensity, rows = mz[left], intensity[left], rows[left]
    width = (mz.max(initial=0.0) - mz.min(initial=0.0)) + 2 * WINDOW + 1.0
    axis = rows * width + (mz - mz.min(initial=0.0))
    slack = WINDOW + 1e-6
    first = np.searchsorted(axis, axis - slack, "left")
    span = np.searchsorted(axis, axis + slack, "right") - first
    total, start = np.r_[0, np.cumsum(span)], 0
    while start < len(mz):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + _AT_ONCE, "right")) - 1)
        n = span[start:stop]
        one = np.repeat(np.arange(start, stop), n)
        other = np.repeat(first[start:stop] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        stronger = (intensity[other] > intensity[one]) & (np.abs(mz[other] - mz[one]) <= WINDOW)
        keep[left[start:stop]] = np.bincount(one[stronger] - start, minlength=stop - start) < WINDOW_PEAKS
        start = stop
    return keep
