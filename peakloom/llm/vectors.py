"""Vectors of an Arrow column as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

EXACT = 1 << 53  # up to here a double holds every whole number


def whole_numbers(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that take part, floor(scale * x) of their components one after the other, number of components of each).

    ``column`` is a list<double> array. Rows that are null, or hold a null or a component that is not finite, take no
    part. A component whose whole number does not fit a long raises OverflowError.
    """
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    values = pc.fill_null(pc.list_flatten(column), np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(sizes)
    good = (bad[ends] == bad[ends - sizes]) & pc.is_valid(column).to_numpy(zero_copy_only=False)
    values = values[np.repeat(good, sizes)]
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values)
    if np.any(np.abs(scaled) >= 1 << 62):
        raise OverflowError("a scaled component does not fit a long")
    return np.flatnonzero(good), scaled.astype(np.int64), sizes[good]


def matrix(values: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """One row for each vector; components that a shorter one lacks are 0."""
    if len(sizes) and sizes.min() == sizes.max() == width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest of the types int16, int32 and int64 that holds them."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)
