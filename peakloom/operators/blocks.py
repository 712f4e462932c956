"""Blocks of rows and their cells: a cell is a block of left vectors and a block of right ones.

Rows of vectors meet pair by pair nowhere: each vector is sent once to every cell that needs it, as
a row of arrays, and the cell's pairs are scored there on flat arrays. What moves is at most one copy
of a vector per cell, however many pairs it is in.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.functions.peaks import list_lengths, runs
from peakloom.operators.ids import dense_index
from peakloom.session import Scratch

BLOCK = 8192  # vectors in a block
AT_ONCE = 1 << 21  # products or elements held at once


class Lists:
    """List columns of some rows, concatenated, with the offsets of each row."""

    def __init__(self, batches: list[pa.RecordBatch], names: list[str]):
        self.offsets = np.zeros(1, np.int64)
        self.values: dict[str, np.ndarray] = {}
        if batches:
            lengths = np.concatenate([list_lengths(b.column(names[0])) for b in batches])
            self.offsets = np.r_[0, np.cumsum(lengths)]
            for name in names:
                self.values[name] = np.concatenate([b.column(name).flatten().to_numpy(zero_copy_only=False) for b in batches])

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.offsets[rows + 1] - self.offsets[rows]

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the values, number in ``rows``) of all elements of ``rows``, one row after the other."""
        lengths = self.lengths(rows)
        place = np.repeat(self.offsets[rows] - (np.cumsum(lengths) - lengths), lengths)
        place += np.arange(len(place))
        return place, np.repeat(np.arange(len(rows)), lengths)


def block_count(rows: int, partitions: int, most: int = BLOCK, near: bool = False, least: int = 64) -> int:
    """Blocks of at most ``most`` rows, and enough of them that their pairs fill all partitions.

    ``near``: only blocks next to each other have pairs. Blocks of less than ``least`` rows are not made for that.
    """
    wanted = 2 * partitions if near else math.ceil(math.sqrt(4 * partitions))
    return max(1, math.ceil(rows / most), min(wanted, math.ceil(rows / least)))


def number_blocks(
    rows: DataFrame, keys: list[str], scratch: Scratch, most: int = BLOCK, near: bool = False, least: int = 64
) -> tuple[DataFrame, int]:
    """``rows`` with ``block``: equal runs of the order of ``keys``; and the number of blocks."""
    placed = dense_index(rows, [F.col(k) for k in keys], "_place", scratch)
    count = placed.agg(F.max("_place")).first()[0] or 0
    blocks = block_count(count, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), most, near, least)
    size = max(1, math.ceil(count / blocks))
    placed = placed.withColumn("block", F.floor((F.col("_place") - 1) / F.lit(size)).cast("int")).drop("_place")
    return placed, blocks


def by_cell(rows: DataFrame, order: list[str], blocks: int) -> DataFrame:
    """Rows with ``cell`` = left block * blocks + right block, each cell whole in one partition and sorted."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = min(blocks * blocks, 8 * partitions)
    return rows.repartitionById(number, F.pmod("cell", F.lit(number)).cast("int")).sortWithinPartitions("cell", *order)


@dataclass
class Side:
    """Vectors of one side of a cell: list columns, and one value for each vector of the scalar ones."""

    lists: Lists
    scalars: dict[str, np.ndarray]

    @cached_property
    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct bins, and the number of each element's bin among them."""
        return np.unique(self.lists.values["bins"], return_inverse=True)


COARSE, FINE = 512, (2048, 8192)  # groups of bins of bounds, each of those that the one before leaves
MEETING = 512  # rows of both sides that are bounded at once
PRODUCT_NS, LAYOUT_NS, ELEMENT_NS = 0.045, 10.0, 30.0  # about: of a dense product and layout, and of an exact score's element


class Products:
    """``cosine``: the sum of products of ``weights`` over equal ``bins``, each at most once in a vector.

    The bins of the right side are numbered; a left vector is laid out over them once for all its partners.
    """

    def __init__(self, left: Side, right: Side):
        self.left, self.right = left, right
        known, self.yb = right.numbered
        xb = np.searchsorted(known, left.lists.values["bins"])
        met = np.append(known, -1)[xb] == left.lists.values["bins"] if len(known) else np.zeros(len(xb), bool)
        self.xb = np.where(met, xb, len(known))
        self.laid = np.zeros(len(known) + 1)
        self.groups: dict[int, np.ndarray] = {}

    def __call__(self, at_x: np.ndarray, at_y: np.ndarray) -> dict[str, np.ndarray]:
        left, right, laid = self.left.lists, self.right.lists, self.laid
        out, last = np.zeros(len(at_x)), len(laid) - 1
        if not len(at_x):
            return {"cosine": out}
        order = np.argsort(at_x, kind="stable")
        cuts = np.flatnonzero(np.diff(at_x[order])) + 1
        for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(order)], strict=True):
            x = at_x[order[low]]
            own = np.arange(left.offsets[x], left.offsets[x + 1])
            own = own[self.xb[own] < last]
            laid[self.xb[own]] = left.values["weights"][own]
            for piece in runs(right.lengths(at_y[order[low:high]]), AT_ONCE):
                rows = order[low + piece.start : low + piece.stop]
                place, number = right.gather(at_y[rows])
                out[rows] = np.bincount(number, laid[self.yb[place]] * right.values["weights"][place], len(rows))
            laid[self.xb[own]] = 0.0
        return {"cosine": out}

    def _grouped(self, number: int) -> np.ndarray:
        """The group of each bin: those that meet most have one of their own; -1 for bins of one side only."""
        if number not in self.groups:
            count, own = len(self.laid) - 1, number * 3 // 4
            meeting = np.bincount(self.xb, minlength=count + 1)[:count] * np.bincount(self.yb, minlength=count)
            groups = own + np.arange(count) % (number - own)
            top = np.argsort(-meeting, kind="stable")[:own]
            groups[top] = np.arange(len(top))
            groups[meeting == 0] = -1
            self.groups[number] = np.append(groups, -1)
        return self.groups[number]

    def _lengths(self, lists: Lists, bins: np.ndarray, rows: np.ndarray, number: int) -> np.ndarray:
        """Length of the part of each row in each group."""
        place, at = lists.gather(rows)
        group = self._grouped(number)[bins[place]]
        inside = group >= 0
        squares = np.bincount(at[inside] * number + group[inside], lists.values["weights"][place[inside]] ** 2, len(rows) * number)
        return np.sqrt(squares).astype(np.float32).reshape(len(rows), number)

    def possible(self, at_x: np.ndarray, at_y: np.ndarray, least: float, levels: tuple[int, ...] = FINE) -> np.ndarray:
        """Mask of the pairs whose cosine may reach ``least``.

        The bound is that of ``operators.window``, over the bins of these two sides and with more groups at each
        level. Pairs of few elements pass as they are: scoring them costs less than their bound.
        """
        keep = np.ones(len(at_x), bool)
        for number in levels:
            left = np.flatnonzero(keep)
            xs, ix = np.unique(at_x[left], return_inverse=True)
            ys, iy = np.unique(at_y[left], return_inverse=True)
            tile = ix // MEETING * (len(ys) // MEETING + 1) + iy // MEETING
            order = np.argsort(tile, kind="stable")
            cuts = np.flatnonzero(np.diff(tile[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                x, y = (np.unique(at[part], return_inverse=True) for at in (ix, iy))
                nx, ny = len(x[0]), len(y[0])
                dense = nx * ny * number * PRODUCT_NS + (nx + ny) * number * LAYOUT_NS
                if dense > ELEMENT_NS * self.right.lists.lengths(at_y[left[part]]).sum():
                    continue
                a = self._lengths(self.left.lists, self.xb, xs[x[0]], number)
                b = self._lengths(self.right.lists, self.yb, ys[y[0]], number)
                keep[left[part]] = (a @ b.T)[x[1], y[1]] >= least
        return keep


def dot_products(left: Side, right: Side) -> Products:
    return Products(left, right)
