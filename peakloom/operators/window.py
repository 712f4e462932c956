"""Similar vectors of near masses, found and scored in cells of the mass order.

Rows are sorted by charge and mass and cut into blocks. The cell of a block holds its rows and, as visitors, those
rows of later blocks that lie within the tolerance of its last ones. So any two rows that may be neighbours meet in
exactly one cell, and a vector is sent once, plus once for each block that the window before it reaches back to. No
row of a pair, or of a vector and a bin, is moved.

Inside a cell an upper bound of all cosines comes from one product of small dense matrices: bins are dealt to
``GROUPS`` groups, the most frequent ones to groups of their own, and a vector is the length of its part in each
group. By Cauchy and Schwarz the products of those lengths add up to the cosine or more, so what lies below the
threshold is out. Where that leaves many pairs of long vectors, a second product over many more groups, of the bins
that meet in the cell, leaves few of them; the rest is scored exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.functions.peaks import list_parts
from peakloom.operators.blocks import BLOCK, Lists, Side, dot_products, number_blocks
from peakloom.operators.similarity import FREQUENCY_SLOTS, feature_counts
from peakloom.params import Tolerance
from peakloom.session import Scratch

GROUPS = 512
OWN_GROUPS = 384  # groups of one frequent slot of bins each; the other slots share what is left
TILE = 512  # rows that meet a block at once
FLOAT_MARGIN, FINE_MARGIN = 1e-4, 5e-4  # rounding of bounds in single precision


def bin_groups(counts: np.ndarray, number: int = GROUPS, own: int = OWN_GROUPS) -> np.ndarray:
    """The group of each slot of bins, from the counts of ``feature_counts``."""
    groups = (own + np.arange(len(counts)) * 7919 % (number - own)).astype(np.int16)
    top = np.argpartition(-counts, own)[:own]
    groups[top] = np.arange(own)
    return groups


def _dealt(rows: DataFrame, vectors: DataFrame, apart: int, scratch: Scratch, most: int) -> DataFrame:
    """Rows with vectors and ``cell``, each cell whole and sorted: its own rows (kind 0), then visitors (kind 1)."""
    order = ["charge", "bucket", "lo", "id"]
    sizes = rows.groupBy("charge", "bucket").agg(F.count("*").cast("double").alias("n"))
    # Rows that one row can reach, about: shorter blocks would send vectors to many cells.
    reached = sizes.agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("n")).first()["n"] or 0.0
    placed, blocks = number_blocks(rows, order, scratch, most, near=True, least=max(64, int(reached * (apart + 1))))
    placed = scratch.save(placed, "blocks")
    # One row for each block and charge, and bucket from its last one on that its rows can reach.
    last = placed.groupBy("block", "charge").agg(F.max("bucket").alias("last"))
    reach = F.explode(F.sequence("last", F.col("last") + apart)).alias("bucket")
    reach = scratch.save(last.select(F.col("block").alias("cell"), "charge", reach), "reach")
    visits = placed.join(reach, ["charge", "bucket"]).where("cell < block").select("id", "cell", F.lit(1).alias("kind"))
    cells = placed.select("id", F.col("block").alias("cell"), F.lit(0).alias("kind")).unionAll(visits)
    cells = cells.groupBy("id").agg(F.collect_list(F.struct("cell", "kind")).alias("cells"))
    full = scratch.save(rows.join(cells, "id"), "cells-of-rows").join(vectors, "id")
    # Written, so that the shuffle by row has gone from the disk when the one by cell begins.
    full = scratch.save(full.select("cells", *order, "hi", "bins", "weights"), "dealt")
    together = full.select("*", F.explode("cells").alias("_c")).select("_c.cell", "_c.kind", *order, "hi", "bins", "weights")
    number = min(blocks, 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return together.repartitionById(number, F.pmod("cell", F.lit(number)).cast("int")).sortWithinPartitions("cell", "kind", *order)


def _merge(component: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components ``a`` and ``b`` of some links; a component is called after its smallest place."""
    parent = np.arange(len(component))
    while True:
        one, two = parent[a], parent[b]
        apart = one != two
        if not apart.any():
            break
        np.minimum.at(parent, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    component[:] = parent[component]


def _linking(
    x: np.ndarray, y: np.ndarray, bound: np.ndarray, first: int, component: np.ndarray, score: Callable, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Enough of the pairs that reach the threshold to connect what all of them connect.

    Place ``y`` is ``first + y`` among the components. The likeliest pair of each y is scored first; pairs inside a
    component are passed over.
    """
    found, take = [], 1
    while True:
        apart = component[x] != component[first + y]
        x, y, bound = x[apart], y[apart], bound[apart]
        if not len(x):
            break
        order = np.lexsort((-bound, y))
        x, y, bound = x[order], y[order], bound[order]
        now = np.arange(len(y)) - np.searchsorted(y, y) < take
        cosine = score(x[now], y[now])["cosine"]
        good = cosine >= threshold
        one, two = x[now][good], y[now][good]
        found.append((one, two, cosine[good]))
        _merge(component, component[one], component[first + two])
        x, y, bound, take = x[~now], y[~now], bound[~now], 4 * take
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64 if i < 2 else float) for i in range(3))


class _Rows:
    """Rows of a cell in their order."""

    def __init__(self, batches: list[pa.RecordBatch], groups: np.ndarray):
        def flat(name: str) -> np.ndarray:
            return np.concatenate([b.column(name).to_numpy() for b in batches])

        self.id, self.charge, self.bucket, self.lo, self.hi = (flat(c) for c in ("id", "charge", "bucket", "lo", "hi"))
        self.side = Side(Lists(batches, ["bins", "weights"]), {})
        lengths = []
        for b in batches:
            bins, rows = list_parts(b.column("bins"))
            weights, _ = list_parts(b.column("weights"))
            at = rows * GROUPS + groups[bins % FREQUENCY_SLOTS]
            squares = np.bincount(at, weights * weights, b.num_rows * GROUPS)
            lengths.append(np.sqrt(squares).astype(np.float32).reshape(b.num_rows, GROUPS))
        self.lengths = np.concatenate(lengths)

    def reached(self, other: _Rows, low: int, high: int, apart: int) -> slice:
        """The rows, one run, that can be ``apart`` buckets at most before rows ``low`` to ``high`` of ``other``."""
        first, last = (other.charge[low], other.bucket[low]), (other.charge[high - 1], other.bucket[high - 1])
        early = (self.charge < first[0]) | ((self.charge == first[0]) & (self.bucket < first[1] - apart))
        late = (self.charge > last[0]) | ((self.charge == last[0]) & (self.bucket > last[1]))
        return slice(int(early.sum()), len(self.id) - int(late.sum()))


def near_pairs(
    rows: DataFrame,
    vectors: DataFrame,
    tol: Tolerance,
    threshold: float,
    apart: int,
    scratch: Scratch,
    linking: bool = False,
    most: int = BLOCK,
) -> DataFrame:
    """(x, y, cosine) of pairs of one charge whose masses lie within ``tol`` and whose cosine reaches the threshold.

    ``rows`` has id, charge, bucket and the mass interval lo to hi; ``vectors`` has id, bins and weights, for which
    rows may be missing. Buckets of neighbours differ by ``apart`` at most. x is the row of smaller mass.

    ``linking``: rows of one bucket count as near whatever their masses, and only enough pairs come to connect what
    all of them connect: a cell gives about as many as it has rows, however many pairs there are.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bin_groups(feature_counts(vectors)))
    dealt = _dealt(rows, vectors, apart, scratch, most)
    least, relative, window = threshold - FLOAT_MARGIN, tol.unit != "da", tol.relative if tol.unit != "da" else tol.value

    def near(left: _Rows, x: np.ndarray, right: _Rows, y: np.ndarray) -> np.ndarray:
        limit = window * right.lo[y] if relative else np.full(len(y), window)
        # as Spark compares: an undefined number is as large as another
        inside = (right.lo[y] - left.hi[x] <= limit) | np.isnan(limit)
        steps = right.bucket[y] - left.bucket[x]
        if linking:
            inside |= steps == 0
        return inside & (steps <= apart) & (left.charge[x] == right.charge[y])

    def met(left: _Rows, right: _Rows, component: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Pairs of a block with itself, or with visitors."""
        own = left is right
        score = dot_products(left.side, right.side)
        for low in range(0, len(right.id), TILE):
            high = min(low + TILE, len(right.id))
            run = left.reached(right, low, high, apart)
            if run.start >= run.stop:
                continue
            bounds = left.lengths[run] @ right.lengths[low:high].T
            x, y = np.nonzero(bounds >= least)
            bound = bounds[x, y]
            x, y = x + run.start, y + low
            good = near(left, x, right, y)
            if own:
                good &= x < y
            if component is not None:
                good &= component[x] != component[(0 if own else len(left.id)) + y]
            x, y, bound = x[good], y[good], bound[good]
            good = score.possible(x, y, threshold - FINE_MARGIN)
            x, y, bound = x[good], y[good], bound[good]
            if component is None:
                cosine = score(x, y)["cosine"]
                good = cosine >= threshold
                x, y, cosine = x[good], y[good], cosine[good]
            else:
                x, y, cosine = _linking(x, y, bound, 0 if own else len(left.id), component, score, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(left.id[x]), pa.array(right.id[y]), pa.array(cosine)], names=["x", "y", "cosine"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        now, held, left, component = None, [], None, None

        def own_rows() -> Iterator[pa.RecordBatch]:
            nonlocal left, held, component
            left, held = _Rows(held, groups), []
            component = np.arange(len(left.id)) if linking else None
            yield from met(left, left, component)

        for batch in batches:
            cells, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(cells)], strict=True):
                if low == high:
                    continue
                if cells[low] != now:
                    if held:
                        yield from own_rows()
                    now, held, left = cells[low], [], None
                part = batch.slice(low, high - low)
                if kinds[low] == 0:
                    held.append(part)
                    continue
                if held:
                    yield from own_rows()
                right = _Rows([part], groups)
                both = None if component is None else np.r_[component, len(left.id) + np.arange(len(right.id))]
                yield from met(left, right, both)
                if both is not None:
                    component = both[: len(left.id)]
        if held:
            yield from own_rows()

    return dealt.mapInArrow(kernel, "x bigint, y bigint, cosine double")
