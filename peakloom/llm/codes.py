"""Vector code compression: product codes whose nearest entries are found by equal-average search.

Vectors become whole numbers, floor(scale * x), and are cut into equal consecutive parts. The codebook of a part
position starts as that part of the vectors with the smallest ids. Each round assigns every part to its nearest entry
(squared distance, ties to the lower index) and replaces each entry by the componentwise floor(sum / count) of its
parts; an entry without parts stays. After the last round all parts are assigned once more.

Nearest entries: the entries of a codebook are sorted by the sum of their components. From a part's own sum the search
goes outward on both sides; it ends on a side once the squared gap of sums, divided by the number of dimensions,
strictly exceeds the best distance, which no entry further out can beat. Parts of nearly equal sums go together, a few
entries at a time, so distances are matrix products; a part that is done leaves the product.

Each round is one pass over a written table; a task sends one sum per entry it used, so at most entries x parts rows
each, and only the summed entries (entries x parts rows) reach the driver.

Defined cases: a row whose vector is null, or holds a null or a component that is not finite, is dropped. Vectors are
filled with zeros to the longest one's length, rounded up to a multiple of the parts. With fewer vectors than entries
each is an entry; equal ids are told apart by their vectors; null ids come last. Every row of a repeated id is coded.
An empty table gives an empty result. Other columns pass through; a column named like an output is replaced, in
whatever case. A component that does not fit a long raises OverflowError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.llm.vectors import EXACT, matrix, whole_numbers
from peakloom.llm.words import bound_batches, releasing
from peakloom.session import Scratch

TOGETHER = 256  # parts of nearly equal sums that are searched together
STEP = 16  # entries looked at in one step of a side


@dataclass(frozen=True)
class Codebook:
    """Entries of one part position in index order, whole numbers."""

    entries: np.ndarray

    @property
    def dims(self) -> int:
        return self.entries.shape[1]


class _Sorted:
    """Entries by the sum of their components."""

    def __init__(self, book: Codebook):
        self.index = np.argsort(book.entries.sum(1), kind="stable")
        self.entries = book.entries[self.index].astype(np.float64)
        self.sums = self.entries.sum(1)
        self.squares = (self.entries**2).sum(1)
        self.most = int(np.abs(book.entries).max(initial=0))
        self.whole = book.entries


def nearest(parts: np.ndarray, book: _Sorted) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each part's nearest entry, ties to the lower index."""
    if not book.whole.shape[1]:
        return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    most = max(int(np.abs(parts).max(initial=0)), book.most)
    if 4 * parts.shape[1] ** 2 * max(most, 1) ** 2 >= EXACT:
        return _nearest_large(parts, book.whole)
    values = parts.astype(np.float64)
    sums = values.sum(1)
    order = np.argsort(sums, kind="stable")
    index, distance = np.empty(len(parts), np.int64), np.empty(len(parts))
    for low in range(0, len(parts), TOGETHER):
        rows = order[low : low + TOGETHER]
        index[rows], distance[rows] = _outward(values[rows], sums[rows], book)
    return index, distance.astype(np.int64)


def _outward(values: np.ndarray, sums: np.ndarray, book: _Sorted) -> tuple[np.ndarray, np.ndarray]:
    """Parts of nearly equal sums against the entries, from the middle sum outward."""
    n, dims = values.shape
    squares = (values**2).sum(1)
    index, best = np.full(n, len(book.index)), np.full(n, np.inf)
    above = below = int(np.searchsorted(book.sums, sums[n // 2]))
    right, left = np.arange(n), np.arange(n)  # parts that still look upward and downward

    def look(rows: np.ndarray, low: int, high: int) -> None:
        order = low + np.argsort(book.index[low:high])  # the lowest index comes first among equals
        gaps = squares[rows, None] - 2 * (values[rows] @ book.entries[order].T) + book.squares[order]
        at = gaps.argmin(1)
        near, name = gaps[np.arange(len(rows)), at], book.index[order][at]
        better = (near < best[rows]) | (near == best[rows]) & (name < index[rows])
        best[rows[better]], index[rows[better]] = near[better], name[better]

    while True:
        if above < len(book.sums):
            gap = np.maximum(book.sums[above] - sums[right], 0)
            right = right[gap * gap <= dims * best[right]]
        else:
            right = right[:0]
        if len(right):
            look(right, above, above := min(above + STEP, len(book.sums)))
        if below > 0:
            gap = np.maximum(sums[left] - book.sums[below - 1], 0)
            left = left[gap * gap <= dims * best[left]]
        else:
            left = left[:0]
        if len(left):
            look(left, max(below - STEP, 0), below)
            below = max(below - STEP, 0)
        if not len(right) and not len(left):
            return index, best


def _nearest_large(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers too large for doubles: Python's whole numbers against every entry."""
    found = []
    for part in parts.astype(object):
        found.append(min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(entries.tolist())))
    if any(d > np.iinfo(np.int64).max for d, _ in found):
        raise OverflowError("a squared distance does not fit a long")
    return np.array([i for _, i in found], np.int64), np.array([d for d, _ in found], np.int64)


def _kept(scale: int, at: int):
    """Rows that take part, with whole numbers in place of the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values, sizes = whole_numbers(batch.column(at), scale)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            packed = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            left = batch.take(pa.array(rows))
            columns = [packed if i == at else left.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return matrix(column.flatten().to_numpy(), column.value_lengths().to_numpy(), width)


def _sums(books: list[Codebook], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_books = [_Sorted(b) for b in books]
        dims = width // len(books)
        totals = [np.zeros((len(b.entries), dims), np.int64) for b in books]
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        for batch in batches:
            rows = _numbers(batch.column(0), width)
            for p, book in enumerate(sorted_books):
                part = rows[:, p * dims : (p + 1) * dims]
                index, _ = nearest(part, book)
                np.add.at(totals[p], index, part)
                counts[p] += np.bincount(index, minlength=len(counts[p]))
        rows = [
            {"part": p, "entry": int(e), "n": int(counts[p][e]), "total": totals[p][e].tolist()}
            for p in range(len(books))
            for e in np.flatnonzero(counts[p])
        ]
        if rows:
            yield pa.RecordBatch.from_pylist(
                rows, pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])
            )

    return run


def _codes(books: list[Codebook], width: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_books = [_Sorted(b) for b in books]
        dims = width // len(books)
        for batch in batches:
            rows = _numbers(batch.column(at), width)
            found = [nearest(rows[:, p * dims : (p + 1) * dims], book) for p, book in enumerate(sorted_books)]
            code = [bytes(c).hex() for c in np.stack([i for i, _ in found], 1).astype(np.uint8)]
            error = np.sum([d for _, d in found], 0)
            others = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*others, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=[*names, "code", "error"])

    return run


def digest(books: list[Codebook]) -> str:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.entries.reshape(-1).tolist()).encode()).hexdigest()


def _refined(kept: DataFrame, books: list[Codebook], width: int) -> list[Codebook]:
    """The codebooks after one more round."""
    dims = width // len(books)
    sums = kept.select("__whole").mapInArrow(releasing(_sums(books, width)), "part int, entry int, n bigint, total array<bigint>")
    added = F.array(*[F.sum(F.col("total")[j]) for j in range(dims)]) if dims else F.array().cast("array<bigint>")
    out = [b.entries.copy() for b in books]
    for row in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), added.alias("total")).collect():
        out[row["part"]][row["entry"]] = [t // row["n"] for t in row["total"]]
    return [Codebook(e) for e in out]


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, scratch: Scratch | None = None
) -> tuple[DataFrame, list[Codebook]]:
    """(rows of ``vectors`` that take part, without the vector but with code and error; the final codebooks).

    ``vectors`` has vec_id and embedding; at most 256 entries, two hex digits each in ``code``. ``error`` is the
    squared distance to the entries, summed over the parts.
    """
    if not 1 <= entries <= 256:
        raise ValueError("between 1 and 256 entries")
    spark = vectors.sparkSession
    bound_batches(spark)
    scratch = scratch or Scratch(spark)
    others = [c for c in vectors.columns if c.lower() not in ("embedding", "code", "error")]
    whole = F.col("embedding").cast("array<double>").alias("__whole")
    rows = vectors.select(*others, whole)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("__whole", T.ArrayType(T.LongType()))])
    kept = scratch.save(rows.mapInArrow(releasing(_kept(scale, len(others))), schema), "kept")
    longest = kept.agg(F.max(F.size("__whole"))).head()[0] or 0
    width = -(-longest // parts) * parts
    first = kept.select("vec_id", "__whole").orderBy(F.asc_nulls_last("vec_id"), "__whole").limit(entries).collect()
    sizes = np.array([len(r["__whole"]) for r in first], np.int64)
    start = matrix(np.array([x for r in first for x in r["__whole"]], np.int64), sizes, width)
    dims = width // parts
    books = [Codebook(start[:, p * dims : (p + 1) * dims].copy()) for p in range(parts)]
    out = T.StructType([*schema.fields[:-1], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return kept.select(*others, F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), books
    for _ in range(rounds):
        books = _refined(kept, books, width)
    return kept.mapInArrow(releasing(_codes(books, width, len(others))), out), books


def with_group_error(coded: DataFrame, group: str, name: str, scratch: Scratch) -> DataFrame:
    """``coded`` with the error summed over rows of equal ``group``, nulls together.

    Sums are taken map-side first and written, so that their size is known when they are joined back.
    """
    coded = scratch.save(coded.drop(name), "coded")
    sums = scratch.save(coded.groupBy(F.col(group).alias("__group")).agg(F.sum("error").alias(name)), "sums")
    return coded.join(sums, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
