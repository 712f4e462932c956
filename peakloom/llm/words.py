"""Words of whole Arrow batches as numpy arrays: places and 64-bit hashes, without a loop over words.

Texts are UTF-8. A byte of 0x80 and above belongs to a character outside ASCII, so a character class
that tells ASCII characters apart and takes all others alike can be decided byte by byte.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

PIECE = 1 << 20  # bytes handled at once; a longer text is cut between words
#: Bounds of what Spark hands to Python at once. Texts differ in length, so rows alone bound nothing.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240601).integers(0, 1 << 64, 256, dtype=np.uint64)


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch sizes to the bounds above; smaller ones stay."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", spark.conf.get(key).strip().lower()).groups()
        now = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def release_memory() -> None:
    """Give freed memory back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches; at its end the worker, which goes on living, gives its memory back."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole


@dataclass(frozen=True)
class Classes:
    """Which bytes make words, and what they are lower-cased to."""

    member: np.ndarray
    value: np.ndarray


def byte_classes(separators: bytes, keep_case: bool = False) -> Classes:
    member = np.ones(256, bool)
    member[list(separators)] = False
    lowered = bytes(range(256)) if keep_case else bytes(range(256)).lower()
    return Classes(member, BYTE_VALUES[np.frombuffer(lowered, np.uint8)])


#: Letters, digits and all characters outside ASCII.
ALPHANUMERIC = byte_classes(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: Everything but white space.
SPACED = byte_classes(b" \t\n\v\f\r")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 2 * PIECE:
            _powers[name] = known
    return known[:n]


def binary(column: pa.Array) -> pa.Array:
    """A string or binary column as binary, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    column = column.cast(kind)
    return pc.fill_null(column, b"") if column.null_count else column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the rows and of the end) of a binary column without nulls."""
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def groups(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` bytes together; a longer row stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


@dataclass
class Words:
    """Words of some rows: where each begins and ends in ``data``, its hash, and the first word of each row."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # one entry more than rows

    def text(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()


def _piece(data: np.ndarray, cuts: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    member = classes.member[data]
    before = np.empty_like(member)
    before[0] = False
    before[1:] = member[:-1]
    after = np.empty_like(member)
    after[-1] = False
    after[:-1] = member[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    before[inner] = False
    after[inner - 1] = False
    begin = np.flatnonzero(member & ~before)
    end = np.flatnonzero(member & ~after) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(classes.value[data] * _power(BASE, "up", len(data)), out=total[1:])
    hashes = (total[end] - total[begin]) * _power(INVERSE, "down", len(data))[begin]
    return begin, end, mix(hashes ^ (end - begin).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray, classes: Classes) -> Words:
    """Words of consecutive rows; equal words have equal hashes, wherever they stand."""
    low, high = int(offsets[0]), int(offsets[-1])
    parts = []
    at = low
    while at < high:
        to = min(at + PIECE, high)
        while to < high and classes.member[data[to]] and classes.member[data[to - 1]]:
            stop = np.flatnonzero(~classes.member[data[to : to + 65536]])
            to = min(to + (int(stop[0]) if len(stop) else 65536), high)
        begin, end, hashes = _piece(data[at:to], offsets - at, classes)
        parts.append((begin + at, end + at, hashes))
        at = to
    if parts:
        begin, end, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        begin, end, hashes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return Words(data, begin, end, hashes, np.searchsorted(begin, offsets))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k words, first run of each row).

    A row of fewer words, but not none, has its whole sequence as one run.
    """
    n = len(words.hashes)
    counts = np.diff(words.first)
    runs = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    first = np.concatenate([[0], np.cumsum(runs)])
    if not n:
        return np.zeros(0, np.uint64), first
    odd = [np.uint64((0xD6E8FEB86659FD93 * (2 * j + 1)) % (1 << 64) | 1) for j in range(k)]
    terms = [words.hashes * m for m in odd]
    whole = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        whole[: n - j] += terms[j][j:]
    long = counts >= k
    ends = np.where(long, words.first[1:] - k + 1, words.first[:-1])
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, words.first[:-1][long], 1)
    np.add.at(mark, ends[long], -1)
    inside = np.cumsum(mark[:-1]) > 0
    for row in np.flatnonzero((counts > 0) & ~long):
        a, b = words.first[row], words.first[row + 1]
        inside[a] = True
        whole[a] = sum((int(terms[j][a + j]) for j in range(b - a)), int(b - a)) & 0xFFFFFFFFFFFFFFFF
    return mix(whole[inside]), first
