"""Exact top-k search by inner product: branch and bound over vertical blocks.

Vectors become whole numbers, floor(scale * x). They are packed, up to 2,048 together, in a vertical layout: for each
run of eight dimensions one array, dimension after dimension. A query's scores of a block grow by one run of
dimensions at a time. What the remaining dimensions can still add is at most the square root of the product of the
remaining masses (sums of squares) of both sides; candidates whose bound stays below the query's k-th best score so
far are left out, and the survivors are compacted. Bounds are compared with ties kept, so results are exact.

Packed blocks and queries meet in a grid: queries are dealt to parts of about 16,000, blocks to groups; each cell of
the grid streams its blocks past its queries and returns k rows for each query. There are about as many cells as
shuffle partitions, so what the cells return is bounded, and no task holds more than the queries of one part and one
block. The work grows with queries times rows, which the task itself asks for.

Defined cases: a vector that is null, or holds a null or a component that is not finite, takes no part, neither as
query nor as candidate. Components that the shorter of two vectors lacks count as 0. Every row is a row of its own: a
repeated row finds its twin, and each repeated query gets its own rows. Rows with a null id are candidates; at equal
score they come last. Ties go to the smaller id. Fewer than k candidates are all returned; an empty table gives an
empty result. Other columns are not read. A component or score that does not fit a long raises OverflowError.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakloom.llm.vectors import EXACT, matrix, narrow, whole_numbers
from peakloom.llm.words import bound_batches, releasing
from peakloom.session import Scratch

BLOCK_ROWS = 2_048
RUN = 8  # dimensions in a run
PART_QUERIES = 16_384
AT_ONCE = 256  # queries scored together
LAST = np.iinfo(np.int64).max

_PACKED = (
    "source int, sequence int, ids binary, missing binary, width int, runs array<binary>, "
    "asked int, asked_at binary, asked_width int, asked_values binary"
)
_FOUND = "source int, sequence int, place int, query_id bigint, vec_id bigint, score bigint"


def _pack(scale: int):
    """Rows (id, vector, asked) to packed blocks, in the order they come."""

    def one(ids: np.ndarray, missing: np.ndarray, values: np.ndarray, sizes: np.ndarray, asked: np.ndarray, n: int) -> dict:
        runs = math.ceil(int(sizes.max()) / RUN)
        rows = narrow(matrix(values, sizes, runs * RUN))
        places = np.flatnonzero(asked)
        return {
            "source": TaskContext.get().partitionId(),
            "sequence": n,
            "ids": ids.tobytes(),
            "missing": missing.tobytes(),
            "width": rows.itemsize,
            "runs": [np.ascontiguousarray(rows[:, i * RUN : (i + 1) * RUN].T).tobytes() for i in range(runs)],
            "asked": len(places),
            "asked_at": places.astype(np.int32).tobytes(),
            "asked_width": runs * RUN,
            "asked_values": rows[places].astype(np.int64).tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count, made = 0, 0

        def cut() -> pa.RecordBatch:
            ids, missing, values, sizes, asked = (np.concatenate(x) for x in zip(*held, strict=True))
            return pa.RecordBatch.from_pylist([one(ids, missing, values, sizes, asked, made)], _SCHEMA)

        for batch in batches:
            at, values, sizes = whole_numbers(batch.column(1), scale)
            ids = batch.column(0).take(pa.array(at))
            asked = batch.column(2).take(pa.array(at)).to_numpy(zero_copy_only=False)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            start = 0
            while start < len(at):
                stop = min(start + BLOCK_ROWS - count, len(at))
                piece = slice(start, stop)
                held.append((ids[piece], missing[piece], values[ends[start] : ends[stop]], sizes[piece], asked[piece]))
                count += stop - start
                start = stop
                if count == BLOCK_ROWS:
                    yield cut()
                    held, count, made = [], 0, made + 1
        if count:
            yield cut()

    return run


_SCHEMA = pa.schema(
    [
        ("source", pa.int32()),
        ("sequence", pa.int32()),
        ("ids", pa.binary()),
        ("missing", pa.binary()),
        ("width", pa.int32()),
        ("runs", pa.list_(pa.binary())),
        ("asked", pa.int32()),
        ("asked_at", pa.binary()),
        ("asked_width", pa.int32()),
        ("asked_values", pa.binary()),
    ]
)


class _Block:
    """Candidates in vertical layout."""

    def __init__(self, row: dict):
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["width"]]
        self.name = (row["source"], row["sequence"])
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.missing = np.frombuffer(row["missing"], np.bool_)
        self.whole = [np.frombuffer(r, kind).reshape(RUN, len(self.ids)).astype(np.int64) for r in row["runs"]]
        self.runs = [r.astype(np.float64) for r in self.whole]
        self.masses = [(r * r).sum(0) for r in self.runs]
        self.most = max((int(np.abs(r).max()) for r in self.whole), default=0)


class _Queries:
    """The queries of a part with their best candidates so far."""

    def __init__(self, rows: list[dict], k: int):
        self.k = k
        width = max(r["asked_width"] for r in rows)
        self.names, self.ids, values = [], [], []
        for r in rows:
            at = np.frombuffer(r["asked_at"], np.int32)
            self.names += [(r["source"], r["sequence"], int(i)) for i in at]
            self.ids.append(np.frombuffer(r["ids"], np.int64)[at])
            own = np.frombuffer(r["asked_values"], np.int64).reshape(len(at), r["asked_width"])
            values.append(np.pad(own, ((0, 0), (0, width - r["asked_width"]))))
        self.ids = np.concatenate(self.ids)
        self.values = np.concatenate(values)
        self.most = int(np.abs(self.values).max(initial=0))
        self.best: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(self.ids)
        self.floor = np.full(len(self.ids), -np.inf)  # k-th best score
        self.own: dict[tuple, list[tuple[int, int]]] = {}
        for q, (source, sequence, place) in enumerate(self.names):
            self.own.setdefault((source, sequence), []).append((q, place))

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        if len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= least
            scores, ids, missing = scores[keep], ids[keep], missing[keep]
        was = self.best[q]
        scores = np.concatenate([was[0], scores])
        missing, ids = np.concatenate([was[1], missing]), np.concatenate([was[2], ids])
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.best[q] = (scores[order], missing[order], ids[order])
        if len(order) == self.k:
            self.floor[q] = float(scores[order[-1]])

    def see(self, block: _Block) -> None:
        n = len(self.ids)
        width = min(self.values.shape[1], RUN * len(block.runs))
        own = block.name in self.own and dict(self.own[block.name]) or {}
        if width * max(self.most, 1) * max(block.most, 1) >= EXACT:
            self._see_large(block, width, own)
            return
        for low in range(0, n, AT_ONCE):
            self._see_some(block, width // RUN, low, min(low + AT_ONCE, n), own)

    def _see_large(self, block: _Block, width: int, own: dict[int, int]) -> None:
        """Numbers too large for doubles: Python's whole numbers, without bounds."""
        candidates = np.concatenate(block.whole)[:width].astype(object) if width else np.zeros((0, len(block.ids)), object)
        for q in range(len(self.ids)):
            scores = self.values[q, :width].astype(object) @ candidates if width else np.zeros(len(block.ids), object)
            if any(abs(s) > LAST for s in scores):
                raise OverflowError("a score does not fit a long")
            left = np.arange(len(scores)) != own.get(q, -1)
            self.offer(q, scores[left].astype(np.int64), block.ids[left], block.missing[left])

    def _see_some(self, block: _Block, runs: int, low: int, high: int, own: dict[int, int]) -> None:
        rows = self.values[low:high].astype(np.float64)
        parts = [rows[:, i * RUN : (i + 1) * RUN] for i in range(runs)]
        masses = [(p * p).sum(1) for p in parts]
        order = sorted(range(runs), key=lambda i: -masses[i].sum())  # heavy runs first
        mine, theirs = sum(masses, np.zeros(high - low)), sum(block.masses[:runs], np.zeros(len(block.ids)))
        floor = self.floor[low:high]
        columns = np.arange(len(block.ids))
        scores = np.zeros((high - low, len(columns)))
        for q, place in own.items():
            if low <= q < high:
                scores[q - low, place] = -np.inf
        for step, i in enumerate(order):
            scores += parts[i] @ block.runs[i][:, columns]
            mine, theirs = mine - masses[i], theirs - block.masses[i][columns]
            if step + 1 == runs:
                break
            alive = self._alive(scores, np.sqrt(np.outer(mine, theirs)), floor[:, None])
            if np.count_nonzero(alive) < 0.2 * alive.size:
                q, x = np.nonzero(alive)
                self._see_pairs(block, order[step + 1 :], parts, masses, low, q, columns[x], scores[q, x], mine, theirs[x])
                return
            wanted = alive.any(0)
            if np.count_nonzero(wanted) < 0.7 * len(wanted):
                columns, scores, theirs = columns[wanted], scores[:, wanted], theirs[wanted]
        good = (scores >= floor[:, None]) & (scores > -np.inf)
        for q in np.flatnonzero(good.any(1)):
            x = columns[good[q]]
            self.offer(low + q, scores[q, good[q]].astype(np.int64), block.ids[x], block.missing[x])

    @staticmethod
    def _alive(scores: np.ndarray, rest: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Scores are whole, so half a unit covers the rounding of the root and keeps ties."""
        return scores + rest * (1 + 1e-12) >= floor - 0.5

    def _see_pairs(self, block, order, parts, masses, low, q, x, scores, mine, theirs) -> None:
        """The survivors one by one, compacted after each run."""
        floor = self.floor[low : low + len(mine)]
        for i in order:
            scores = scores + np.einsum("pd,dp->p", parts[i][q], block.runs[i][:, x])
            mine, theirs = mine - masses[i], theirs - block.masses[i][x]
            left = self._alive(scores, np.sqrt(np.maximum(mine[q] * theirs, 0)), floor[q])
            q, x, scores, theirs = q[left], x[left], scores[left], theirs[left]
        good = (scores >= floor[q]) & (scores > -np.inf)
        q, x, scores = q[good], x[good], scores[good]
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(q)], strict=True):
            self.offer(low + q[a], scores[a:b].astype(np.int64), block.ids[x[a:b]], block.missing[x[a:b]])

    def found(self) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(self.ids), 1_000):
            rows = [
                (*name, int(own), None if gone else int(i), int(s))
                for name, own, best in zip(self.names[low : low + 1_000], self.ids[low : low + 1_000], self.best[low : low + 1_000], strict=True)
                for s, gone, i in zip(*best, strict=True)
            ]
            if rows:
                kinds = [pa.int32()] * 3 + [pa.int64()] * 3
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _FOUND.split(", ")])


def _search(k: int):
    """Rows in the order (cell, queries first): the best of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, queries = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    if queries is not None:
                        yield from queries.found()
                    cell, waiting, queries = row["cell"], [], None
                if row["kind"] == 0:
                    waiting.append(row)
                    continue
                if queries is None:
                    if not waiting:
                        continue
                    queries, waiting = _Queries(waiting, k), []
                queries.see(_Block(row))
        if queries is not None:
            yield from queries.found()

    return run


def search(vectors: DataFrame, asked: Column, k: int = 10, scale: int = 1024, scratch: Scratch | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every row for which ``asked`` holds.

    ``vectors`` has vec_id and embedding. A row is not a candidate of itself.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    scratch = scratch or Scratch(spark)
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    packed = scratch.save(rows.mapInArrow(releasing(_pack(scale)), _PACKED), "packed")
    facts = packed.agg(F.sum("asked").alias("q"), F.count("*").alias("blocks"), F.max("sequence").alias("longest")).head()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, math.ceil((facts["q"] or 0) / PART_QUERIES))
    groups = max(1, min(facts["blocks"], math.ceil(partitions / parts)))
    number = F.col("source") * F.lit((facts["longest"] or 0) + 1).cast("bigint") + F.col("sequence")
    part, group = F.pmod(F.xxhash64("source", "sequence"), F.lit(parts)), F.pmod(number, F.lit(groups).cast("bigint"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    nothing = F.lit(None).cast("binary")
    queries = packed.where("asked > 0").select(
        part.alias("__part"), every(groups).alias("__group"), F.lit(0).alias("kind"), "source", "sequence", "ids",
        nothing.alias("missing"), "width", F.lit(None).cast("array<binary>").alias("runs"), "asked_at", "asked_width", "asked_values",
    )
    blocks = packed.select(
        every(parts).alias("__part"), group.alias("__group"), F.lit(1).alias("kind"), "source", "sequence", "ids",
        "missing", "width", "runs", nothing.alias("asked_at"), "asked_width", nothing.alias("asked_values"),
    )
    cell = (F.col("__part") * groups + F.col("__group")).cast("int")
    together = queries.unionAll(blocks).withColumn("cell", cell).drop("__part", "__group")
    dealt = together.repartitionById(parts * groups, F.col("cell")).sortWithinPartitions("cell", "kind", "source", "sequence")
    found = dealt.mapInArrow(releasing(_search(k)), _FOUND)
    order = Window.partitionBy("source", "sequence", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
