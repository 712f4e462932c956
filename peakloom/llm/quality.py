"""Quality classifier: Naive Bayes support vectors on n-gram indicators.

Tokens are runs of letters and digits, and runs of other visible characters, case kept. A document's indicators are
its distinct tokens, pairs of neighbouring tokens, and runs of three token shapes (letter case at either end, sign,
whether the token repeats the one before), hashed to 2^18 features. Each indicator is scaled by the log-count ratio
of its feature between the two classes; features of very few training rows get the scale 0. A linear model with
hinge loss is fitted on them by dual coordinate descent. A logistic curve through the training margins, weighted so
that both classes count alike, turns margins into scores.

Fitting takes a bounded sample of the labelled rows, drawn by hash: at most ``SAMPLE_ROWS`` rows and at most
``SAMPLE_ENTRIES`` indicators, which bounds what reaches the driver. The model is one vector of 2^18 weights.
Scoring reads every row whole, in one pass without a shuffle.

Defined cases: null and empty texts have no indicators and get the score of the intercept; without labelled rows
of both classes all scores are 0.5; of rows that repeat a doc_id, each is scored; labels of a doc_id that is
missing in the documents, and null labels, are not used; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from peakloom.llm.columns import without
from peakloom.llm.words import BYTE_VALUES, SPACED, Classes, binary, bound_batches, byte_classes, buffers, groups, mix, releasing, words_of

BITS = 18
SAMPLE_ROWS = 8_000
SAMPLE_ENTRIES = 15_000_000
EPOCHS = 12
COST = 0.1
SMOOTHING = 1.0
LEAST_SHARE, LEAST_ROWS = 0.001, 3  # share and number of training rows that a feature must stand in
_WORD = byte_classes(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), keep_case=True)
_SIGN = Classes(SPACED.member & ~_WORD.member, BYTE_VALUES)


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text of a binary column without nulls."""
    data, offsets = buffers(column)
    last = np.zeros(1 << BITS, np.int64)
    for low, high in groups(offsets):
        bounds = offsets[low : high + 1]
        parts = [words_of(data, bounds, c) for c in (_WORD, _SIGN)]
        begin = np.concatenate([p.begin for p in parts])
        order = np.argsort(begin, kind="stable")
        hashes = np.concatenate([p.hashes for p in parts])[order]
        first = parts[0].first + parts[1].first
        order_end = np.concatenate([p.end for p in parts])[order]
        first = parts[0].first + parts[1].first
        lists = _grams(data, begin[order], order_end, hashes, order < len(parts[0].hashes), first)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            features = np.concatenate([x[a : max(b - size, a)] for size, x in enumerate(lists)])
            place = np.arange(len(features))
            last[features] = place
            yield features[last[features] == place]


def _grams(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray, word: np.ndarray, first: np.ndarray
) -> list[np.ndarray]:
    """Features of the tokens, of pairs, and of runs of three shapes, each at the place where it begins."""
    shift = np.uint64(64 - BITS)
    if len(hashes) < 3:
        hashes = np.concatenate([hashes, np.zeros(3, np.uint64)])
        begin, end, word = (np.concatenate([x, np.zeros(3, x.dtype)]) for x in (begin, end, word))
        data = data if len(data) else np.zeros(1, np.uint8)
    upper = (data >= 65) & (data <= 90)
    shape = (upper[begin] * 2 + upper[end - 1] * 4 + (end - begin > 1) * 8 + 1).astype(np.uint64)
    shape = np.where(word, shape, hashes)
    again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    again[first[:-1][first[:-1] < len(again)]] = False  # the first token of a text follows none
    shape = shape + again * np.uint64(0x51ED27)
    pairs = mix(hashes[:-1] * np.uint64(5) + hashes[1:])
    triples = mix(mix(shape[:-2] * np.uint64(7) + shape[1:-1]) * np.uint64(9) + shape[2:])
    return [(x >> shift).astype(np.int64) for x in (hashes, pairs, triples)]


@dataclass
class Model:
    """Weights of the scaled indicators, already multiplied by the scale, and the logistic curve."""

    weights: np.ndarray
    intercept: float = 0.0
    slope: float = 0.0
    shift: float = 0.0

    def scores(self, column: pa.Array) -> np.ndarray:
        margins = np.array([self.weights[x].sum() + self.intercept for x in indicators(column)])
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _descend(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Hinge loss with an L2 penalty, by dual coordinate descent; the intercept is a constant feature."""
    weights, intercept = np.zeros(len(scale)), 0.0
    squares = np.array([(scale[x] ** 2).sum() + 1 for x in rows])
    weight_of = {1: 0.5 * len(rows) / max((signs > 0).sum(), 1), -1: 0.5 * len(rows) / max((signs < 0).sum(), 1)}
    most = np.array([COST * weight_of[int(s)] for s in signs])
    dual = np.zeros(len(rows))
    draw = np.random.default_rng(11)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            x, sign = rows[i], signs[i]
            v = scale[x]
            gradient = sign * (weights[x] @ v + intercept) - 1
            new = min(max(dual[i] - gradient / squares[i], 0.0), most[i])
            step = (new - dual[i]) * sign
            if step:
                dual[i] = new
                weights[x] += step * v
                intercept += step
                moved = max(moved, abs(step) * squares[i])
        if moved < 1e-3:
            break
    return weights, intercept


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins, with classes of equal weight and soft targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(good, 0.5 / n1, 0.5 / n0)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p)
        hessian = np.array([[(h * margins**2).sum() + 1e-6, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hessian, [(g * margins).sum(), g.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def fit(rows: list[np.ndarray], good: list[bool]) -> Model:
    """A model from indicators and labels; all scores are 0.5 if a class is missing."""
    labels = np.array(good, bool)
    if not len(rows) or labels.all() or not labels.any():
        return Model(np.zeros(1 << BITS))
    counts = [np.full(1 << BITS, SMOOTHING), np.full(1 << BITS, SMOOTHING)]
    for x, label in zip(rows, labels, strict=True):
        counts[int(label)][x] += 1
    common = counts[0] + counts[1] - 2 * SMOOTHING >= max(LEAST_ROWS, LEAST_SHARE * len(rows))
    scale = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    scale[~common] = 0
    weights, intercept = _descend(rows, np.where(labels, 1, -1), scale)
    weights *= scale
    margins = np.array([weights[x].sum() + intercept for x in rows])
    return Model(weights, intercept, *_logistic(margins, labels))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", usable=None) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id and a 0/1 column); ``usable`` is a condition on its rows."""
    bound_batches(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x.astype("<u4").tobytes() for x in indicators(binary(batch.column("text")))]
            sizes = [len(x) // 4 for x in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(sizes, pa.int64()), pa.array(lists, pa.binary())],
                names=["doc_id", "label", "n", "features"],
            )

    # at most SAMPLE_ROWS pairs of numbers, so the broadcast has a bound
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}
    chosen = chosen.mapInArrow(releasing(run), f"doc_id {kinds['doc_id']}, label {kinds['label']}, n bigint, features binary")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "features")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(SAMPLE_ROWS)
    bounded = chosen.withColumn("total", F.sum("n").over(order)).where(F.col("total") <= SAMPLE_ENTRIES)
    rows, good = [], []
    for row in bounded.select("label", "features").toLocalIterator():
        rows.append(np.frombuffer(row.features, "<u4"))
        good.append(row.label == 1)
    return fit(rows, good)


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: a third, by the CRC of the doc_id as text."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; higher means that label 1 is likelier.

    A column called ``name`` already, in whatever case, is replaced.
    """
    bound_batches(docs.sparkSession)
    docs = without(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.scores(binary(batch.column("text"))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(releasing(run), schema)
