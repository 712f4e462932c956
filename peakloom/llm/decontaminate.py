"""Benchmark decontamination with a generalised suffix automaton of the test items.

The words of all items make one automaton (online construction, started again at the root for each item).
Training texts are streamed through it; at each word the state tells the longest match that ends there.
A match as long as a window (``window`` words, or a whole shorter item) marks its words as hit.

Only stretches of a text whose neighbouring words stand side by side in some item can hold a window. They are
found on hashes for a whole Arrow batch; the automaton then reads the real words of these stretches.

One automaton holds at most ``BLOCK_WORDS`` item words. More items make more automata, and texts pass through
them one after the other, so what is broadcast has a bound whatever the size of the benchmark. Rows never
move: there is no shuffle, and a hot source or a hot passage costs no more than other rows.

Defined cases: null and empty texts have no words and no hits; null or empty items have no window; an item
without an id goes by the empty name; items with equal windows are all reported; repeated rows are handled one by
one; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.llm.columns import aside
from peakloom.llm.words import ALPHANUMERIC, binary, bound_batches, buffers, groups, mix, releasing, words_of
from peakloom.session import Scratch

BLOCK_WORDS = 200_000
SEPARATOR = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
FOUND = "array<struct<start:bigint,stop:bigint,longest:bigint>>"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text: Column) -> Column:
    """Lower-cased words as an array; null for null."""
    return F.filter(F.split(F.translate(text, *_LOWER), SEPARATOR), lambda w: w != "")


class SuffixAutomaton:
    """All runs of consecutive words of several sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _copy(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, word: int) -> int:
        """The state that ``at`` reaches by ``word``, with no longer member than comes through ``at``."""
        target = self.next[at][word]
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._copy(target, self.length[at] + 1)
        self.link[target] = copy
        while at != -1 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        new, at = len(self.length) - 1, last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at != -1:
            self.link[new] = self._split(at, word)
        return new

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word)

    def read(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """After each word, the state and the length of the longest run of an item that ends there."""
        state = length = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield state, length


class _Members:
    """Membership of hashes: a bitmap of 2^22 prefixes answers nearly all, the rest is looked up."""

    def __init__(self, hashes: np.ndarray):
        self.table = np.unique(hashes)
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[self.table >> np.uint64(42)] = True

    def of(self, values: np.ndarray) -> np.ndarray:
        found = self.bitmap[values >> np.uint64(42)]
        some = np.flatnonzero(found)
        if len(some):
            at = np.minimum(np.searchsorted(self.table, values[some]), len(self.table) - 1)
            found[some] = self.table[at] == values[some]
        return found


class Matcher:
    """Automaton of one block of items, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.ids = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.ids)}
        self.vocabulary: dict[bytes, int] = {}
        sequences = [
            (place[name], [self.vocabulary.setdefault(w.encode(), len(self.vocabulary)) for w in words])
            for name, words in items
            if words
        ]
        self.automaton = SuffixAutomaton()
        for _, sequence in sequences:
            self.automaton.add(sequence)
        self.ends: dict[int, list[tuple[int, set[int]]]] = {}
        for name, sequence in sequences:
            size = min(window, len(sequence))
            for at, (state, _) in enumerate(self._trace(sequence, size)):
                if at + 1 < size:
                    continue
                known = self.ends.setdefault(state, [])
                for length, names in known:
                    if length == size:
                        names.add(name)
                        break
                else:
                    known.append((size, {name}))
        self.upper = [0] * len(self.automaton.length)  # nearest state at or above with a window
        for state in sorted(range(1, len(self.upper)), key=self.automaton.length.__getitem__):
            self.upper[state] = state if state in self.ends else self.upper[self.automaton.link[state]]
        self.shortest = min((min(window, len(s)) for _, s in sequences), default=0)
        listed = b" ".join(self.vocabulary)
        data = np.frombuffer(listed, np.uint8)
        hashes = words_of(data, np.array([0, len(data)], np.int64), ALPHANUMERIC).hashes
        pairs = {(a, b) for _, s in sequences for a, b in zip(s, s[1:], strict=False)}
        left, right = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
        self.known = _Members(hashes)
        self.pairs = _Members(mix(hashes[left] * np.uint64(3) + hashes[right]) if pairs else np.zeros(0, np.uint64))

    def _trace(self, sequence: list[int], size: int) -> Iterator[tuple[int, int]]:
        """The state of the last ``size`` words at each place."""
        automaton = self.automaton
        for state, length in automaton.read(sequence):
            if length > size:
                while automaton.length[automaton.link[state]] >= size:
                    state = automaton.link[state]
            yield state, length

    def stretches(self, words) -> list[tuple[int, int, int]]:
        """(row, first word, end) of the stretches that can hold a window."""
        n = len(words.hashes)
        if not n or not self.shortest:
            return []
        row_start = np.zeros(n, bool)
        row_start[words.first[:-1][np.diff(words.first) > 0]] = True
        if self.shortest == 1:
            member = self.known.of(words.hashes)
            joined = np.zeros(n, bool)
            joined[1:] = member[1:] & member[:-1] & ~row_start[1:]
        else:
            joined = np.zeros(n, bool)
            joined[1:] = self.pairs.of(mix(words.hashes[:-1] * np.uint64(3) + words.hashes[1:])) & ~row_start[1:]
            member = joined.copy()
            member[:-1] |= joined[1:]
        begin = np.flatnonzero(member & ~joined)
        end = np.flatnonzero(member & ~np.append(joined[1:], False)) + 1
        long = end - begin >= self.shortest
        begin, end = begin[long], end[long]
        rows = np.searchsorted(words.first, begin, side="right") - 1
        return list(zip(rows.tolist(), begin.tolist(), end.tolist(), strict=True))

    def hits(self, sequence: list[int]) -> Iterator[tuple[int, int, int, set[int]]]:
        """(first word, end, longest match, items) of each window found."""
        for at, (state, length) in enumerate(self.automaton.read(sequence), 1):
            state = self.upper[state]
            while state:
                for size, names in self.ends[state]:
                    if size <= length:
                        yield at - size, at, length, names
                state = self.upper[self.automaton.link[state]]


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop, longest in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
            out[-1][2] = max(out[-1][2], longest)
        else:
            out.append([start, stop, longest])
    return out


def _search(matcher: Matcher, column: pa.Array) -> dict[str, list]:
    """For each text: its word count, merged hit spans and items."""
    data, offsets = buffers(column)
    counts, spans, items = [], [], []
    unknown = len(matcher.vocabulary)
    for low, high in groups(offsets):
        words = words_of(data, offsets[low : high + 1], ALPHANUMERIC)
        counts += np.diff(words.first).tolist()
        found: dict[int, tuple[list, set]] = {}
        for row, begin, end in matcher.stretches(words):
            sequence = [matcher.vocabulary.get(words.text(i).lower(), unknown) for i in range(begin, end)]
            base = begin - int(words.first[row])
            for start, stop, longest, names in matcher.hits(sequence):
                own, all_names = found.setdefault(row, ([], set()))
                if own and own[-1][0] <= base + start <= own[-1][1]:
                    own[-1][1:] = [max(own[-1][1], base + stop), max(own[-1][2], longest)]
                else:
                    own.append([base + start, base + stop, longest])
                all_names |= names
        for row in range(high - low):
            own, names = found.get(row, ([], set()))
            own = _merged(own)
            spans.append(own)
            items.append([matcher.ids[i] for i in sorted(names)])
    return {"n_words": counts, "spans": spans, "items": items}


def _without(words, bounds: np.ndarray, first: int, spans: list[list[int]]) -> str:
    """The text without the spans; a span goes with what follows it up to the next word."""
    out, at, stop = [], int(bounds[0]), int(bounds[1])
    for start, end, _ in spans:
        out.append(words.data[at : words.begin[first + start]].tobytes())
        after = first + end
        at = int(words.begin[after]) if after < len(words.begin) and words.begin[after] < stop else stop
    out.append(words.data[at:stop].tobytes())
    return b"".join(out).decode()


def _matchers(items: DataFrame, window: int) -> Iterator[Matcher]:
    """One matcher after the other, each of a bounded number of item words.

    An item of more words than fit is cut into overlapping parts, which hold all its windows.
    """
    part = max(window, BLOCK_WORDS // 2)
    words = word_list(F.col("text"))
    parts = (
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words.alias("words"))
        .where(F.size("words") > 0)
        .select(
            "item_id",
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.greatest(F.size("words") - F.lit(window), F.lit(0)), F.lit(part)),
                    lambda i: F.slice("words", i + 1, F.lit(part + window - 1)),
                )
            ).alias("words"),
        )
    )
    block: list[tuple[str, list[str]]] = []
    size = 0
    for row in parts.toLocalIterator():
        if block and size + len(row.words) > BLOCK_WORDS:
            yield Matcher(block, window)
            block, size = [], 0
        block.append((row.item_id, list(row.words)))
        size += len(row.words)
    if block:
        yield Matcher(block, window)


_HIDDEN = ("__n_words", "__spans", "__items")


def match_items(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (hit word ranges, each with its longest match) and ``items``."""
    spark = docs.sparkSession
    bound_batches(spark)
    schema = T.StructType([*docs.schema.fields, *_fields(spark)])
    out, scratch = None, None
    for matcher in _matchers(items, window):
        shared = spark.sparkContext.broadcast(matcher)
        if out is not None:
            scratch = scratch or Scratch(spark)
            out = scratch.save(out, "matched")
        out = (out if out is not None else docs).mapInArrow(releasing(_pass(shared, out is not None)), schema)
    if out is None:
        words = F.coalesce(F.size(word_list(F.col("text"))), F.lit(0))
        out = docs.withColumns(
            {
                _HIDDEN[0]: F.when(F.col("text").isNull(), 0).otherwise(words).cast("long"),
                _HIDDEN[1]: F.from_json(F.lit("[]"), FOUND),
                _HIDDEN[2]: F.array().cast("array<string>"),
            }
        )
    return out


def _fields(spark) -> list[T.StructField]:
    found = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "stop", "longest")]))
    return [
        T.StructField(_HIDDEN[0], T.LongType()),
        T.StructField(_HIDDEN[1], found),
        T.StructField(_HIDDEN[2], T.ArrayType(T.StringType())),
    ]


_ARROW = (
    pa.int64(),
    pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("longest", pa.int64())])),
    pa.list_(pa.string()),
)


def _pass(shared, again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _search(shared.value, binary(batch.column("text")))
            spans, items = found["spans"], found["items"]
            if again:
                old = batch.column(_HIDDEN[1]).to_pylist()
                spans = [_merged([*new, *([x["start"], x["stop"], x["longest"]] for x in was)]) for new, was in zip(spans, old, strict=True)]
                items = [sorted({*new, *was}) for new, was in zip(items, batch.column(_HIDDEN[2]).to_pylist(), strict=True)]
                batch = batch.drop_columns(list(_HIDDEN))
            spans = [[dict(zip(("start", "stop", "longest"), s, strict=True)) for s in own] for own in spans]
            new = [pa.array(v, t) for v, t in zip((found["n_words"], spans, items), _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *_HIDDEN])

    return run


def report(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per document: words, hit words, longest match, items with windows in it, and whether there is any."""
    found = match_items(docs.select("doc_id", "text"), items, window)
    n_words, spans, names = (F.col(c) for c in _HIDDEN)
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        n_words.alias("n_words"),
        hit.alias("n_hit"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["longest"])), F.lit(0)).cast("long").alias("longest_match"),
        F.array_sort(names).alias("items"),
    )


def clean(
    docs: DataFrame, items: DataFrame, window: int = 10, max_span: int | None = None, max_coverage: float = 0.5
) -> DataFrame:
    """``docs`` without benchmark passages.

    Hit spans are cut from the text. A document goes as a whole if hit words make more than ``max_coverage`` of
    its words, or if a match is longer than ``max_span`` words (None: no such limit). ``n_chars``, where there
    is such a column, follows the text. Documents without hits are unchanged.
    """
    docs, own = aside(docs, *_HIDDEN)
    found = match_items(docs, items, window)
    n_words, spans, _ = (F.col(c) for c in _HIDDEN)
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    gone = hit > max_coverage * n_words
    if max_span is not None:
        gone = gone | (F.coalesce(F.array_max(F.transform(spans, lambda s: s["longest"])), F.lit(0)) > max_span)
    left = found.where(~gone)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _cut_batch(batch)

    cleaned = left.mapInArrow(releasing(cut), left.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.size(_HIDDEN[1]) > 0
        cleaned = cleaned.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cleaned.select(*own)


def _cut_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    at = batch.schema.get_field_index("text")
    spans = batch.column(_HIDDEN[1]).to_pylist()
    rows = [i for i, own in enumerate(spans) if own]
    if not rows:
        return batch
    texts = batch.column(at).to_pylist()
    for i in rows:
        data = texts[i].encode()
        bounds = np.array([0, len(data)], np.int64)
        words = words_of(np.frombuffer(data, np.uint8), bounds, ALPHANUMERIC)
        texts[i] = _without(words, bounds, 0, [[s["start"], s["stop"], s["longest"]] for s in spans[i]])
    return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
