"""License scans by template markup.

A template is license text with marked regions: ``<<optional>> ... <</optional>>`` may be left out, ``<<any:n>>`` stands
for up to n words of any wording. Templates are compiled to automata over words: a set of states, moves by a word,
moves by any word, and moves without one. A text is accepted where its mandatory wording matches word for word,
wherever in the text that begins. Plain phrases give the base labels and need no automaton.

Words of a whole Arrow batch are hashed at once. A place is looked at only if the word there begins a phrase or a
template and the next one fits too; the automaton then reads the real words from that place. Rows never move, and
templates are a fixed small list.

Defined cases: null and empty texts have no words, no labels and the score 0; repeated rows are handled one by one;
other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peakloom.llm.columns import without
from peakloom.llm.words import ALPHANUMERIC, Words, binary, bound_batches, buffers, groups, releasing, words_of

# Phrases with their labels, and templates with theirs.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "mit": "released under <<optional>>the terms of<</optional>> the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "<<optional>>and associated documentation files the software<</optional>> to deal in <<any:3>> without restriction",
    "apache-2.0": "licensed under the apache license <<optional>>version<</optional>> 2 0",
    "gpl-3.0": "<<optional>>this <<any:3>> is<</optional>> licensed under the gnu general public license version 3",
    "gpl-2.0": "<<optional>>this <<any:3>> is<</optional>> licensed under the gnu general public license version 2",
    "cc-by-4.0": "licensed under <<optional>>a<</optional>> cc by <<optional>>license<</optional>> 4 0",
    "cc-by-nc-4.0": "licensed under <<optional>>a<</optional>> cc by nc <<optional>>license<</optional>> 4 0",
    "cc-by-sa-4.0": "licensed under <<optional>>a<</optional>> cc by sa <<optional>>license<</optional>> 4 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
}
_MARK = re.compile(r"<<(/?optional|any:\d+)>>|([^\s<]+)")


class Automaton:
    """States 0 to ``end``; ``words`` moves by a certain word, ``wild`` by any word, ``free`` by none."""

    def __init__(self, template: str):
        self.words: dict[int, dict[bytes, set[int]]] = {}
        self.wild: dict[int, set[int]] = {}
        self.free: dict[int, set[int]] = {}
        self.mandatory = 0
        state, opened = 0, []
        for mark, word in _MARK.findall(template):
            if word:
                self.words.setdefault(state, {}).setdefault(word.lower().encode(), set()).add(state + 1)
                self.mandatory += not opened
                state += 1
            elif mark == "optional":
                opened.append(state)
            elif mark == "/optional":
                self.free.setdefault(opened.pop(), set()).add(state)
            else:
                count = int(mark[4:])
                for i in range(count):
                    self.wild.setdefault(state + i, set()).add(state + i + 1)
                    self.free.setdefault(state + i, set()).add(state + count)
                state += count
        if opened:
            raise ValueError(f"an optional region is not closed: {template}")
        self.end = state

    def closed(self, states: set[int]) -> set[int]:
        out, todo = set(states), list(states)
        while todo:
            for target in self.free.get(todo.pop(), ()):
                if target not in out:
                    out.add(target)
                    todo.append(target)
        return out

    def step(self, states: set[int], word: bytes) -> set[int]:
        out: set[int] = set()
        for state in states:
            out |= self.words.get(state, {}).get(word, set()) | self.wild.get(state, set())
        return self.closed(out)

    def starters(self) -> set[bytes] | None:
        """Words that can come first; None for any."""
        states = self.closed({0})
        if any(self.wild.get(s) for s in states) or self.end in states:
            return None
        return {w for s in states for w in self.words.get(s, {})}

    def accepts(self, words: Iterator[bytes]) -> bool:
        """Whether some beginning of ``words`` matches."""
        states = self.closed({0})
        for word in words:
            if self.end in states:
                return True
            states = self.step(states, word)
            if not states:
                return False
        return self.end in states

    def pattern(self) -> str:
        """The same language as a regular expression over words that each end in a blank."""

        def build(state: int, stop: int) -> str:
            out = ""
            while state < stop:
                jump = max((t for t in self.free.get(state, ()) if t <= stop), default=None)
                if jump is not None:
                    inner = {k: self.free.pop(k) for k in [state]}
                    out += "(?:" + build(state, jump) + ")?"
                    self.free.update(inner)
                    state = jump
                elif state in self.words:
                    (word,) = self.words[state]
                    out += re.escape(word.decode()) + " "
                    state += 1
                else:
                    out += "[^ ]+ "
                    state += 1
            return out

        return build(0, self.end)


class Scanner:
    """Phrases and templates over the words of texts."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(tuple(p.encode() for p in phrase.split()), label) for phrase, label in phrases.items()]
        self.templates = {label: Automaton(text) for label, text in templates.items()}
        self.longest = max((len(p) for p, _ in self.phrases), default=1)
        self.begun: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, automaton in self.templates.items():
            first = automaton.starters()
            if first is None:
                raise ValueError(f"template {label} does not begin with a word")
            for word in first:
                self.begun.setdefault(word, []).append((label, automaton))
        starts = {p[0] for p, _ in self.phrases} | set(self.begun)
        listed = b" ".join(sorted(starts))
        data = np.frombuffer(listed, np.uint8)
        self.starts = np.unique(words_of(data, np.array([0, len(data)], np.int64), ALPHANUMERIC).hashes)

    def scan(self, column: pa.Array) -> list[tuple]:
        """For each text: words, places of phrases, first and last of them, phrase labels, template labels, score."""
        data, offsets = buffers(column)
        out: list[tuple] = []
        for low, high in groups(offsets):
            words = words_of(data, offsets[low : high + 1], ALPHANUMERIC)
            at = np.minimum(np.searchsorted(self.starts, words.hashes), len(self.starts) - 1)
            places = np.flatnonzero(self.starts[at] == words.hashes)
            bounds = np.searchsorted(places, words.first)
            for row in range(high - low):
                own = places[bounds[row] : bounds[row + 1]]
                out.append(self._row(words, int(words.first[row]), int(words.first[row + 1]), own.tolist()))
        return out

    def _row(self, words: Words, first: int, stop: int, places: list[int]) -> tuple:
        base: set[str] = set()
        own: set[str] = set()
        count, smallest, largest = 0, None, None
        for place in places:
            ahead = [words.text(i).lower() for i in range(place, min(place + self.longest, stop))]
            for phrase, label in self.phrases:
                if tuple(ahead[: len(phrase)]) == phrase:
                    base.add(label)
                    count += 1
                    smallest = place - first if smallest is None else smallest
                    largest = place - first
            for label, automaton in self.begun.get(ahead[0], ()):
                if label not in own and automaton.accepts(words.text(i).lower() for i in range(place, stop)):
                    own.add(label)
        # full wording counts 1; a phrase alone 0.5; nothing 0
        score = 1.0 if own else 0.5 if base else 0.0
        return stop - first, count, smallest, largest, sorted(base), sorted(base | own), score


@lru_cache(maxsize=1)
def _default_scanner() -> Scanner:
    return Scanner(PHRASES, TEMPLATES)


_FIELDS = [
    ("n_words", T.LongType(), pa.int64()),
    ("n_base", T.LongType(), pa.int64()),
    ("first_word", T.LongType(), pa.int64()),
    ("last_word", T.LongType(), pa.int64()),
    ("base", T.ArrayType(T.StringType()), pa.list_(pa.string())),
    ("all", T.ArrayType(T.StringType()), pa.list_(pa.string())),
    ("score", T.DoubleType(), pa.float64()),
]


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``license``: word and phrase counts, places, labels and score.

    A column that is called so already, in whatever case, is replaced.
    """
    bound_batches(docs.sparkSession)
    docs = without(docs, "license")
    struct = T.StructType([T.StructField(n, t) for n, t, _ in _FIELDS])
    schema = T.StructType([*docs.schema.fields, T.StructField("license", struct)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _default_scanner().scan(binary(batch.column("text")))
            columns = list(zip(*rows, strict=True)) or [[]] * len(_FIELDS)
            arrays = [pa.array(list(c), kind) for c, (_, _, kind) in zip(columns, _FIELDS, strict=True)]
            found = pa.StructArray.from_arrays(arrays, names=[n for n, _, _ in _FIELDS])
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "license"])

    return docs.mapInArrow(releasing(run), schema)
