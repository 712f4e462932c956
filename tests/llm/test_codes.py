import math
import random

import numpy as np
import pytest

from peakloom.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, CODE string, Error int"


def _plain(rows, entries, rounds, parts=4):
    """Codes, errors and final codebooks by looking at every entry."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v in kept), default=0) // parts) * parts
    kept = sorted(((i, v + [0] * (width - len(v))) for i, v in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = width // parts
    books = [[v[p * d : (p + 1) * d] for _, v in kept[:entries]] for p in range(parts)]

    def assign(v, p):
        own = v[p * d : (p + 1) * d]
        return min((sum((a - b) ** 2 for a, b in zip(own, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v in kept:
                groups.setdefault(assign(v, p)[1], []).append(v[p * d : (p + 1) * d])
            new.append([[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])])
        books = new
    out = []
    for i, v in kept:
        found = [assign(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(e for e, _ in found)))
    return sorted(out, key=str), books


def _check(spark, scratch, rows, entries=256, rounds=4):
    df = spark.createDataFrame([(i, v, n % 3 or None, "own", 1) for n, (i, v) in enumerate(rows)], SCHEMA).repartition(3)
    coded, books = codes.compress(df, entries=entries, rounds=rounds, scratch=scratch)
    assert coded.columns == ["vec_id", "label", "code", "error"]
    got = coded.collect()
    want, want_books = _plain(rows, entries, rounds)
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=str) == want
    assert [b.entries.tolist() for b in books] == want_books
    summed = codes.with_group_error(coded, "label", "label_error", scratch).collect()
    totals = {}
    for r in got:
        totals[r.label] = totals.get(r.label, 0) + r.error
    assert len(summed) == len(got) and all(r.label_error == totals[r.label] for r in summed)


def test_odd_rows(spark, scratch):
    nan = float("nan")
    rows = [(3, [0.1, 0.2, -0.3, 0.4, 0.5]), (3, [0.1, 0.2, -0.3, 0.4, 0.5]), (1, [nan] * 5), (2, [None, 1.0]), (4, None), (5, [])]
    rows += [(None, [9.0, 9.0, 9.0, 9.0, 9.0]), (6, [1.0]), (7, [-1e-9] * 5), (0, [float("inf")])]
    _check(spark, scratch, rows)
    _check(spark, scratch, rows, entries=2)
    coded, _ = codes.compress(spark.createDataFrame([(1, None, 1, "", 1)], SCHEMA), scratch=scratch)
    assert coded.columns == ["vec_id", "label", "code", "error"] and coded.count() == 0
    assert codes.with_group_error(coded, "label", "label_error", scratch).count() == 0
    _check(spark, scratch, [(1, []), (2, [])])
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([], SCHEMA), entries=257)


def test_many_ties(spark, scratch):
    draw = random.Random(5)
    rows = [(draw.randrange(400), [draw.randrange(-2, 3) / 1024 for _ in range(8)]) for _ in range(600)]
    _check(spark, scratch, rows, entries=30, rounds=3)


def test_nearest_equals_a_full_search():
    draw = np.random.default_rng(7)
    for spread in (0.2, 3, 300):
        entries = np.floor(draw.standard_normal((256, 16)) * spread + draw.standard_normal((256, 1)) * 40 * spread).astype(np.int64)
        parts = np.floor(draw.standard_normal((700, 16)) * spread + draw.standard_normal((700, 1)) * 40 * spread).astype(np.int64)
        index, distance = codes.nearest(parts, codes._Sorted(codes.Codebook(entries)))
        exact = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (index == exact.argmin(1)).all() and (distance == exact.min(1)).all()


def test_far_entries_are_not_looked_at(monkeypatch):
    """Entries whose sums are far from a part's sum never enter a product."""
    entries = np.arange(256)[:, None] * 1000 + np.arange(16)
    book = codes._Sorted(codes.Codebook(entries))
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            seen.append(np.size(key))
            return np.asarray(self)[key]

    book.entries = book.entries.view(Watched)
    index, _ = codes.nearest(np.array([[128_000] * 16]), book)
    assert index.tolist() == [128] and sum(seen) <= 4 * codes.STEP


def test_numbers_beyond_doubles(spark, scratch):
    rows = [(i, [2e5 * i, -3e5 * i, 1e5, 7e5, 0.0, 1.0, 2e5 + i, 5e5]) for i in range(9)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id bigint, embedding array<double>")
    coded, books = codes.compress(df, entries=3, rounds=2, scratch=scratch)
    want, want_books = _plain(rows, 3, 2)
    assert sorted((tuple(r) for r in coded.collect()), key=str) == want
    assert [b.entries.tolist() for b in books] == want_books
