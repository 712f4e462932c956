import random

import cases
import pytest

from peakloom.llm import neardup
from peakloom.llm.stars import components
from peakloom.session import Scratch

SCHEMA = "doc_id bigint, text string, digest string, n_chars bigint"


def _edited(draw, words, share):
    return [draw.choice(["red", "blue", "x%d" % draw.randint(0, 999)]) if draw.random() < share else w for w in words]


def _corpus():
    """Two families of near copies at all distances, chains, copies, and awkward texts."""
    draw = random.Random(9)
    texts = [None, "", " \n\t", "one two", "One TWO", "one", "\x00 \x1f", "word " * 20_000]
    for family in range(2):
        base = [f"f{family}w{draw.randint(0, 5000)}" for _ in range(160)]
        texts += [" ".join(_edited(draw, base, share)) for share in (0, 0.005, 0.01, 0.02, 0.03, 0.05) for _ in range(8)]
    chain = [f"c{i}" for i in range(100)]
    for step in range(12):
        texts.append(" ".join(chain))
        chain = [*chain[:step * 6], *[f"n{step}_{i}" for i in range(3)], *chain[step * 6 + 3 :]]
    texts += texts[3:20]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 85, 800), (5, 80, 7)])
def test_against_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", block)
    texts = _corpus()
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    found = {r.doc_id: r for r in neardup.near_duplicates(docs, k, percent).collect()}
    sets = {i: cases.shingles(t, k) for i, t in enumerate(texts)}
    expected = cases.components(sets, percent)
    assert len(found) == len(texts)
    assert len(set(expected.values())) < len(texts) - 40
    for i in sets:
        row = found[i]
        assert (row.n_shingles, row.component_id, row.kept) == (len(sets[i]), expected[i], expected[i] == i), texts[i]


def test_one_of_each_with_repeated_and_nameless_rows(spark):
    text = "a b c d e f g h"
    rows = [(2, text, "x", 1), (2, text, "x", 1), (1, text.upper(), "y", 1), (None, text, "z", 1), (None, None, None, None), (4, "", "e", 0), (7, "p q r s t u", "r", 1), (7, "p q r s t u", "r", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = neardup.one_of_each(docs)
    assert out.columns == docs.columns
    kept = sorted(map(tuple, out.collect()), key=str)
    assert kept == sorted([rows[2], rows[3], rows[4], rows[5], rows[6]], key=str)
    assert neardup.one_of_each(docs.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(200, 260)] + [(0, i) for i in range(1, 90)] + [(5, 5), (300, 301), (300, 301)]
    edges += [(draw.randint(400, 460), draw.randint(400, 460)) for _ in range(50)]
    draw.shuffle(edges)
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    scratch = Scratch(spark)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "left bigint, right bigint"), scratch).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    scratch.clear()


@pytest.mark.parametrize("bits", [1 << 6, 1 << 25])
def test_rows_without_some_ids(spark, monkeypatch, bits):
    """A full bitmap moves more rows and drops the same."""
    monkeypatch.setattr(neardup, "BITMAP", bits)
    ids = [None, None, -5, 0, 1 << 60, *range(1, 400), 7, 8]
    docs = spark.createDataFrame([(i, "own") for i in ids], "doc_id bigint, places string").repartition(5)
    for gone in ([], [-5, 7, 1 << 60, 12345], list(range(0, 400, 2))):
        table = spark.createDataFrame([(i,) for i in gone], "doc_id bigint")
        got = sorted((r.doc_id for r in neardup._without(docs, table).collect()), key=str)
        assert got == sorted((i for i in ids if i not in gone), key=str)
