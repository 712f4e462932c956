import random

import cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from peakloom.llm import decontaminate

SCHEMA = "doc_id bigint, text string, n_chars bigint, spans string"
ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away"),
    (2, "short item"),
    (3, None),
    (4, ""),
    (5, "the QUICK brown fox jumps over the lazy dog and runs, far away"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"),
    (None, "unnamed words here"),
]


def _texts():
    draw = random.Random(3)
    pool = [w for _, t in ITEMS for w in cases.words(t)] + ["other", "straße", "x1"]
    texts = [None, "", "!!!", "a " * 30_000, "quick brown fox jumps over the lazy dog and runs"]
    texts += ["Lead. " + (ITEMS[0][1] + ", ") * 2 + "tail short, ITEM end", "short-item", "unnamed words here"]
    texts += [" ".join(draw.choice(pool) for _ in range(60)) for _ in range(20)]
    texts += [" ".join(cases.words(ITEMS[5][1])[1:12]) + " other " + " ".join(cases.words(ITEMS[5][1])[:9])]
    return texts + texts[5:7]


@pytest.mark.parametrize("block", [200_000, 12])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    texts = _texts()
    docs = spark.createDataFrame([(i, t, None, "own") for i, t in enumerate(texts)], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    named = [x for x in ITEMS if x[0] is not None]
    found = {r.doc_id: r for r in decontaminate.report(docs, items).collect()}
    known = cases.windows(named, 10)
    unnamed = cases.windows([ITEMS[-1]], 10)
    for i, text in enumerate(texts):
        n, hit, names = cases.contamination(text, known)
        _, more, _ = cases.contamination(text, unnamed)
        row = found[i]
        assert (row.n_words, row.n_hit) == (n, len(hit | more)), text
        assert row["items"] == sorted(names | ({""} if more else set()))


def test_cleaning_cuts_spans_and_keeps_the_rest(spark):
    item = ITEMS[0][1]
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    rows = [
        (1, f"{long}. {item}! {long}", 5, "a"),
        (2, item, 1, "b"),
        (3, "clean  text\n", 12, None),
        (4, None, None, None),
        (5, "", 0, ""),
        (1, f"{long}. {item}! {long}", 5, "a"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    items = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    out = decontaminate.clean(docs, items)
    assert out.columns == docs.columns
    kept = [tuple(r) for r in out.orderBy("doc_id").collect()]
    text = f"{long}. {long}"
    assert kept == [(1, text, len(text), "a"), (1, text, len(text), "a"), *rows[2:5]]
    assert decontaminate.clean(docs, items, max_span=5).count() == 3


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words", 3, "x")], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    none = items.where("item_id = 99")
    assert decontaminate.report(docs.where("false"), items).count() == 0
    row = decontaminate.report(docs, none).head()
    assert (row.n_words, row.n_hit, row["items"]) == (2, 0, [])
    assert decontaminate.clean(docs, none).collect() == docs.collect()


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=9), min_size=1, max_size=5),
    st.lists(st.integers(0, 4), max_size=25),
)
def test_automaton_tells_the_longest_match(items, text):
    automaton = decontaminate.SuffixAutomaton()
    for item in items:
        automaton.add(item)
    runs = {tuple(x[i:j]) for x in items for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    for end, (_, length) in enumerate(automaton.read(text), 1):
        assert length == max((n for n in range(end + 1) if tuple(text[end - n : end]) in runs), default=0)
