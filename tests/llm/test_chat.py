import cases  # noqa: F401
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peakloom.llm import chat

SCHEMA = "tree bigint, id bigint, parent bigint, role string, text string, score double"


def _read(made):
    return made.select(
        "tree", "leaf", "rank", "score", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("learnt"),
    )


def test_branches_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "good", 0.9),
        (1, 3, 1, "assistant", "bad", 0.1),
        (1, 4, 2, "user", None, 0.5),
        (1, 5, 4, "assistant", "end <|im_end|>\n", 0.5),
        (1, 6, 4, "assistant", "tie", 0.5),
        (2, 1, 99, "user", "its parent is missing", None),
        (2, 7, None, "assistant", "alone", 1.0),
        (None, 1, None, "user", "no tree", 0.0),
        (3, 1, 2, "user", "cycle", 0.0),
        (3, 2, 1, "user", "cycle", 0.0),
    ]
    trees = spark.createDataFrame([r for r in rows if r[0] is not None], SCHEMA)
    got = {(r.tree, r.leaf): r for r in _read(chat.conversations(trees)).collect()}
    assert sorted(got) == [(1, 3), (1, 5), (1, 6), (2, 1), (2, 7)]
    assert [t.text for t in got[1, 5].turns] == ["q", "good", "", "end <|im_end|>\n"]
    assert got[1, 5].learnt == "goodend <|im_end|>\n" and got[1, 3].learnt == "bad" and got[2, 1].learnt == ""
    assert got[1, 5].formatted.count("<|im_end|>") == 4
    best = {(r.tree, r.leaf): r.rank for r in chat.conversations(trees, best=1).collect()}
    assert best == {(1, 5): 1, (2, 7): 1}
    assert chat.conversations(trees.where("false")).count() == 0
    hanging = spark.createDataFrame([*rows[-2:], (3, 3, 1, "user", "leaf", 0.0)], SCHEMA)
    with pytest.raises(ValueError, match="cycle"):
        chat.conversations(hanging)


def test_a_long_chain_needs_few_rounds(spark):
    rows = [(1, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"t{i}", 0.0) for i in range(400)]
    row = _read(chat.conversations(spark.createDataFrame(rows, SCHEMA))).head()
    assert [t.text for t in row.turns] == [f"t{i}" for i in range(400)]
    assert row.learnt == "".join(f"t{i}" for i in range(1, 400, 2))


def test_flat_conversations_with_awkward_rows(spark):
    rows = [
        (1, 2, "assistant", "b"), (1, 1, "user", None), (1, 1, "user", None), (2, None, None, "x"),
        (3, 0, "a%0A\nb<|", "<|im_start|>assistant\n"), (4, 0, "assistant", "<\\\\| <\\| <| \\"), (5, 0, "assistant", "long " * 50_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.tree: r for r in _read(chat.conversations(chat.chain(turns))).collect()}
    read = {k: [(t.role, t.text) for t in r.turns] for k, r in got.items()}
    assert read == {
        1: [("user", ""), ("user", ""), ("assistant", "b")],
        2: [("", "x")],
        3: [("a%0A\nb<|", "<|im_start|>assistant\n")],
        4: [("assistant", "<\\\\| <\\| <| \\")],
        5: [("assistant", "long " * 50_000)],
    }
    assert got[4].learnt == "<\\\\| <\\| <| \\" and got[3].learnt == ""


@pytest.fixture(scope="module")
def round_trip(spark):
    def run(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        text, role = chat.escaped(F.col("t")), chat.escaped_role(F.col("t"))
        return df.select("t", text.alias("e"), chat.unescaped(text).alias("u"), role.alias("r"), chat.unescaped_role(role).alias("w")).collect()

    return run


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<|\\ >im_%0A25\nü😀", max_size=14), min_size=20, max_size=40))
def test_escapes_are_reversible(round_trip, texts):
    for row in round_trip(texts):
        assert row.u == row.t == row.w
        assert "<|" not in row.e and "<|" not in row.r and "\n" not in row.r
