import numpy as np
from pyspark.sql import functions as F

from peakloom.llm import quality

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.learn(docs, labels, usable=~quality.held_out(F.col("doc_id")))
    scored = quality.score(docs, model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id")))
    rows = scored.select("score", "quality").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in rows)
    assert len(rows) > 80 and right / len(rows) > 0.95


def test_awkward_rows(spark):
    rows = [(1, "good words here", "s"), (2, "BAD!! BAD!!", "s"), (3, None, "s"), (4, "", None), (5, "x", "s"), (None, "y " * 99_999, "s")]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id bigint, text string, features string")
    labels = [(1, 1), (2, 0), (2, 0), (3, None), (77, 1), (None, 1), (4, 1)]
    model = quality.learn(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    out = quality.score(docs, model).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    by_id = {r.doc_id: r.score for r in out}
    assert by_id[3] == by_id[4]
    assert [r.features for r in out].count("s") == 6


def test_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int")
    for known in (labels, labels.where("false")):
        model = quality.learn(docs, known)
        assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(docs.where("false"), quality.learn(docs.where("false"), labels)).count() == 0


def test_indicators_do_not_hang_on_the_neighbours():
    import pyarrow as pa

    texts = [b"the the Cat!! a", b"", b"a a", b"dog", b"THE | X"]
    together = list(quality.indicators(pa.array(texts)))
    alone = [next(quality.indicators(pa.array([t]))) for t in texts]
    assert all(set(a) == set(b) for a, b in zip(together, alone, strict=True))
    assert all(len(set(a.tolist())) == len(a) for a in together)


def test_descent_separates():
    draw = np.random.default_rng(0)
    rows = [np.unique(np.append(draw.integers(10, 2000, 30), i % 2)) for i in range(400)]
    model = quality.fit(rows, [i % 2 == 1 for i in range(400)])
    margins = [model.weights[x].sum() + model.intercept for x in rows]
    assert all((m > 0) == (i % 2 == 1) for i, m in enumerate(margins))
