import random

import cases
from pyspark.sql import functions as F

from peakloom.llm import sketch


def test_next_row_over_many_ranges(spark):
    draw = random.Random(1)
    ids = [None, *draw.sample(range(-10_000, 10_000), 300), 1 << 60, (1 << 60) + 1]
    docs = spark.createDataFrame([(i, f"t{i}", "own") for i in ids], "doc_id bigint, text string, extra string").repartition(7)
    out = sketch.with_next(docs, ["text"])
    got = {r.doc_id: r.next_text for r in out.collect()}
    order = sorted(ids, key=lambda i: -(1 << 63) if i is None else i)
    assert got == {i: f"t{n}" for i, n in zip(order, order[1:] + order[:1], strict=True)}
    repeated = spark.createDataFrame([(1, "a", ""), (1, "a", ""), (2, "b", "")], docs.schema)
    assert sorted(r.next_text for r in sketch.with_next(repeated, ["text"]).collect()) == ["a", "a", "b"]
    assert sketch.with_next(docs.where("false"), ["text"]).count() == 0
    assert [r.next_text for r in sketch.with_next(docs.where("doc_id = 1152921504606846976"), ["text"]).collect()] == [f"t{1 << 60}"]


def test_containment_of_unequal_texts(spark):
    draw = random.Random(2)
    words = [f"w{draw.randint(0, 99999)}" for _ in range(12_000)]
    long, short, other = " ".join(words), " ".join(words[4000:5000]), " ".join(f"z{i}" for i in range(2000))
    texts = [long, short, other, "", None, "a b", "A, B!", "a c", long]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    made = sketch.with_sketch(df, F.col("text"), "s").withColumn("f", sketch.fingerprint(F.col("s")))
    rows = {r.doc_id: r for r in made.collect()}
    for i, text in enumerate(texts):
        w = cases.words(text)
        runs = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
        assert rows[i].s.n == len(runs)
        assert abs(len(rows[i].s.kept) - len(runs) / sketch.FRACTION) <= 5 * (len(runs) / sketch.FRACTION) ** 0.5 + 1
    assert rows[0].f == rows[8].f and rows[3].f == rows[4].f == "0::" and rows[5].f == rows[6].f != rows[7].f
    pairs = made.alias("a").join(made.alias("b"), F.lit(True)).select(
        F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"), sketch.containment(F.col("a.s"), F.col("b.s")).alias("c")
    )
    near = {(r.x, r.y): r.c for r in pairs.collect()}
    assert near[0, 1] == near[1, 0] == 1 and near[0, 2] == 0 and near[3, 4] == 1 and near[5, 6] == 1 and near[0, 8] == 1


def test_sketches_merge(spark):
    texts = spark.createDataFrame([("a b c d e f g h i j k l m n o p q r s t", "k l m n o p q r s t u v w x y z")], "x string, y string")
    both = sketch.with_sketch(sketch.with_sketch(texts, F.col("x"), "sx", fraction=2), F.col("y"), "sy", fraction=2)
    row = both.select("sx", "sy", sketch.merged(F.col("sx"), F.col("sy")).alias("m")).head()
    assert row.m == sorted(set(row.sx.kept) | set(row.sy.kept))


def test_edited_text(spark):
    rows = [("", "abc"), ("a", "xyz"), ("abcd", "xyz"), ("abcde", "x"), ("äöü😀", "😀ß")]
    df = spark.createDataFrame(rows, "t string, n string")
    got = [r.e for r in df.select(sketch.edited(F.col("t"), F.col("n")).alias("e")).collect()]
    assert got == [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in rows]
