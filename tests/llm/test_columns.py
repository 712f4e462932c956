"""Tables with columns called like an operator's outputs or inner columns, in another case."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from peakloom.llm import bpe, decontaminate, licences, neardup, quality, sketch, urlrules

TEXT = "Licensed under the Apache License and one two three four five six seven eight nine ten eleven"


def _docs(spark, *names):
    extra = [n for n in names if n.lower() not in ("doc_id", "text")]
    schema = ", ".join(["doc_id bigint", "text string", *[f"`{n}` string" for n in extra]])
    rows = [(i, t, *[f"own {n}" for n in extra]) for i, t in enumerate([TEXT, "other words altogether", "", None])]
    return spark.createDataFrame(rows, schema), extra


def _check(out, extra, made):
    """Columns of the table are kept, those called like an output are replaced by it."""
    gone = {m.lower() for m in made}
    left = [n for n in extra if n.lower() not in gone]
    names = out.columns
    assert sorted(c.lower() for c in names) == sorted({*(n.lower() for n in names)})
    for row in out.collect():
        assert all(row[n] == f"own {n}" for n in left)
        assert all(not isinstance(row[names.index(n)], str) or not row[names.index(n)].startswith("own") for n in names if n.lower() in gone)


def test_licences(spark):
    docs, extra = _docs(spark, "License", "n_words", "score")
    _check(licences.scan(docs), extra, ["license"])


def test_sketch(spark):
    docs, extra = _docs(spark, "Own", "__words", "__RUNS", "__order", "__Range", "__to", "__last", "__copy", "next_Text")
    out = sketch.with_next(docs, ["text", "own"], prepare=lambda df: sketch.with_sketch(df, F.col("text"), "own"))
    _check(out, extra, ["own", "next_text", "next_own"])
    assert sketch.with_next(docs.where("false"), ["text"]).count() == 0


def test_url_rules(spark):
    schema = "page_id bigint, url string, HOST string, Rule string, VERDICT string, __url string, tokens string, listed string"
    pages = spark.createDataFrame([(1, "http://a.com/x", *["own"] * 6), (2, None, *["own"] * 6)], schema)
    rules = spark.createDataFrame([("com", "/", "allow")], "host string, path string, verdict string")
    out = urlrules.judge(pages, rules)
    assert out.columns == ["page_id", "url", "__url", "tokens", "listed", "host", "path", "rule", "verdict"]
    assert {(r.page_id, r["__url"], r.host, r.rule, r.verdict) for r in out.collect()} == {
        (1, "own", "a.com", "com/", "allow"), (2, "own", "", None, "allow"),
    }


def test_quality(spark):
    docs, extra = _docs(spark, "SCORE", "quality", "label", "features")
    labels = spark.createDataFrame([(0, 1, "x"), (1, 0, "x")], "doc_id bigint, quality int, text string")
    _check(quality.score(docs, quality.learn(docs, labels)), extra, ["score"])


def test_bpe(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs, extra = _docs(spark, "IDS", "Decoded", "rank")
    out = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded")
    _check(out, extra, ["ids", "decoded"])
    again = bpe.decode(out.withColumnRenamed("decoded", "DECODED"), path)
    assert again.columns == ["doc_id", "text", "rank", "ids", "decoded"]
    assert {r.doc_id: bytes(r.decoded).decode() for r in again.collect()}[0] == TEXT


@pytest.mark.parametrize("items", [["one two three four five six seven eight nine ten"], []])
def test_decontamination(spark, items):
    docs, extra = _docs(spark, "__Items", "__spans", "__N_words", "items", "n_words", "n_hit")
    table = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    out = decontaminate.clean(docs, table, max_coverage=0.9)
    assert out.columns == docs.columns
    _check(out, extra, [])
    texts = {r.doc_id: r.text for r in out.collect()}
    assert ("five" in texts[0]) == (not items) and len(texts) == 4
    assert decontaminate.report(docs, table).count() == 4


def test_near_duplicates(spark):
    docs, extra = _docs(spark, "Digest", "node", "BANDS", "kept", "component_id", "copies", "__row")
    _check(neardup.one_of_each(docs), extra, [])
    assert neardup.near_duplicates(docs).columns == ["doc_id", "n_shingles", "component_id", "kept", "copies"]
