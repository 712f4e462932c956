import random
from collections import Counter

from pyspark.sql import functions as F
import pytest

from peakloom.llm.rollup import TokenRollup, byte_count, counts, word_count
from peakloom.session import Scratch, list_names, write_text

SCHEMA = "doc_id bigint, tokenizer string, source string, lang string, change string, tokens bigint, seq int, extra string"


def test_against_a_dictionary(spark):
    draw = random.Random(8)
    scratch = Scratch(spark)
    store = TokenRollup(spark, f"{scratch.root}/rollup")
    held: dict = {}
    sent = []
    for batch in range(4):
        rows = []
        for seq in range(60):
            key = (draw.choice([None, *range(25)]), draw.choice(["a-1", "a-2", None]))
            place = (draw.choice(["hot", "hot", "s1", None]), draw.choice(["en", None]))
            change = draw.choice(["insert", "delete", "revise"])
            tokens = draw.choice([None, 0, 5, 17])
            rows.append((*key, *place, change, tokens, seq, "x"))
            if change == "delete":
                held.pop(key, None)
            else:
                held[key] = (*place, tokens or 0)
        draw.shuffle(rows)
        sent.append(rows)
        assert store.commit(f"day {batch}/ü", spark.createDataFrame(rows, SCHEMA))
        assert not store.commit("day 0/ü", spark.createDataFrame(sent[0], SCHEMA))
        expected: Counter = Counter()
        docs: Counter = Counter()
        for (_, tokenizer), (source, lang, tokens) in held.items():
            expected[source, lang, tokenizer] += tokens
            docs[source, lang, tokenizer] += 1
        if batch == 2:
            assert store.compact() and not store.compact()
        got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}
        assert got == {k: (docs[k], expected[k]) for k in docs}
    scratch.clear()


def test_a_lost_run_counts_once(spark, monkeypatch):
    scratch = Scratch(spark)
    store = TokenRollup(spark, f"{scratch.root}/rollup")
    assert store.totals().count() == 0
    docs = spark.createDataFrame([(1, "s", "en", "a b"), (2, "s", "en", None), (2, "s", "en", None)], "doc_id bigint, source string, lang string, text string")
    changes = counts(docs, {"words": word_count(F.col("text"))})
    monkeypatch.setattr(store, "_record", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.commit("one", changes)
    monkeypatch.undo()
    assert store.totals().count() == 0
    assert store.commit("one", changes)
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "words", 2, 2)]
    assert store.commit("empty", changes.where("false"))
    with pytest.raises(ValueError):
        store.commit("wrong", changes.withColumn("change", F.lit("drop")))
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "words", 2, 2)]
    scratch.clear()


def test_counts(spark):
    texts = [None, "", "  ", "a", " a b!", "Straße 12,3 x", "word " * 30_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(word_count(F.col("t")), byte_count(F.col("t"))).collect()]
    assert got == [(0, 0), (0, 0), (0, 2), (1, 1), (2, 5), (4, 14), (30_000, 150_000)]


def test_many_sources_are_summed_in_several_tasks(spark):
    store = TokenRollup(spark, f"{Scratch(spark).root}/rollup")
    text = F.col("id").cast("string")
    rows = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit("a").alias("tokenizer"), F.concat(F.lit("host"), text).alias("source"),
        F.lit("en").alias("lang"), F.lit("insert").alias("change"), F.lit(1).alias("tokens"), F.lit(0).alias("seq"),
    )
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        assert store.commit("one", rows)
    finally:
        spark.conf.set(name, before)
    files = spark.read.parquet(f"{store.path}/totals/*").select(F.input_file_name()).distinct().count()
    assert files > 1 and store.totals().count() == 500


def _one(spark, doc, source, tokens, change="insert"):
    return spark.createDataFrame([(doc, "t", source, "en", change, tokens, 0, None)], SCHEMA)


def _totals(store):
    return {r.source: (r.n_docs, r.n_tokens) for r in store.totals().collect()}


def test_a_record_is_whole_or_not_there(spark):
    """A record that was lost while it was written has another name and is not looked at."""
    store = TokenRollup(spark, f"{Scratch(spark).root}/rollup")
    assert store.commit("one", _one(spark, 1, "a", 5))
    write_text(spark, f"{store.path}/_commits/.lost", "")
    write_text(spark, f"{store.path}/_commits/.half", '{"batch": "tw')
    assert _totals(store) == {"a": (1, 5)}
    assert store.commit("two", _one(spark, 2, "a", 6)) and _totals(store) == {"a": (2, 11)}


@pytest.mark.parametrize("other", ["other", "mine"])
def test_two_batches_at_once(spark, monkeypatch, other):
    """While a batch is written another one is committed that touches the same document, or the same batch is."""
    store = TokenRollup(spark, f"{Scratch(spark).root}/rollup")
    assert store.commit("first", _one(spark, 1, "a", 5))
    real, done = TokenRollup._record, []

    def slow(self, number, facts):
        if not done:
            done.append(number)
            assert TokenRollup(spark, store.path).commit(other, _one(spark, 1, "b", 7))
        return real(self, number, facts)

    monkeypatch.setattr(TokenRollup, "_record", slow)
    assert store.commit("mine", _one(spark, 1, "c", 9)) == (other != "mine")
    assert _totals(store) == ({"c": (1, 9)} if other != "mine" else {"b": (1, 7)})
    # what the slower run had written is gone
    assert len(list_names(spark, f"{store.path}/ledger")) == len(store._records())


def test_compaction_replaces_the_history(spark):
    store = TokenRollup(spark, f"{Scratch(spark).root}/rollup")
    assert not store.compact()
    for n in range(4):
        assert store.commit(f"b{n}", _one(spark, n % 2, f"s{n}", n))
    before = _totals(store)
    assert before == {"s2": (1, 2), "s3": (1, 3)} and store._read("ledger").count() == 6
    assert store.compact() and _totals(store) == before and store._read("ledger").count() == 2
    assert not store.commit("b0", _one(spark, 0, "s0", 0))
    assert store.commit("gone", _one(spark, 0, None, 0, "delete")) and _totals(store) == {"s3": (1, 3)}
    assert store.compact() and _totals(store) == {"s3": (1, 3)}


def test_only_touched_keys_are_summed(spark):
    """The ledger is cut to the keys of the batch before it is summed."""
    store = TokenRollup(spark, f"{Scratch(spark).root}/rollup")
    assert store.commit("one", _one(spark, 1, "a", 5))
    plan = store._signed(_one(spark, 1, "a", 6), store._records())._jdf.queryExecution().optimizedPlan().toString()
    ledger = plan[: plan.index("LeftSemi")].rsplit("Union", 1)[1]
    assert "Aggregate" in ledger and "LeftSemi" in plan
