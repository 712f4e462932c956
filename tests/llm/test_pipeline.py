import re

import cases
import public_tokenizers
import tiktoken

import corpus_pipeline
from peakloom.llm import bpe
from peakloom.session import Scratch

DATA = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    """Each stage is judged on what the one before has kept."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.save(stage(spark, docs, DATA), "stage")
        if name != "byte bpe":
            assert out.columns == columns
        kept.append({r.doc_id: r for r in out.collect()})
        docs = out
    everything = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    quality, single, clean, private, tokens = kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    right = sum((i in quality) == (labels[i] == 1) for i in labels if i in everything)
    assert right / len([i for i in labels if i in everything]) > 0.95
    assert all(quality[i] == everything[i] for i in quality)

    sets = {i: cases.shingles(r.text, 5) for i, r in quality.items()}
    assert set(single) == {i for i, root in cases.components(sets, 80).items() if i == root}

    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    known = cases.windows(items, 10)
    for i, row in single.items():
        n, hit, _ = cases.contamination(row.text, known)
        assert (i in clean) == (len(hit) <= 0.5 * n)
        if i in clean:
            left = [w for at, w in enumerate(cases.words(row.text)) if at not in hit]
            assert cases.words(clean[i].text) == left
            assert hit or clean[i] == row

    mention = re.compile(r"[\w.]+@[\w.]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{16}\b")
    assert set(private) == set(clean)
    for i, row in clean.items():
        found = mention.findall(row.text)
        assert not any(m in private[i].text for m in found)
        assert found or private[i] == row

    reference = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    assert set(tokens) == set(private)
    for i, row in tokens.items():
        ids = reference.encode_ordinary(private[i].text)
        assert (row.n_tokens, row.round_trip, list(memoryview(bytes(row.ids)).cast("I"))) == (len(ids), True, ids)
    scratch.clear()


def test_run_gives_the_last_stage(spark, tmp_path):
    rows = [(1, "a plain text of several words", "en", "s", 29), (2, None, None, None, None), (3, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert out.keys() == {1, 2, 3} and out[2] == out[3] == 0 and out[1] > 0
    empty = tmp_path / "empty"
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").where("false").write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
