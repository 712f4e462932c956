import random

import public_tokenizers
import pytest
import tiktoken

from peakloom.llm import bpe


def _reference(name):
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts(n):
    draw = random.Random(5)
    letters = "abAB 01'sdtrevlm\n\t\x1c\x85\xa0²½éßŁ漢字　аб١😀<|endoftext|>_-aaaa"
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_and_round_trip(spark, name):
    path = public_tokenizers.path(name)
    texts = [None, "", "a" * 5000, "ab" * 20_000, " " * 300, "Hello world's", *_texts(2500)]
    texts += texts[5:9]
    docs = spark.createDataFrame([(i, t, b"own") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens binary")
    out = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    reference = _reference(name)
    rows = out.collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.n_tokens == b"own"
        text = texts[row.doc_id] or ""
        assert list(memoryview(bytes(row.ids)).cast("I")) == reference.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()


def test_empty_table(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).count() == 0


def test_a_merge_that_brings_up_an_earlier_rank():
    """In this vocabulary ``abc`` is earlier than ``ab``, which no trained one has."""
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"ab": 257, b"aa": 258, b"aaa": 259, b"bb": 300, b"bbb": 280}
    replay = bpe.Replay(ranks)
    draw = random.Random(2)
    pieces = ["".join(draw.choice("aabbc") for _ in range(draw.randint(2, 14))).encode() for _ in range(3000)]
    for piece, ids in zip(pieces, replay.encode(pieces), strict=True):
        expected = ranks[piece].to_bytes(4, "little") if piece in ranks else replay._alone(piece)
        assert ids == expected, piece


def test_result_does_not_hang_on_what_is_known(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 40)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = _texts(300)
    reference = _reference("byte_bpe_50k.tiktoken")
    encoded = bpe.Encoder(path, public_tokenizers.PATTERN).encode(texts)
    assert [list(memoryview(x).cast("I")) for x in encoded] == [reference.encode_ordinary(t) for t in texts]
