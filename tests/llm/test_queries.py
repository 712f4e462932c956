"""The registered queries over the whole small tables: against their SQL, else against plain versions."""

import hashlib
import math
import re
import struct
import zlib
from pathlib import Path

import cases
import duckdb
import public_tokenizers
import pytest
import tiktoken

from peakloom.llm import bpe
from peakloom.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "benchmark", "labels", "pages", "conversations"]


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    base = duckdb.connect()
    for table in TABLES:
        path = Path(f"{DATA}/{table}.parquet")
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    cursor = base.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    made = QUERIES[name](spark, DATA)
    assert sorted(made.columns) == sorted(columns)
    want = cursor.fetchall()
    got = [tuple(r) for r in made.select(*columns).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and got


def test_byte_bpe(spark, documents):
    reference = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    rows = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, DATA).collect()}
    assert rows.keys() == documents.keys()
    for i, text in documents.items():
        ids = reference.encode_ordinary(text)
        want = (len(ids), _sha(struct.pack(f"<{len(ids)}I", *ids)), _sha(text.encode()))
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == want


def test_near_duplicates(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op7_minhash_near_dedup"](spark, DATA).collect()}
    sets = {i: cases.shingles(t, 3) for i, t in documents.items()}
    expected = cases.components(sets, 85)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in rows.items()} == {
        i: (len(sets[i]), root, root == i) for i, root in expected.items()
    }


def test_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, DATA).collect()}
    for i, row in rows.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    tested = [i for i in labels if i in rows and rows[i].held_out]
    assert sum(rows[i].predicted == labels[i] for i in tested) >= 0.9 * len(tested)


def test_fingerprints(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op9_document_fingerprints"](spark, DATA).collect()}
    ids = sorted(documents)
    errors = []
    for i, following in zip(ids, ids[1:] + ids[:1], strict=True):
        text, row = documents[i], rows[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + documents[following][:half]
        assert (row.n_chars, row.edited_sha256) == (len(text), _sha(edited.encode()))
        assert all(math.isfinite(x) and 0 <= x <= 1 for x in (row.near_edited, row.near_next))
        runs = [cases.words(t) for t in (text, edited)]
        one, two = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in runs)
        if min(len(one), len(two)) > 200:
            errors.append(row.near_edited - len(one & two) / min(len(one), len(two)))
    assert errors and sum(map(abs, errors)) / len(errors) < 0.05
    by_text = {}
    for i in ids:
        assert by_text.setdefault(documents[i], rows[i].fingerprint) == rows[i].fingerprint


def test_surrogates(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op2_pii_surrogates"](spark, DATA).collect()}
    mention = re.compile(r"[\w.]+@[\w.]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{16}\b")
    known: dict[str, set] = {}

    def real(number: str) -> bool:
        """Sixteen digits are a card if their check sum says so; others stay."""
        digits = [int(d) for d in number] if number.isdigit() else []
        return (sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])) % 10 == 0

    for i, text in documents.items():
        old, new = mention.findall(text), mention.findall(rows[i].text)
        assert len(old) == len(new) and sum(map(real, old)) == rows[i].n_mentions
        assert mention.split(text) == mention.split(rows[i].text)
        assert all(a == b for a, b in zip(old, new, strict=True) if not real(a))
        for a, b in (p for p in zip(old, new, strict=True) if real(p[0])):
            known.setdefault(a, set()).add(b)
            assert re.sub(r"\d", "9", a) == re.sub(r"\d", "9", b) or "@" in a or re.fullmatch(r"[\d.]+", a)
    assert known and all(len(b) == 1 for b in known.values())
    assert len(set().union(*known.values())) == len(known)
    assert not set(known) & set().union(*known.values())
