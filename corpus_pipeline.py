"""Training-data pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns they were given;
the last one returns the token ids of each document that is left.

Nulls, empty and very long texts, repeated rows and extra columns are handled as the operators' docstrings say. On
an empty table every stage returns an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.llm import bpe, decontaminate, neardup, quality, surrogates
from peakloom.session import Scratch

#: The classifier, the hash functions and the merges are not expressible in SQL.
ORACLE_SQL = None
SURROGATE_KEY = "corpus-1"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Labels of held-out rows are not learnt from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.learn(docs, labels, usable=~quality.held_out(F.col("doc_id")))
    return quality.score(docs, model, "__score").where(F.col("__score") >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, similarity 0.8 or more."""
    return neardup.one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages of ten words or more are cut; documents that are mostly benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, max_coverage=0.5)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    return surrogates.pseudonymise(docs, SURROGATE_KEY).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = docs.select("doc_id", "source", "lang", "text")
    decoded = bpe.encode(texts, path, public_tokenizers.PATTERN, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return decoded.select("doc_id", "source", "lang", n_tokens, "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality_filter),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("byte bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
