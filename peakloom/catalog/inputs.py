"""The given tables in the shapes that the operators read, in Spark and in SQL."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.functions.peaks import list_lengths, row_order, runs
from peakloom.functions.text import basename
from peakloom.params import ClusterParams

# Documents as spectra: a word is a peak, its m/z taken from the word's MD5; language is the charge
# and length the mass. Near copies of a text are then neighbours in both respects.
PARAMS = ClusterParams(precursor_tol="20000 ppm")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


TEXT_AT_ONCE = 1 << 21  # bytes of text that are cut into words at once, about


def word_mz(word):
    number = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
    return F.lit(50.025) + (number % F.lit(19500)).cast("double") / F.lit(10.0)


def _word_mz(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(m/z of all words in their order, number of words of each text), as ``word_mz`` has them."""
    words = pc.ascii_split_whitespace(texts)
    flat = words.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    rows = np.repeat(np.arange(len(texts)), list_lengths(words))[full.to_numpy(zero_copy_only=False)]
    coded = flat.filter(full).dictionary_encode()
    prints = b"".join(hashlib.md5(w).digest()[:4] for w in coded.dictionary.cast(pa.binary()).to_pylist())
    mz = 50.025 + (np.frombuffer(prints, ">u4") % 19500).astype(np.float64) / 10.0
    return mz[coded.indices.to_numpy()], np.bincount(rows, minlength=len(texts))


def _text_slices(texts: pa.Array) -> list[pa.Array]:
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    return [texts.slice(r.start, r.stop - r.start) for r in runs(lengths, TEXT_AT_ONCE)]


def _list_array(values: np.ndarray, lengths: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    offsets = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32), mask=None if missing is None else np.r_[missing, False])
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.float64()))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def words_mz(texts: pa.Array) -> pa.Array:
    """The m/z of each word of a text, null for a null text."""
    parts = [_word_mz(part) for part in _text_slices(texts)]
    values, lengths = (np.concatenate([p[i] for p in parts] or [np.zeros(0)]) for i in (0, 1))
    return _list_array(values, lengths, texts.is_null().to_numpy(zero_copy_only=False))


@F.arrow_udf(T.StructType([T.StructField("mz", T.ArrayType(T.DoubleType())), T.StructField("intensity", T.ArrayType(T.DoubleType()))]))
def counted_words(texts: pa.Array) -> pa.Array:
    """The distinct m/z of the words of a text in their order, and how many words have each."""
    parts = []
    for part in _text_slices(texts):
        mz, lengths = _word_mz(part)
        rows = np.repeat(np.arange(len(part)), lengths)
        order = row_order(rows, np.rint(mz * 1000.0))  # m/z stand 0.1 apart
        mz, rows = mz[order], rows[order]
        starts = np.flatnonzero(np.r_[True, (mz[1:] != mz[:-1]) | (rows[1:] != rows[:-1])][: len(mz)])
        parts.append((mz[starts], np.diff(np.r_[starts, len(mz)]).astype(np.float64), np.bincount(rows[starts], minlength=len(part))))
    mz, counts, lengths = (np.concatenate([p[i] for p in parts] or [np.zeros(0)]) for i in (0, 1, 2))
    return pa.StructArray.from_arrays([_list_array(mz, lengths), _list_array(counts, lengths)], ["mz", "intensity"])


def _charge(lang):
    return F.when(lang == "en", 1).when(lang == "fr", 2).when(lang == "de", 3).otherwise(4)


def document_spectra(spark: SparkSession, sf: str) -> DataFrame:
    """One spectrum per document, one peak per word (repeated words repeat the peak)."""
    return (
        table(spark, sf, "documents")
        .select("doc_id", "lang", "n_chars", words_mz("text").alias("mz"))
        .select(
            F.lit("/docs/documents.mzML").alias("path"),
            F.lit("documents.mzML").alias("filename"),
            F.col("doc_id").alias("scan"),
            F.lit(2).alias("ms_level"),
            (F.col("n_chars") + F.lit(100.0)).alias("precursor_mz"),
            (F.col("doc_id") % 3600).cast("double").alias("rt_sec"),
            _charge(F.col("lang")).alias("charge"),
            F.lit(None).cast("string").alias("title"),
            "mz",
            F.when(F.col("mz").isNotNull(), F.array_repeat(F.lit(1.0), F.size("mz"))).alias("intensity"),
        )
    )


def document_peaks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as spectra with each distinct word once: (id, precursor_mz, mz, intensity)."""
    key = ["doc_id", "n_chars"]
    texts = table(spark, sf, "documents").select(*key, "text")
    # Only texts of one key meet, and only if there are any.
    if not texts.groupBy(*key).count().where("count > 1").isEmpty():
        texts = texts.groupBy(*key).agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    return (
        texts.select(F.col("doc_id").alias("id"), (F.col("n_chars") + F.lit(100.0)).alias("precursor_mz"), counted_words("text").alias("p"))
        .select("id", "precursor_mz", "p.mz", "p.intensity")
        .where(F.size("mz") > 0)
    )


# CTEs: spec (one row per document), pk (m/z and count per document), vec (unit vector by bin).
SPECTRA_SQL = r"""
spec AS (
  SELECT doc_id, (n_chars + 100)::DOUBLE AS mass,
         CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 ELSE 4 END AS charge
  FROM documents),
tok AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS t FROM documents),
pk AS MATERIALIZED (
  SELECT doc_id, mz, count(*)::DOUBLE AS it FROM (
    SELECT doc_id, 50.025::DOUBLE + ((('0x' || substr(md5(t), 1, 8))::BIGINT % 19500)::DOUBLE / 10.0::DOUBLE) AS mz
    FROM tok WHERE t <> '') GROUP BY doc_id, mz),
bn AS (SELECT doc_id, floor(mz / 0.05::DOUBLE)::BIGINT AS bin, sum(it) AS w FROM pk GROUP BY doc_id, bin),
vec AS MATERIALIZED (
  SELECT doc_id, bin, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM bn)
"""

EDGES_SQL = (
    SPECTRA_SQL
    + """,
edges AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, sum(a.w * b.w) AS cosine
  FROM vec a JOIN vec b ON a.bin = b.bin AND a.doc_id < b.doc_id
  JOIN spec sa ON sa.doc_id = a.doc_id
  JOIN spec sb ON sb.doc_id = b.doc_id AND sb.charge = sa.charge
   AND greatest(sa.mass, sb.mass) - least(sa.mass, sb.mass) <= 20000 * 1e-6::DOUBLE * greatest(sa.mass, sb.mass)
  GROUP BY 1, 2 HAVING sum(a.w * b.w) >= 1.0::DOUBLE - 0.1::DOUBLE)"""
)

# Component of each document that has an edge, as its smallest document; then dense labels.
LABELS_SQL = (
    EDGES_SQL
    + """,
both_ways AS (SELECT x, y FROM edges UNION ALL SELECT y, x FROM edges),
reach AS (
  SELECT DISTINCT x, x AS y FROM both_ways
  UNION
  SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
root AS (SELECT x AS doc_id, min(y) AS root FROM reach GROUP BY x),
label AS MATERIALIZED (SELECT doc_id, dense_rank() OVER (ORDER BY root) - 1 AS temp_cluster FROM root)"""
)


def scan_list(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a scan list: the order is the cluster, part and supplier name the file."""
    path = F.concat(
        F.lit("/data/p"), F.col("l_partkey").cast("string"), F.lit("_s"), F.col("l_suppkey").cast("string"), F.lit(".mzML")
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("cluster_id"),
        path.alias("path"),
        basename(path).alias("filename"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("scan"),
        F.col("l_extendedprice").alias("precursor_mz"),
        (F.col("l_quantity") * F.lit(60.0)).alias("retention_time"),
        F.year("l_shipdate").cast("bigint").alias("batch_id"),
    )


SCAN_LIST_SQL = """
scan_list AS (
  SELECT l_orderkey AS cluster_id, '/data/p' || l_partkey || '_s' || l_suppkey || '.mzML' AS path,
         'p' || l_partkey || '_s' || l_suppkey || '.mzML' AS filename,
         l_orderkey * 10 + l_linenumber AS scan, l_extendedprice AS precursor_mz,
         l_quantity * 60.0::DOUBLE AS retention_time, year(l_shipdate)::BIGINT AS batch_id
  FROM lineitem)"""


def consensus(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as representatives; some lack a mass or a charge."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cluster_id"),
        F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(F.col("o_totalprice")).alias("precursor_mz"),
        F.when(F.col("o_orderkey") % 7 > 0, F.substring("o_orderpriority", 1, 1).cast("int")).alias("charge"),
        F.year("o_orderdate").cast("bigint").alias("updated_batch"),
    )


CONSENSUS_SQL = """
consensus AS (
  SELECT o_orderkey AS cluster_id, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END::DOUBLE AS precursor_mz,
         CASE WHEN o_orderkey % 7 > 0 THEN substr(o_orderpriority, 1, 1)::INT END AS charge,
         year(o_orderdate)::BIGINT AS updated_batch
  FROM orders)"""


def clustering_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a clustering result against orders as known clusters.

    Parts are temporary clusters. Every 11th order refers to a known cluster, every fifth line is
    noise, and some references are unreadable.
    """
    known = F.col("l_orderkey") % 11 == 0
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") % 5 == 0, F.lit(-1)).otherwise(F.col("l_partkey")).cast("bigint").alias("temp_cluster"),
        F.concat(F.lit("/data/s"), F.col("l_suppkey").cast("string"), F.lit(".mzML")).alias("path"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.lit(".mzML")).alias("filename"),
        (F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("scan"),
        F.when(known, "consensus").otherwise("batch").alias("source"),
        F.when(known & (F.col("l_linenumber") < 7), F.col("l_orderkey")).alias("ref_cluster"),
        F.col("l_extendedprice").alias("precursor_mz"),
        F.col("l_quantity").alias("rt_sec"),
        F.lit(9).cast("bigint").alias("batch_id"),
    )


ROWS_SQL = """
rws AS (
  SELECT CASE WHEN l_quantity % 5 = 0 THEN -1 ELSE l_partkey END::BIGINT AS temp_cluster,
         '/data/s' || l_suppkey || '.mzML' AS path, 's' || l_suppkey || '.mzML' AS filename,
         l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS scan,
         CASE WHEN l_orderkey % 11 = 0 THEN 'consensus' ELSE 'batch' END AS source,
         CASE WHEN l_orderkey % 11 = 0 AND l_linenumber < 7 THEN l_orderkey END AS ref_cluster,
         l_extendedprice AS precursor_mz, l_quantity AS rt_sec
  FROM lineitem),
routed AS (
  SELECT *, CASE WHEN source = 'consensus' THEN 'consensus' WHEN temp_cluster <> -1 THEN 'member' ELSE 'noise' END AS route
  FROM rws),
known AS (
  SELECT temp_cluster, min(ref_cluster) AS cluster_id FROM routed
  WHERE route = 'consensus' AND temp_cluster <> -1 AND ref_cluster IS NOT NULL GROUP BY temp_cluster),
base AS (SELECT coalesce(max(o_orderkey), 0) AS top FROM orders),
fresh AS (
  SELECT temp_cluster, (SELECT top FROM base) + dense_rank() OVER (ORDER BY temp_cluster) AS cluster_id
  FROM (SELECT DISTINCT temp_cluster FROM routed WHERE route = 'member'
        AND temp_cluster NOT IN (SELECT temp_cluster FROM known))),
idmap AS (
  SELECT temp_cluster, cluster_id, false AS is_new FROM known
  UNION ALL SELECT temp_cluster, cluster_id, true FROM fresh)"""
