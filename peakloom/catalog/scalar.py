"""Expressions on identifiers, charges, times and peaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakloom.catalog import query
from peakloom.catalog.inputs import PARAMS, SPECTRA_SQL, document_spectra, table
from peakloom.functions import text
from peakloom.functions.peaks import clean_peaks, hash_bin, vectorise


@query(
    r"""
WITH i AS (SELECT page_id, 'mzspec:' || url || ':scan:' || page_id AS identifier FROM pages)
SELECT page_id, split_part(identifier, ':', 3) || '.mzML' AS filename,
       regexp_extract(split_part(identifier, ':', 3) || '.mzML', '([^/]+)$', 1) AS base,
       regexp_replace(regexp_extract(split_part(identifier, ':', 3) || '.mzML', '([^/]+)$', 1), '\.mzML$', '') AS stem,
       string_split(identifier, ':')[-1] AS scan
FROM i"""
)
def identifier_parse(spark, sf):
    name = text.identifier_filename(F.col("identifier"))
    return (
        table(spark, sf, "pages")
        .select("page_id", F.concat(F.lit("mzspec:"), "url", F.lit(":scan:"), F.col("page_id").cast("string")).alias("identifier"))
        .select(
            "page_id",
            name.alias("filename"),
            text.basename(name).alias("base"),
            text.stem(name).alias("stem"),
            text.identifier_scan(F.col("identifier")).alias("scan"),
        )
    )


@query(
    r"""
WITH t AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE l_linenumber % 3 WHEN 0 THEN '/data/s' || l_suppkey || '.mzML_' || l_orderkey
              WHEN 1 THEN l_orderkey::VARCHAR ELSE '/data/s.x_' || l_orderkey END AS txt
  FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN txt LIKE '%.mzML\_%' ESCAPE '\' THEN regexp_extract(txt, '\.mzML_(\d+)$', 1)::BIGINT
            ELSE try_cast(txt AS BIGINT) END AS scan,
       CASE WHEN txt LIKE '%.mzML\_%' ESCAPE '\' THEN '/data/s' || l_suppkey || '.mzML' END AS path
FROM t"""
)
def composite_scan_parse(spark, sf):
    key = F.col("l_orderkey").cast("string")
    supp = F.col("l_suppkey").cast("string")
    scan = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("/data/s"), supp, F.lit(".mzML_"), key))
        .when(F.col("l_linenumber") % 3 == 1, key)
        .otherwise(F.concat(F.lit("/data/s.x_"), key))
    )
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", scan.alias("txt"))
        .withColumn("scan", text.composite_scan(F.col("txt")))
        .withColumn("path", text.composite_path(F.col("txt")))
        .drop("txt")
    )


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN o_orderkey END AS cluster_id FROM orders"""
)
def consensus_scan_parse(spark, sf):
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 5
    scan = (
        F.when(kind == 0, F.concat(F.lit("scan="), key, F.lit("_1")))
        .when(kind == 1, key)
        .when(kind == 2, F.concat(key, F.lit("_2")))
        .when(kind == 3, F.concat(F.lit("a=b trum="), key))
        .otherwise(F.concat(F.lit("x"), key))
    )
    return table(spark, sf, "orders").select("o_orderkey", text.consensus_scan(scan).alias("cluster_id"))


@query(
    """
SELECT event_id,
       CASE event_id % 7 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 5 THEN 1 WHEN 6 THEN 12 ELSE 0 END AS charge,
       CASE event_id % 7 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN -1 WHEN 5 THEN 1 ELSE 0 END AS signed_charge
FROM events"""
)
def charge_normalise(spark, sf):
    forms = [None, "2+", "3", "-1", "2.0", "+1", "1+2"]
    charge = F.lit(None).cast("string")
    for n, form in enumerate(forms):
        if form is not None:
            charge = F.when(F.col("event_id") % 7 == n, form).otherwise(charge)
    return table(spark, sf, "events").select(
        "event_id",
        text.charge_number(charge).alias("charge"),
        text.signed_charge_number(charge).alias("signed_charge"),
    )


@query(
    """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_totalprice WHEN 1 THEN o_custkey::DOUBLE ELSE 0 END::DOUBLE AS precursor_mz
FROM orders"""
)
def precursor_probe(spark, sf):
    kind = F.col("o_orderkey") % 3
    pepmass = F.when(kind == 0, F.concat(F.col("o_totalprice").cast("string"), F.lit(" 1000.0")))
    mass = F.when(kind == 1, F.col("o_custkey").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", text.precursor_probe(pepmass, mass).alias("precursor_mz"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value * 60.0::DOUBLE ELSE value END AS rt_sec FROM events")
def time_in_seconds(spark, sf):
    unit = F.when(F.col("event_id") % 2 == 0, "minute").otherwise("second")
    return table(spark, sf, "events").select("event_id", text.seconds(F.col("value"), unit).alias("rt_sec"))


@query(
    r"""
WITH k AS (SELECT page_id, substr(md5('/d/' || url || '.mzML'), 1, 8) || '_'
                  || regexp_extract(url || '.mzML', '([^/]+)\.mzML$', 1) AS path_key FROM pages)
SELECT page_id, path_key, page_id AS scan FROM k"""
)
def hashed_scan_parse(spark, sf):
    path = F.concat(F.lit("/d/"), "url", F.lit(".mzML"))
    composite = F.concat_ws("_", text.path_key(path), F.col("page_id").cast("string"))
    key, scan = text.hashed_scan(composite)
    return table(spark, sf, "pages").select("page_id", key.alias("path_key"), scan.alias("scan"))


@query(
    """
SELECT o_orderkey, 'controllerType=0 controllerNumber=1 scan=' || o_orderkey AS native_id,
       o_orderkey || '_' || o_custkey AS sample_id, '/d/' || o_orderstatus || '.mzML_' || o_orderkey AS singleton_id
FROM orders"""
)
def native_ids(spark, sf):
    path = F.concat(F.lit("/d/"), "o_orderstatus", F.lit(".mzML"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.native_id(F.col("o_orderkey")).alias("native_id"),
        text.sample_id(F.col("o_orderkey"), F.col("o_custkey")).alias("sample_id"),
        text.path_scan_id(path, F.col("o_orderkey")).alias("singleton_id"),
    )


@query(
    """
WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS e, unnest(range(64)) AS d FROM embeddings),
q AS (SELECT vec_id, (d + 1) * 25.0::DOUBLE AS mz, abs(e) AS it, d, e FROM p)
SELECT vec_id, count(*) AS n_peaks, round(min(mz), 6) AS low, round(max(mz), 6) AS high, round(sum(it), 6) AS total
FROM q WHERE e >= 0 AND d % 9 > 0 AND mz BETWEEN 100 AND 1500 GROUP BY vec_id"""
)
def peak_filter(spark, sf):
    """Embedding entries as peaks; negative ones become NaN or infinite and must go."""
    bad = F.when(F.col("vec_id") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    spectra = table(spark, sf, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda e, d: F.when(d % 9 == 0, bad).otherwise((d + 1) * F.lit(25.0))).alias("mz"),
        F.transform("embedding", lambda e: F.when(e < 0, bad).otherwise(e.cast("double"))).alias("intensity"),
    )
    total = F.aggregate("intensity", F.lit(0.0), lambda a, v: a + v)
    return clean_peaks(spectra, 100, 1500).where(F.size("mz") > 0).select(
        "vec_id",
        F.size("mz").cast("bigint").alias("n_peaks"),
        F.round(F.array_min("mz"), 6).alias("low"),
        F.round(F.array_max("mz"), 6).alias("high"),
        F.round(total, 6).alias("total"),
    )


@query("WITH " + SPECTRA_SQL + "SELECT doc_id, bin, round(w, 9) AS weight FROM vec")
def vector_bins(spark, sf):
    vectors = vectorise(document_spectra(spark, sf).select(F.col("scan").alias("doc_id"), "mz", "intensity"), PARAMS)
    return vectors.select("doc_id", F.explode(F.arrays_zip("bins", "weights")).alias("p")).select(
        "doc_id", F.col("p.bins").alias("bin"), F.round("p.weights", 9).alias("weight")
    )


@query(
    "WITH "
    + SPECTRA_SQL
    + """, hv AS (
  SELECT doc_id, ((bin * 2654435761 % 4294967296) * 400) >> 32 AS bin, sum(w) AS w FROM bn GROUP BY ALL)
SELECT doc_id, bin, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS weight FROM hv"""
)
def vector_bins_hashed(spark, sf):
    from dataclasses import replace

    spectra = document_spectra(spark, sf).select(F.col("scan").alias("doc_id"), "mz", "intensity")
    vectors = vectorise(spectra, replace(PARAMS, hash_len=400))
    return vectors.select("doc_id", F.explode(F.arrays_zip("bins", "weights")).alias("p")).select(
        "doc_id", F.col("p.bins").alias("bin"), F.round("p.weights", 9).alias("weight")
    )


@query("SELECT l_partkey, count(*) AS n, min(((l_partkey * 2654435761 % 4294967296) * 400) >> 32) AS dim FROM lineitem GROUP BY l_partkey")
def bin_hash(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.min(hash_bin(F.col("l_partkey"), 400)).alias("dim")
    )
