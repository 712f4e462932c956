"""Exports read back, imported results, compacted and looked-up tables."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom import schemas
from peakloom.catalog import query
from peakloom.catalog.clustering import MEDOID_SQL, TWO_BATCHES_SQL
from peakloom.catalog.inputs import (
    CONSENSUS_SQL,
    LABELS_SQL,
    PARAMS,
    SCAN_LIST_SQL,
    consensus,
    document_spectra,
    scan_list,
    table,
)
from peakloom.functions.text import native_id, sample_id
from peakloom.operators import store
from peakloom.plans.incremental import export_results, run_batch
from peakloom.plans.state import State
from peakloom.session import Scratch
from peakloom.sources.legacy import decode_arrays, read_member_pools, stored_or_consensus
from peakloom.sources.mzml import read_mzml
from peakloom.sources.tables import (
    assignment_rows,
    read_assignment_tsv,
    read_clustering_csv,
    read_tsv,
    with_scan_reference,
    write_tsv,
)

SL = "WITH " + SCAN_LIST_SQL


@query(
    SL
    + """
SELECT cluster_id AS cluster, precursor_mz, retention_time, filename, scan::VARCHAR AS scan FROM scan_list"""
)
def clustering_csv_round_trip(spark, sf):
    """A clustering result as CSV part files, with comment lines between them, read back."""
    folder = f"{Scratch(spark).root}/clustering"
    run = F.regexp_replace("filename", r"\.mzML$", "")
    rows = scan_list(spark, sf).select(
        F.col("cluster_id").alias("cluster"),
        F.concat_ws(":", F.lit("mzspec"), F.lit("USI000000"), run, F.lit("scan"), F.col("scan").cast("string")).alias("identifier"),
        "precursor_mz",
        "retention_time",
    )
    rows.write.option("header", True).csv(folder)
    files = table(spark, sf, "lineitem").select(F.concat(F.lit("# returned "), "l_returnflag").alias("value")).distinct()
    files.write.mode("append").text(folder)
    return with_scan_reference(read_clustering_csv(spark, folder)).drop("identifier")


@query(
    SL
    + """, a AS (
  SELECT s.*, CASE WHEN scan % 5 = 0 THEN -1 ELSE cluster_id END AS temp_cluster, cluster_id % 11 = 0 AS known FROM scan_list s)
SELECT temp_cluster,
       CASE WHEN known THEN '/in/consensus.mzML' WHEN scan % 2 = 0 THEN '/in/' || filename ELSE path END AS path,
       CASE WHEN known THEN 'consensus.mzML' ELSE filename END AS filename,
       CASE WHEN NOT known THEN scan END AS scan, CASE WHEN known THEN 'consensus' ELSE 'batch' END AS source,
       CASE WHEN known THEN cluster_id END AS ref_cluster, precursor_mz,
       CASE WHEN scan % 3 = 0 THEN 0 ELSE retention_time END AS rt_sec
FROM a"""
)
def assignment_tsv_round_trip(spark, sf):
    """An assignment as TSV: representatives' samples, composite scan texts, plain numbers, missing times."""
    folder = f"{Scratch(spark).root}/assignment"
    known, scan = F.col("cluster_id") % 11 == 0, F.col("scan")
    number = scan.cast("string")
    text = (
        F.when(known, native_id(sample_id(F.col("cluster_id"), F.lit(2))))
        .when(scan % 2 == 0, number)
        .otherwise(F.concat_ws("_", "path", number))
    )
    rows = scan_list(spark, sf).select(
        F.when(scan % 5 == 0, -1).otherwise(F.col("cluster_id")).alias("cluster"),
        "precursor_mz",
        F.when(scan % 3 > 0, F.col("retention_time")).alias("retention_time"),
        F.lit("").alias("identifier"),
        F.when(known, "consensus.mzML").otherwise(F.col("filename")).alias("filename"),
        text.alias("scan"),
    )
    write_tsv(rows, folder)
    return assignment_rows(read_assignment_tsv(spark, folder), "/in/")


def _exported(spark, sf) -> tuple[str, State]:
    root = Scratch(spark).root
    state = State(spark, f"{root}/state")
    run_batch(document_spectra(spark, sf), state, 0, PARAMS)
    export_results(state, 0, f"{root}/out", replace(PARAMS, do_networking=False))
    return f"{root}/out", state


@query(
    "WITH RECURSIVE "
    + LABELS_SQL
    + MEDOID_SQL
    + """, n AS (SELECT temp_cluster, count(*) AS n FROM label GROUP BY temp_cluster)
SELECT l.temp_cluster + 1 AS cluster, 'documents.mzML' AS filename, l.doc_id AS scan, s.mass AS precursor_mz,
       (l.doc_id % 3600)::DOUBLE AS retention_time, 'yes' AS new_batch, n.n AS cluster_size, r.mass AS parent_mass, r.charge AS precursor_charge
FROM label l JOIN spec s USING (doc_id) JOIN n USING (temp_cluster) JOIN medoid m USING (temp_cluster) JOIN spec r ON r.doc_id = m.doc_id"""
)
def exported_tables(spark, sf):
    """The result tables of one batch as files, read back and joined."""
    folder, _ = _exported(spark, sf)
    info = read_tsv(spark, f"{folder}/cluster_info.tsv").select(
        F.col("cluster").cast("bigint"), "filename", F.col("scan").cast("bigint"), F.col("precursor_mz").cast("double"),
        F.col("retention_time").cast("double"), "new_batch",
    )
    summary = read_tsv(spark, f"{folder}/cluster_summary.tsv").select(
        F.col("cluster index").cast("bigint").alias("cluster"), F.col("number of spectra").cast("bigint").alias("cluster_size"),
        F.col("parent mass").cast("double").alias("parent_mass"), F.col("precursor charge").cast("int").alias("precursor_charge"),
    )
    return info.join(summary, "cluster")


@query(
    "WITH RECURSIVE "
    + LABELS_SQL
    + MEDOID_SQL
    + """, n AS (SELECT temp_cluster, count(*) AS n FROM label GROUP BY temp_cluster),
drawn AS (
  SELECT temp_cluster, doc_id,
         row_number() OVER (PARTITION BY temp_cluster ORDER BY md5('0|/docs/documents.mzML|' || doc_id), doc_id) AS k
  FROM label JOIN n USING (temp_cluster) WHERE n > 5),
out AS (
  SELECT 'consensus' AS kind, temp_cluster + 1 AS number, doc_id FROM medoid
  UNION ALL SELECT 'consensus', temp_cluster + 1, doc_id FROM drawn WHERE k <= 5
  UNION ALL SELECT 'singletons', doc_id, doc_id FROM spec WHERE doc_id NOT IN (SELECT doc_id FROM label))
SELECT kind, number, mass AS precursor_mz, charge, coalesce(p.n, 0)::BIGINT AS n_peaks
FROM out JOIN spec USING (doc_id) LEFT JOIN (SELECT doc_id, sum(it) AS n FROM pk GROUP BY doc_id) p USING (doc_id)"""
)
def exported_spectra(spark, sf):
    """The spectra that a batch exports, read back: representatives, samples of large clusters, singletons."""
    folder, _ = _exported(spark, sf)
    rows = read_mzml(spark, [f"{folder}/consensus", f"{folder}/singletons"], "FAILFAST")
    return rows.select(
        F.element_at(F.split("path", "/"), -2).alias("kind"), F.col("scan").alias("number"), "precursor_mz", "charge",
        F.size("mz").cast("bigint").alias("n_peaks"),
    )


# Nodes of phase 1 with their place, the first component of a known cluster, and medoids of all three steps.
REPRESENTATIVES_SQL = (
    TWO_BATCHES_SQL[: TWO_BATCHES_SQL.rindex("SELECT a.cluster_id")]
    + """,
place AS (
  SELECT k, doc_id, root, CASE WHEN k LIKE 'c%' THEN 'consensus_' || known ELSE '/docs/documents.mzML' END AS path,
         CASE WHEN k LIKE 'c%' THEN known ELSE doc_id END AS scan FROM n1 JOIN g1 USING (k)),
chosen AS (
  SELECT cluster_id, arg_min(root, f) AS root
  FROM (SELECT root, min((path, scan)) AS f FROM place GROUP BY root) JOIN id1 USING (root) GROUP BY cluster_id),
grp AS MATERIALIZED (
  SELECT cluster_id, 1 AS updated_batch, path, scan, doc_id FROM place JOIN chosen USING (root)
  UNION ALL SELECT cluster_id, 1, '/docs/documents.mzML', doc_id, doc_id FROM m2),
gsum AS MATERIALIZED (SELECT cluster_id, bin, sum(w) AS s FROM vec JOIN grp USING (doc_id) GROUP BY ALL),
gscore AS (
  SELECT cluster_id, path, scan, doc_id, round(sum(w * s) / any_value(n), 9) AS score
  FROM vec JOIN grp USING (doc_id) JOIN gsum USING (cluster_id, bin)
  JOIN (SELECT cluster_id, count(*) AS n FROM grp GROUP BY ALL) USING (cluster_id) GROUP BY ALL),
renewed AS (SELECT cluster_id, arg_min(doc_id, (-score, path, scan)) AS doc_id FROM gscore GROUP BY cluster_id),
every AS (
  SELECT cluster_id, doc_id, 1::BIGINT AS updated_batch FROM renewed
  UNION ALL SELECT cluster_id, doc_id, 0 FROM medoid WHERE cluster_id NOT IN (SELECT cluster_id FROM renewed))
SELECT cluster_id::BIGINT AS cluster_id, mass AS precursor_mz, charge, n::BIGINT AS n_peaks, updated_batch
FROM every JOIN spec USING (doc_id) JOIN (SELECT doc_id, sum(it) AS n FROM pk GROUP BY doc_id) USING (doc_id)"""
)


@query(REPRESENTATIVES_SQL)
def two_batch_representatives(spark, sf):
    """What stands for each cluster after two batches, and which batch renewed it last."""
    spectra = document_spectra(spark, sf)
    state = State(spark, f"{Scratch(spark).root}/state")
    for batch in (0, 1):
        run_batch(spectra.where(F.col("scan") % 2 == batch), state, batch, PARAMS)
    return state.current_consensus().select(
        "cluster_id", "precursor_mz", "charge", F.size("mz").cast("bigint").alias("n_peaks"), "updated_batch"
    )


# Line items as stored spectra: one row per (path, scan), as a batch has them.
ONCE_SQL = SL + ", once AS (SELECT path, scan, min(precursor_mz) AS precursor_mz FROM scan_list GROUP BY path, scan)"


def _spectra_once(spark, sf):
    rows = scan_list(spark, sf).groupBy("path", "scan")
    return rows.agg(F.min("precursor_mz").alias("precursor_mz"), F.min("retention_time").alias("retention_time"))


def _as_store(rows, batch):
    return schemas.conform(
        rows.withColumn("rt_sec", F.col("retention_time")).withColumn("batch_id", F.lit(batch)), schemas.STORE
    )


@query(
    ONCE_SQL
    + """
SELECT path, scan, CASE WHEN scan % 5 = 0 THEN precursor_mz + 2 WHEN scan % 3 = 0 THEN precursor_mz + 1 ELSE precursor_mz END AS precursor_mz,
       CASE WHEN scan % 5 = 0 THEN 2 WHEN scan % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS batch_id FROM once"""
)
def compacted_store(spark, sf):
    """Three batches that renew each other's spectra; the first two are compacted and their folders dropped."""
    state = State(spark, f"{Scratch(spark).root}/state")
    rows = _spectra_once(spark, sf)
    for batch, some in enumerate((rows, rows.where("scan % 3 = 0"), rows.where("scan % 5 = 0"))):
        state.write("store", batch, _as_store(some.withColumn("precursor_mz", F.col("precursor_mz") + batch), batch))
        state.commit(batch)
        if batch == 1:
            state.compact("store")
            state.drop_replaced("store")
    return state.store().select("path", "scan", "precursor_mz", "batch_id")


@query(
    ONCE_SQL
    + ", "
    + CONSENSUS_SQL
    + """, k AS (SELECT max(cluster_id) AS c FROM consensus), s AS (SELECT max((scan, path)) AS m FROM once)
SELECT 'representative' AS kind, cluster_id AS id, precursor_mz, true AS stored FROM consensus, k WHERE cluster_id = c
UNION ALL
SELECT 'spectrum', scan, precursor_mz + 1, false FROM once, s WHERE (scan, path) = m"""
)
def point_reads(spark, sf):
    """One representative and one stored spectrum by key from whole tables, and a probe for keys that are not there."""
    state = State(spark, f"{Scratch(spark).root}/state")
    rows = _spectra_once(spark, sf)
    for batch in (0, 1):
        state.write("store", batch, _as_store(rows.withColumn("precursor_mz", F.col("precursor_mz") + batch), batch))
        state.write("consensus", batch, consensus(spark, sf))
        state.commit(batch)
    cluster = state.read("consensus").agg(F.max("cluster_id")).first()[0]
    last = state.read("store").agg(F.max(F.struct("scan", "path")).alias("m")).first()["m"]
    there = store.present(state.read("consensus"), cluster_id=cluster)
    absent = store.present(state.read("store"), path=last.path, scan=-1)
    one = state.representative(cluster).select(
        F.lit("representative").alias("kind"), F.col("cluster_id").alias("id"), "precursor_mz", F.lit(there).alias("stored")
    )
    two = state.spectrum(last.path, last.scan).select(F.lit("spectrum"), "scan", "precursor_mz", F.lit(absent))
    return one.unionAll(two)


@query(
    SL
    + ", "
    + CONSENSUS_SQL
    + """, asked AS (
  SELECT DISTINCT CASE WHEN batch_id % 2 = 0 THEN 'consensus_' || cluster_id ELSE path END AS path, scan FROM scan_list)
SELECT a.path, a.scan, c.precursor_mz FROM asked a JOIN consensus c ON a.path = 'consensus_' || c.cluster_id
UNION ALL
SELECT a.path, a.scan, s.precursor_mz FROM asked a JOIN scan_list s ON a.path = s.path AND a.scan = s.scan"""
)
def stored_or_representative(spark, sf):
    """Spectra by (path, scan), where some paths name a representative."""
    rows = scan_list(spark, sf)
    name = F.concat(F.lit("consensus_"), F.col("cluster_id").cast("string"))
    wanted = rows.select(F.when(F.col("batch_id") % 2 == 0, name).otherwise(F.col("path")).alias("path"), "scan")
    reps = schemas.conform(consensus(spark, sf), schemas.CONSENSUS)
    return stored_or_consensus(wanted, _as_store(rows, 0), reps).select("path", "scan", "precursor_mz")


@F.pandas_udf(T.BinaryType())
def _packed(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else np.asarray(v, dtype="<f4").tobytes())


@query(
    """
SELECT vec_id, coalesce(len(embedding), 0)::BIGINT AS n,
       round(coalesce(list_sum(list_transform(embedding, lambda x: x::FLOAT::DOUBLE)), 0), 6) AS total FROM embeddings"""
)
def float_arrays(spark, sf):
    """Vectors as raw 32-bit values, decoded."""
    raw = table(spark, sf, "embeddings").select("vec_id", _packed("embedding").alias("raw"))
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return decode_arrays(raw, {"raw": "values"}).select(
        "vec_id", F.size("values").cast("bigint").alias("n"), F.round(total, 6).alias("total")
    )


@query(
    """
WITH m AS (
  SELECT l_orderkey AS cluster_id, l_quantity, l_extendedprice, l_discount,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS member_no FROM lineitem)
SELECT cluster_id, member_no::INT AS member_no, l_extendedprice::FLOAT::DOUBLE AS mz, l_discount::FLOAT::DOUBLE AS intensity
FROM m WHERE l_quantity % 4 > 0"""
)
def member_pools(spark, sf):
    """Pools of packed member spectra per cluster, some members empty, read as one row per member."""
    folder = f"{Scratch(spark).root}/pools"
    full = F.col("l_quantity") % 4 > 0
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("cluster_id"), "l_linenumber", "l_partkey", "l_suppkey",
        *[
            _packed(F.when(full, F.array(c)).otherwise(F.array().cast("array<double>"))).alias(n)
            for c, n in (("l_extendedprice", "m"), ("l_discount", "i"))
        ],
    )
    order = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "m", "i")))
    pools = lines.groupBy("cluster_id").agg(order.alias("p"))
    pools.select("cluster_id", F.col("p.m").alias("spec_pool_mz"), F.col("p.i").alias("spec_pool_intensity")).write.parquet(folder)
    return read_member_pools(spark, folder).select(
        "cluster_id", "member_no", F.get("mz", F.lit(0)).alias("mz"), F.get("intensity", F.lit(0)).alias("intensity")
    )
