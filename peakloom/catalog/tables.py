"""Result tables, samples, the spectrum store and mass-tolerance joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakloom.catalog import query
from peakloom.catalog.inputs import CONSENSUS_SQL, SCAN_LIST_SQL, consensus, scan_list, table
from peakloom.operators import sample, store, summary
from peakloom.operators.ids import dense_index, highest_id
from peakloom.operators.rangejoin import tolerance_chains, tolerance_self_join
from peakloom.params import Tolerance
from peakloom.session import Scratch

SL = "WITH " + SCAN_LIST_SQL


@query(
    SL
    + """
SELECT cluster_id AS cluster, filename, scan, precursor_mz, retention_time,
       CASE WHEN batch_id = 1998 THEN 'yes' ELSE 'no' END AS new_batch FROM scan_list"""
)
def cluster_info(spark, sf):
    return summary.cluster_info(scan_list(spark, sf), batch_id=1998)


@query(
    SL
    + """
SELECT cluster_id AS cluster, s.filename, scan, precursor_mz, retention_time,
       CASE WHEN f.filename IS NOT NULL THEN 'yes' ELSE 'no' END AS new_batch
FROM scan_list s LEFT JOIN (
  SELECT DISTINCT 'p' || l_partkey || '_s' || l_suppkey || '.mzML' AS filename FROM lineitem WHERE l_returnflag = 'R') f
ON s.filename = f.filename"""
)
def new_batch_by_name(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    files = lines.select(
        F.format_string("p%d_s%d.mzML", "l_partkey", "l_suppkey").alias("filename")
    )
    return summary.cluster_info(scan_list(spark, sf), batch_files=files)


@query(
    SL
    + ","
    + CONSENSUS_SQL
    + """,
m AS (SELECT cluster_id, count(*) AS n_spectra, avg(retention_time) AS rt_mean,
             arg_min(precursor_mz, (batch_id, path, scan)) AS first_mz FROM scan_list GROUP BY cluster_id)
SELECT m.cluster_id AS cluster_index, n_spectra,
       coalesce(nullif(c.precursor_mz, 0), first_mz) AS parent_mass, coalesce(charge, 1) AS precursor_charge,
       coalesce(nullif(c.precursor_mz, 0), first_mz) AS precursor_mass, 0 AS sum_precursor_intensity,
       round(rt_mean, 6) AS rt_mean
FROM m LEFT JOIN consensus c ON m.cluster_id = c.cluster_id"""
)
def cluster_summary(spark, sf):
    return summary.cluster_summary(scan_list(spark, sf), consensus(spark, sf)).withColumn(
        "rt_mean", F.round("rt_mean", 6)
    )


# Masses in whole hundredths: their sums are exact, whatever the order of addition.
@query(
    """
SELECT l_orderkey AS cluster_id, count(*) AS n, avg(round(l_extendedprice * 100)::BIGINT) AS mean_mz,
       avg(l_quantity) AS mean_rt, avg(l_linenumber) AS mean_charge
FROM lineitem GROUP BY l_orderkey"""
)
def cluster_means(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("cluster_id"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("precursor_mz"),
        F.col("l_quantity").alias("retention_time"),
        F.col("l_linenumber").alias("charge"),
    )
    return summary.cluster_means(rows)


@query(SL + "SELECT coalesce(max(cluster_id), 0) AS max_cluster_id FROM scan_list")
def max_cluster_id(spark, sf):
    return scan_list(spark, sf).agg(highest_id().alias("max_cluster_id"))


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_partkey END AS cluster,
       row_number() OVER (ORDER BY CASE WHEN l_returnflag <> 'R' THEN l_partkey END NULLS LAST,
                          l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place
FROM lineitem"""
)
def noise_last_order(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, sf, "lineitem").select(
        *keys, F.when(F.col("l_returnflag") == "R", -1).otherwise(F.col("l_partkey")).cast("bigint").alias("cluster")
    )
    return dense_index(rows, [summary.noise_last(F.col("cluster")), *map(F.col, keys)], "place", Scratch(spark))


@query(
    SL
    + """, r AS (
  SELECT cluster_id, path, scan, count(*) OVER (PARTITION BY cluster_id) AS n,
         row_number() OVER (PARTITION BY cluster_id ORDER BY md5('0|' || path || '|' || scan), path, scan) AS sample_no
  FROM scan_list)
SELECT cluster_id, path, scan, sample_no::INT AS sample_no FROM r WHERE n > 5 AND sample_no <= 5"""
)
def sample_draw(spark, sf):
    return sample.draw_samples(scan_list(spark, sf)).select("cluster_id", "path", "scan", "sample_no")


@query(
    SL
    + """, old AS (SELECT DISTINCT cluster_id FROM scan_list WHERE batch_id < 1996), r AS (
  SELECT cluster_id, path, scan, count(*) OVER (PARTITION BY cluster_id) AS n,
         row_number() OVER (PARTITION BY cluster_id ORDER BY md5('7|' || path || '|' || scan), path, scan) AS sample_no
  FROM scan_list)
SELECT cluster_id, path, scan, sample_no::INT AS sample_no FROM r
WHERE n > 3 AND sample_no <= 3 AND cluster_id NOT IN (SELECT cluster_id FROM old)"""
)
def sample_draw_once(spark, sf):
    rows = scan_list(spark, sf)
    return sample.draw_samples(rows, rows.where("batch_id < 1996"), 3, "7").select("cluster_id", "path", "scan", "sample_no")


@query(
    SL
    + """
SELECT cluster_id, path, scan FROM scan_list
WHERE cluster_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""
)
def samples_of_clusters(spark, sf):
    clusters = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("cluster_id"))
    return sample.samples_of_clusters(scan_list(spark, sf), clusters).select("cluster_id", "path", "scan")


@query(
    SL
    + """, n AS (SELECT cluster_id, count(*) AS n FROM scan_list GROUP BY cluster_id),
s AS (
  SELECT cluster_id, path, scan, batch_id,
         row_number() OVER (PARTITION BY cluster_id ORDER BY md5('0|' || path || '|' || scan), path, scan) AS k
  FROM scan_list)
SELECT DISTINCT path, scan FROM (
  SELECT path, scan FROM s JOIN n USING (cluster_id) WHERE n > 5 AND k <= 5 AND batch_id = 1998
  UNION ALL SELECT path, scan FROM scan_list JOIN n USING (cluster_id) WHERE n <= 5 AND batch_id = 1998
  UNION ALL SELECT path, scan FROM scan_list WHERE batch_id = 1998 AND precursor_mz < 2000)"""
)
def scans_to_keep(spark, sf):
    rows = scan_list(spark, sf)
    return sample.scans_to_keep(rows, sample.draw_samples(rows), rows.where("precursor_mz < 2000"), 1998)


@query(
    SL
    + """, r AS (
  SELECT cluster_id, path, scan, count(*) OVER (PARTITION BY cluster_id) AS n,
         row_number() OVER (PARTITION BY cluster_id ORDER BY md5('0|' || path || '|' || scan), path, scan) AS k
  FROM scan_list)
SELECT cluster_id, cluster_id || '_' || k AS out_id, 'sample' AS kind, path, scan FROM r WHERE n >= 4 AND k <= 4
UNION ALL
SELECT cluster_id, CASE WHEN count(*) >= 4 THEN cluster_id || '_5' ELSE cluster_id::VARCHAR END, 'representative', NULL, NULL
FROM scan_list GROUP BY cluster_id"""
)
def renumbered_pool(spark, sf):
    return sample.renumbered_pool(scan_list(spark, sf), 4)


@query(
    SL
    + """
SELECT cluster_id, count(*) AS members, CASE WHEN count(*) = 1 THEN 'raw' WHEN count(*) <= 5 THEN 'representative'
       ELSE 'representative+samples' END AS export FROM scan_list GROUP BY cluster_id"""
)
def export_by_size(spark, sf):
    return sample.size_policy(scan_list(spark, sf))


@query(
    SL
    + """
SELECT cluster_id, path, scan, precursor_mz, retention_time FROM scan_list"""
)
def nest_and_flatten(spark, sf):
    return summary.flattened(summary.nested(scan_list(spark, sf)))


# Events as repeated writes to a store: the user names the spectrum, time and id order the writes.
@query(
    """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
WHERE n = 1"""
)
def latest_write(spark, sf):
    rows = store.latest(table(spark, sf, "events"), ["ts", "event_id"], ["user_id", "event_type"])
    return rows.select("user_id", "event_type", "event_id", "value")


@query(
    SL
    + """
SELECT path, scan, precursor_mz FROM scan_list
WHERE (path, scan) IN (SELECT path, scan FROM scan_list WHERE precursor_mz > 50000)"""
)
def store_lookup(spark, sf):
    rows = scan_list(spark, sf)
    wanted = rows.where("precursor_mz > 50000").select("path", "scan")
    return store.lookup(rows, wanted.unionAll(wanted)).select("path", "scan", "precursor_mz")


@query(
    SL
    + """
SELECT DISTINCT path, scan, batch_id < 1998 AS found FROM scan_list"""
)
def store_lookup_report(spark, sf):
    rows = scan_list(spark, sf)
    return store.lookup_report(rows.where("batch_id < 1998"), rows)


@query(
    SL
    + """
SELECT path, scan, cluster_id FROM scan_list
WHERE (path, scan) NOT IN (SELECT path, scan FROM scan_list WHERE retention_time > 1200)"""
)
def store_remove(spark, sf):
    rows = scan_list(spark, sf)
    return store.remove(rows, rows.where("retention_time > 1200")).select("path", "scan", "cluster_id")


@query(
    """
SELECT count(*) AS spectrum_count, coalesce(sum(n_chars), 0)::BIGINT AS peak_count,
       coalesce(sum(24 + 8 * n_chars), 0)::BIGINT AS total_size,
       round(coalesce(sum(24 + 8 * n_chars), 0)::DOUBLE / 1048576, 9) AS total_size_mb FROM documents"""
)
def store_stats(spark, sf):
    return store.stats(table(spark, sf, "documents"), F.col("n_chars")).withColumn(
        "total_size_mb", F.round("total_size_mb", 9)
    )


@query(
    SL
    + ","
    + CONSENSUS_SQL
    + """
SELECT s.cluster_id, max(c.precursor_mz) AS precursor_mz, max(c.charge) AS charge, count(*) AS n_spectra
FROM scan_list s LEFT JOIN consensus c ON s.cluster_id = c.cluster_id GROUP BY s.cluster_id"""
)
def consensus_of_clusters(spark, sf):
    return summary.clusters_with_consensus(scan_list(spark, sf), consensus(spark, sf).drop("updated_batch"))


@query(
    SL
    + """
SELECT filename, count(*) AS n_scans, count(DISTINCT cluster_id) AS n_clusters FROM scan_list GROUP BY filename"""
)
def scans_per_file(spark, sf):
    return summary.scans_per_file(scan_list(spark, sf))


def _line_key():
    return ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")).alias("id")


@query(
    """
WITH l AS (SELECT (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS id, l_suppkey, l_extendedprice AS v FROM lineitem)
SELECT l_suppkey, a.id AS id_l, b.id AS id_r, a.v AS v_l, b.v AS v_r
FROM l a JOIN l b USING (l_suppkey)
WHERE (a.v < b.v OR (a.v = b.v AND a.id < b.id)) AND b.v - a.v <= 20 * 1e-6::DOUBLE * b.v"""
)
def ppm_join(spark, sf):
    rows = table(spark, sf, "lineitem").select(_line_key(), "l_suppkey", F.col("l_extendedprice").alias("v"))
    return tolerance_self_join(rows, "v", "id", Tolerance.parse("20 ppm"), Scratch(spark), ["l_suppkey"])


@query(
    """
SELECT a.user_id, a.event_id AS event_id_l, b.event_id AS event_id_r, a.value AS value_l, b.value AS value_r
FROM events a JOIN events b ON a.user_id = b.user_id AND a.value <= b.value
WHERE (a.value < b.value OR a.event_id < b.event_id) AND b.value - a.value <= 0.125::DOUBLE"""
)
def da_join(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    return tolerance_self_join(rows, "value", "event_id", Tolerance.parse("0.125 Da"), Scratch(spark), ["user_id"])


@query(
    """
WITH RECURSIVE l AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS id, l_suppkey, l_extendedprice AS v FROM lineitem),
e AS MATERIALIZED (
  SELECT a.id AS x, b.id AS y FROM l a JOIN l b USING (l_suppkey)
  WHERE a.id <> b.id AND abs(b.v - a.v) <= 20 * 1e-6::DOUBLE * greatest(a.v, b.v)),
r AS (SELECT DISTINCT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT x AS node, min(y) AS root FROM r GROUP BY x"""
)
def mass_components(spark, sf):
    rows = table(spark, sf, "lineitem").select(_line_key(), "l_suppkey", F.col("l_extendedprice").alias("v"))
    return tolerance_chains(rows, "v", "id", Tolerance.parse("20 ppm"), Scratch(spark), ["l_suppkey"])
