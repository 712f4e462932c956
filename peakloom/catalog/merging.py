"""Merging a clustering result into known clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakloom.catalog import query
from peakloom.catalog.inputs import CONSENSUS_SQL, ROWS_SQL, clustering_rows, consensus, table
from peakloom.functions import text
from peakloom.operators import merge
from peakloom.operators.ids import max_id
from peakloom.session import Scratch

RS = "WITH " + ROWS_SQL


@query(RS + "SELECT temp_cluster, path, scan, route FROM routed")
def route_rows(spark, sf):
    return merge.routed(clustering_rows(spark, sf)).select("temp_cluster", "path", "scan", "route")


@query(RS + "SELECT temp_cluster, cluster_id FROM known")
def known_cluster_map(spark, sf):
    return merge.known_map(merge.routed(clustering_rows(spark, sf)))


@query(
    RS
    + """
SELECT DISTINCT k.cluster_id AS kept_id, r.ref_cluster AS other_id
FROM routed r JOIN known k ON r.temp_cluster = k.temp_cluster
WHERE r.route = 'consensus' AND r.ref_cluster IS NOT NULL AND r.ref_cluster <> k.cluster_id"""
)
def merge_candidates(spark, sf):
    return merge.met_clusters(merge.routed(clustering_rows(spark, sf)))


@query(RS + "SELECT temp_cluster, cluster_id, is_new FROM idmap")
def new_cluster_ids(spark, sf):
    base = max_id(table(spark, sf, "orders"), "o_orderkey")
    return merge.id_map(merge.routed(clustering_rows(spark, sf)), base, Scratch(spark))


@query(
    RS
    + """
SELECT i.cluster_id, r.path, r.scan, r.precursor_mz FROM routed r JOIN idmap i ON r.temp_cluster = i.temp_cluster
WHERE r.route = 'member'"""
)
def incremental_merge(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("cluster_id"))
    result = merge.merge_clusters(
        clustering_rows(spark, sf), max_id(orders), Scratch(spark), clusters=orders
    )
    return result.members.select("cluster_id", "path", "scan", "precursor_mz")


@query(RS + "SELECT path, scan, precursor_mz, rt_sec FROM routed WHERE route = 'noise'")
def merge_singletons(spark, sf):
    result = merge.merge_clusters(clustering_rows(spark, sf), max_id(table(spark, sf, "orders"), "o_orderkey"), Scratch(spark))
    return result.singletons.select("path", "scan", "precursor_mz", "rt_sec")


@query(
    RS
    + """, top AS (SELECT greatest((SELECT top FROM base), (SELECT max(cluster_id) FROM idmap)) AS t)
SELECT i.cluster_id, r.path, r.scan FROM routed r JOIN idmap i ON r.temp_cluster = i.temp_cluster WHERE r.route = 'member'
UNION ALL
SELECT (SELECT t FROM top) + row_number() OVER (ORDER BY path, scan), path, scan FROM routed WHERE route = 'noise'"""
)
def merge_with_singleton_clusters(spark, sf):
    result = merge.merge_clusters(
        clustering_rows(spark, sf),
        max_id(table(spark, sf, "orders"), "o_orderkey"),
        Scratch(spark),
        singletons_as_clusters=True,
    )
    return result.members.select("cluster_id", "path", "scan")


@query(
    RS
    + """
SELECT temp_cluster + 1 AS cluster_id, path, scan FROM rws WHERE temp_cluster <> -1 AND source <> 'consensus'
UNION ALL SELECT NULL, path, scan FROM rws WHERE temp_cluster = -1 AND source <> 'consensus'"""
)
def initial_merge(spark, sf):
    result = merge.initial_clusters(clustering_rows(spark, sf), Scratch(spark))
    singles = result.singletons.withColumn("cluster_id", F.lit(None).cast("bigint"))
    return result.members.select("cluster_id", "path", "scan").unionByName(singles.select("cluster_id", "path", "scan"))


@query(
    RS
    + """, m AS (SELECT temp_cluster AS cluster_id, path, scan FROM rws WHERE temp_cluster <> -1 AND source <> 'consensus')
SELECT * FROM m UNION ALL
SELECT (SELECT max(cluster_id) FROM m) + row_number() OVER (ORDER BY path, scan), path, scan
FROM rws WHERE temp_cluster = -1 AND source <> 'consensus'"""
)
def initial_merge_with_singleton_clusters(spark, sf):
    result = merge.initial_clusters(clustering_rows(spark, sf), Scratch(spark), shift=0, singletons_as_clusters=True)
    return result.members.select("cluster_id", "path", "scan")


@query(
    "WITH "
    + CONSENSUS_SQL
    + """, fresh AS (
  SELECT l_orderkey AS cluster_id, max(l_extendedprice) AS precursor_mz, max(l_linenumber) AS charge, 2000::BIGINT AS updated_batch
  FROM lineitem GROUP BY l_orderkey)
SELECT * FROM fresh UNION ALL SELECT * FROM consensus WHERE cluster_id NOT IN (SELECT cluster_id FROM fresh)"""
)
def representative_overwrite(spark, sf):
    fresh = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("cluster_id")).agg(
        F.max("l_extendedprice").alias("precursor_mz"),
        F.max("l_linenumber").alias("charge"),
        F.lit(2000).cast("bigint").alias("updated_batch"),
    )
    return merge.overwrite(consensus(spark, sf), fresh, ["cluster_id"])


@query(
    """
WITH old AS (SELECT o_custkey AS cluster_id, min(o_orderkey) AS scan, min(o_totalprice) AS mass FROM orders GROUP BY o_custkey),
fresh AS (SELECT c_custkey + e.d AS cluster_id, c_nationkey::BIGINT AS scan, c_acctbal AS mass, c_custkey AS seq
          FROM customer, (VALUES (0), (100000)) e(d)),
again AS (SELECT cluster_id, scan, mass, seq FROM fresh UNION ALL SELECT cluster_id, scan + 1, mass + 1, seq + 1 FROM fresh)
SELECT cluster_id, scan, mass FROM old UNION ALL
SELECT cluster_id, arg_min(scan, seq), arg_min(mass, seq) FROM again
WHERE cluster_id NOT IN (SELECT cluster_id FROM old) GROUP BY cluster_id"""
)
def append_distinct(spark, sf):
    old = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("cluster_id")).agg(
        F.min("o_orderkey").alias("scan"), F.min("o_totalprice").alias("mass")
    )
    fresh = table(spark, sf, "customer").select(
        F.explode(F.array(F.col("c_custkey"), F.col("c_custkey") + 100000)).alias("cluster_id"),
        F.col("c_nationkey").cast("bigint").alias("scan"),
        F.col("c_acctbal").alias("mass"),
        F.col("c_custkey").alias("seq"),
    )
    again = fresh.unionByName(
        fresh.withColumn("scan", F.col("scan") + 1).withColumn("mass", F.col("mass") + 1).withColumn("seq", F.col("seq") + 1)
    )
    return merge.append_distinct(old, again, ["cluster_id"], ["seq"])


@query(
    r"""
WITH m AS (SELECT page_id, '/d/' || url || '.mzML' AS full_path FROM pages),
k AS (SELECT page_id, full_path, substr(md5(full_path), 1, 8) || '_' || regexp_extract(full_path, '([^/]+)\.mzML$', 1) AS path_key FROM m)
SELECT path_key, page_id AS scan, full_path FROM k"""
)
def path_map_union(spark, sf):
    """Two overlapping path maps united, and every short key resolved again."""
    path = F.concat(F.lit("/d/"), "url", F.lit(".mzML"))
    maps = table(spark, sf, "pages").select("page_id", path.alias("full_path"), text.path_key(path).alias("path_key"))
    one, two = maps.where("page_id % 3 < 2").drop("page_id"), maps.where("page_id % 3 > 0").drop("page_id")
    wanted = maps.select("path_key", F.col("page_id").alias("scan"))
    return merge.with_map(wanted, merge.union_maps(one, two))
