"""Clustering of spectra, representatives, networks, and whole batches."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from peakloom.catalog import query
from peakloom.catalog.inputs import EDGES_SQL, LABELS_SQL, PARAMS, SPECTRA_SQL, document_peaks, document_spectra, table
from peakloom.functions.text import native_id
from peakloom.operators.approximate import IndexParams, approximate_pairs
from peakloom.operators.cluster import cluster_spectra, medoids, neighbour_pairs, prepare, saved_pairs, scored_pairs
from peakloom.operators.network import merge_shards, network_pairs, prepare_network
from peakloom.operators.summary import cluster_summary
from peakloom.plans.incremental import run_batch
from peakloom.plans.state import State
from peakloom.session import Scratch, write_table
from peakloom.sources.mgf import read_mgf
from peakloom.sources.mzml import only_ms2, parse_chunks, read_mzml
from peakloom.sources.mzml_writer import write_mzml
from peakloom.streaming import landing


@query("WITH " + EDGES_SQL + "SELECT x, y, round(cosine, 6) AS cosine FROM edges")
def eps_pairs(spark, sf):
    return neighbour_pairs(document_spectra(spark, sf), PARAMS, Scratch(spark)).select(
        F.least("scan_l", "scan_r").alias("x"), F.greatest("scan_l", "scan_r").alias("y"), F.round("cosine", 6).alias("cosine")
    )


@query(
    "WITH RECURSIVE "
    + LABELS_SQL
    + "SELECT s.doc_id AS scan, coalesce(temp_cluster, -1) AS temp_cluster FROM spec s LEFT JOIN label l USING (doc_id)"
)
def dbscan_labels(spark, sf):
    return cluster_spectra(document_spectra(spark, sf), PARAMS, Scratch(spark)).assign.select("scan", "temp_cluster")


@query(
    "WITH RECURSIVE "
    + EDGES_SQL
    + """,
sided AS MATERIALIZED (SELECT x, y, cosine FROM edges UNION ALL SELECT y, x, cosine FROM edges),
core AS MATERIALIZED (SELECT x AS doc_id FROM sided GROUP BY x HAVING count(*) + 1 >= 4),
inner_edges AS MATERIALIZED (
  SELECT x, y FROM sided WHERE x IN (SELECT doc_id FROM core) AND y IN (SELECT doc_id FROM core)
  UNION ALL SELECT doc_id, doc_id FROM core),
reach AS (SELECT x, y FROM inner_edges UNION SELECT r.x, e.y FROM reach r JOIN inner_edges e ON r.y = e.x),
core_root AS MATERIALIZED (SELECT x AS doc_id, min(y) AS root FROM reach GROUP BY x),
every AS (
  SELECT doc_id, root FROM core_root
  UNION ALL
  SELECT x, arg_min(root, (-round(cosine, 9), y)) FROM sided JOIN core_root ON y = doc_id
  WHERE x NOT IN (SELECT doc_id FROM core) GROUP BY x),
first AS (SELECT root, min(doc_id) AS f FROM every GROUP BY root),
label AS (SELECT doc_id, dense_rank() OVER (ORDER BY f) - 1 AS temp_cluster FROM every JOIN first USING (root))
SELECT s.doc_id AS scan, coalesce(temp_cluster, -1) AS temp_cluster FROM spec s LEFT JOIN label l USING (doc_id)"""
)
def dbscan_of_four(spark, sf):
    """Core spectra have three neighbours or more."""
    params = replace(PARAMS, min_samples=4)
    return cluster_spectra(document_spectra(spark, sf), params, Scratch(spark)).assign.select("scan", "temp_cluster")


@query(
    "WITH " + EDGES_SQL + "SELECT count(*) AS n_exact, true AS recalled, 0::BIGINT AS n_wrong, true AS same_cosines FROM edges"
)
def approximate_recall(spark, sf):
    """The index over 64 lists, 16 of them probed, against the exact list: nine pairs of ten, none wrong."""
    scratch = Scratch(spark)
    vectors = prepare(document_spectra(spark, sf), PARAMS, scratch, peaks=False)
    exact = saved_pairs(scored_pairs, scratch, vectors, PARAMS).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "cosine")
    found = approximate_pairs(vectors, PARAMS, IndexParams(lists=64), scratch).withColumnRenamed("cosine", "found")
    both = exact.join(found, ["x", "y"], "full")
    return both.agg(
        F.count("cosine").alias("n_exact"),
        (F.count(F.when(F.col("cosine").isNotNull(), F.col("found"))) >= 0.9 * F.count("cosine")).alias("recalled"),
        F.count(F.when(F.col("cosine").isNull(), 1)).alias("n_wrong"),
        F.coalesce(F.max(F.abs(F.col("cosine") - F.col("found"))) < 1e-9, F.lit(True)).alias("same_cosines"),
    )


MEDOID_SQL = """,
sums AS (SELECT temp_cluster, bin, sum(w) AS s FROM vec JOIN label USING (doc_id) GROUP BY ALL),
score AS (
  SELECT temp_cluster, doc_id, round(sum(w * s) / any_value(n), 9) AS score
  FROM vec JOIN label USING (doc_id) JOIN sums USING (temp_cluster, bin)
  JOIN (SELECT temp_cluster, count(*) AS n FROM label GROUP BY ALL) USING (temp_cluster) GROUP BY ALL),
medoid AS (SELECT temp_cluster, arg_min(doc_id, (-score, doc_id)) AS doc_id FROM score GROUP BY temp_cluster)"""


@query(
    "WITH RECURSIVE "
    + LABELS_SQL
    + MEDOID_SQL
    + """
SELECT m.temp_cluster, m.doc_id AS scan, s.mass AS precursor_mz, s.charge FROM medoid m JOIN spec s USING (doc_id)"""
)
def cluster_representatives(spark, sf):
    reps = cluster_spectra(document_spectra(spark, sf), PARAMS, Scratch(spark)).representatives
    return reps.select("temp_cluster", "scan", "precursor_mz", "charge")


@query(
    """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT a.label, a.vec_id, round(avg(list_dot_product(a.v, b.v)), 9) AS score FROM e a JOIN e b ON a.label = b.label GROUP BY ALL)
SELECT label::BIGINT AS root, arg_min(vec_id, (-score, vec_id)) AS spec_id FROM p GROUP BY label"""
)
def embedding_medoids(spark, sf):
    """Representative of each label among the embedding vectors."""
    e = table(spark, sf, "embeddings")
    labels = e.select(
        F.col("label").cast("bigint").alias("root"), F.col("vec_id").alias("node"), F.col("vec_id").alias("spec_id"),
        F.lit("/e").alias("path"), F.col("vec_id").alias("scan"),
    )
    size = F.size("embedding")
    vectors = e.select(
        F.col("vec_id").alias("spec_id"),
        F.sequence(F.lit(0), size - 1).cast("array<bigint>").alias("bins"),
        F.col("embedding").cast("array<double>").alias("weights"),
    )
    return medoids(labels, vectors, Scratch(spark))


NETWORK_SQL = (
    "WITH "
    + SPECTRA_SQL
    + """, u AS MATERIALIZED (SELECT doc_id, mz, it / sqrt(sum(it * it) OVER (PARTITION BY doc_id)) AS w FROM pk)
SELECT a.doc_id AS left_id, b.doc_id AS right_id, round(sum(a.w * b.w), 6) AS cosine, count(*)::INT AS matched_peaks,
       any_value(sb.mass) - any_value(sa.mass) AS delta_mz
FROM u a JOIN u b ON a.mz = b.mz AND a.doc_id < b.doc_id
JOIN spec sa ON sa.doc_id = a.doc_id JOIN spec sb ON sb.doc_id = b.doc_id
GROUP BY 1, 2 HAVING sum(a.w * b.w) >= 0.8::DOUBLE"""
)


# Peaks of these spectra stand 0.1 apart, so within the tolerance of 0.05 they match only if equal.
@query(NETWORK_SQL)
def network(spark, sf):
    pairs = network_pairs(document_peaks(spark, sf), replace(PARAMS, min_cosine=0.8), Scratch(spark))
    return pairs.withColumn("cosine", F.round("cosine", 6))


@query(NETWORK_SQL)
def network_shifted(spark, sf):
    """The same with the peaks of odd documents 0.03 off, so that each match needs the tolerance."""
    off = F.lit(0.03) * (F.col("id") % 2)
    peaks = document_peaks(spark, sf).withColumn("mz", F.transform("mz", lambda m: m + off))
    pairs = network_pairs(peaks, replace(PARAMS, min_cosine=0.8), Scratch(spark))
    return pairs.withColumn("cosine", F.round("cosine", 6))


@query(NETWORK_SQL + " AND count(*) >= 6")
def network_by_shards(spark, sf):
    params, scratch = replace(PARAMS, min_cosine=0.8, min_matched_peaks=6), Scratch(spark)
    peaks = scratch.save(document_peaks(spark, sf), "peaks")
    prepared = prepare_network(peaks, params, scratch)
    shards = [network_pairs(peaks, params, scratch, (k, 3), prepared=prepared) for k in range(3)]
    return merge_shards(*shards).withColumn("cosine", F.round("cosine", 6))


def _changed_sql(peaks: str, score: str, floor: str) -> str:
    """The network over other peaks ``pk2`` (doc_id, mz, it) or another score of weights a.w and b.w."""
    return (
        "WITH "
        + SPECTRA_SQL
        + peaks
        + f"""
SELECT a.doc_id AS left_id, b.doc_id AS right_id, {score}, count(*)::INT AS matched_peaks,
       any_value(sb.mass) - any_value(sa.mass) AS delta_mz
FROM u a JOIN u b ON a.mz = b.mz AND a.doc_id < b.doc_id
JOIN spec sa ON sa.doc_id = a.doc_id JOIN spec sb ON sb.doc_id = b.doc_id
GROUP BY 1, 2 HAVING {floor}"""
    )


@query(
    _changed_sql(
        """, far AS MATERIALIZED (SELECT pk.* FROM pk JOIN spec USING (doc_id) WHERE abs(mz - mass) > 17),
weaker AS (
  SELECT a.doc_id, a.mz FROM far a JOIN far b ON a.doc_id = b.doc_id AND b.it > a.it AND abs(b.mz - a.mz) <= 50
  GROUP BY ALL HAVING count(*) >= 6),
pk2 AS (SELECT * FROM far ANTI JOIN weaker USING (doc_id, mz)),
u AS MATERIALIZED (SELECT doc_id, mz, it / sqrt(sum(it * it) OVER (PARTITION BY doc_id)) AS w FROM pk2)""",
        "round(sum(a.w * b.w), 6) AS cosine",
        "sum(a.w * b.w) >= 0.8::DOUBLE",
    )
)
def network_of_strong_peaks(spark, sf):
    """Only peaks away from the precursor and among the strongest of their window."""
    params = replace(PARAMS, min_cosine=0.8, peak_filter=True)
    return network_pairs(document_peaks(spark, sf), params, Scratch(spark)).withColumn("cosine", F.round("cosine", 6))


_GAIN_SQL = "sum((a.w + b.w) * log2(a.w + b.w) - a.w * log2(a.w) - b.w * log2(b.w)) / 2"


@query(
    _changed_sql(
        """, share AS (SELECT doc_id, mz, it / sum(it) OVER (PARTITION BY doc_id) AS p FROM pk),
flat AS (
  SELECT doc_id, mz, p ** CASE WHEN s < 3 THEN 0.25 + 0.25 * s ELSE 1 END AS it
  FROM (SELECT *, -sum(p * ln(p)) OVER (PARTITION BY doc_id) AS s FROM share)),
u AS MATERIALIZED (SELECT doc_id, mz, it / sum(it) OVER (PARTITION BY doc_id) AS w FROM flat)""",
        f"round({_GAIN_SQL}, 6) AS entropy",
        f"{_GAIN_SQL} >= 0.8::DOUBLE",
    )
)
def network_by_entropy(spark, sf):
    """Spectral entropy similarity in place of the cosine."""
    params = replace(PARAMS, min_cosine=0.8, score="entropy")
    return network_pairs(document_peaks(spark, sf), params, Scratch(spark)).withColumn("entropy", F.round("entropy", 6))


@query(
    NETWORK_SQL.replace("any_value(sb.mass) - any_value(sa.mass)", "4000 * (any_value(sb.mass) - any_value(sa.mass))")
    + " AND abs(any_value(sb.mass) - any_value(sa.mass)) <= 200"
)
def network_with_shift(spark, sf):
    """Every other peak moves with the precursor, so it matches after a shift alone; precursors stand 4,000 apart."""
    mass = F.col("precursor_mz") * 4000.0
    peaks = document_peaks(spark, sf).withColumn("precursor_mz", mass)
    peaks = peaks.withColumn(
        "mz", F.transform("mz", lambda m: F.when(F.floor(m * 10.0) % 2 == 0, m + F.col("precursor_mz")).otherwise(m))
    )
    params = replace(PARAMS, min_cosine=0.8, max_mz=1e12, max_shift=800_000.0)
    return network_pairs(peaks, params, Scratch(spark)).withColumn("cosine", F.round("cosine", 6))


@query(
    "WITH RECURSIVE "
    + LABELS_SQL
    + MEDOID_SQL
    + """,
mem AS (SELECT l.temp_cluster + 1 AS cluster_index, count(*) AS n_spectra, avg((doc_id % 3600)::DOUBLE) AS rt FROM label l GROUP BY 1)
SELECT cluster_index, n_spectra, s.mass AS parent_mass, s.charge AS precursor_charge, s.mass AS precursor_mass,
       0 AS sum_precursor_intensity, round(rt, 6) AS rt_mean
FROM mem JOIN medoid d ON d.temp_cluster + 1 = cluster_index JOIN spec s USING (doc_id)"""
)
def clustered_summary(spark, sf):
    """From raw spectra to the per-cluster result table."""
    found = cluster_spectra(document_spectra(spark, sf), PARAMS, Scratch(spark))
    members = found.assign.where("temp_cluster >= 0").select(
        (F.col("temp_cluster") + 1).alias("cluster_id"), "path", "scan", "precursor_mz",
        F.col("rt_sec").alias("retention_time"), F.lit(0).cast("bigint").alias("batch_id"),
    )
    reps = found.representatives.withColumn("cluster_id", F.col("temp_cluster") + 1)
    return cluster_summary(members, reps).withColumn("rt_mean", F.round("rt_mean", 6))


def _as_mgf(spectra):
    """Spectra as MGF blocks, one text row each."""
    peaks = F.array_join(
        F.zip_with("mz", "intensity", lambda m, i: F.concat_ws(" ", m.cast("string"), i.cast("string"))), "\n"
    )
    return spectra.select(
        F.concat_ws(
            "\n", F.lit("BEGIN IONS"), F.concat(F.lit("CLUSTER="), F.col("scan").cast("string")),
            F.concat(F.lit("PEPMASS="), F.col("precursor_mz").cast("string"), F.lit(" 1")),
            F.concat(F.lit("CHARGE="), F.col("charge").cast("string"), F.lit("+")), peaks, F.lit("END IONS"),
        ).alias("value")
    )


ROUND_TRIP_SQL = (
    "WITH "
    + SPECTRA_SQL
    + """
SELECT spec.doc_id AS scan, mass AS precursor_mz, charge, coalesce(n, 0)::BIGINT AS n_peaks, round(coalesce(t, 0), 3) AS mz_total
FROM spec LEFT JOIN (SELECT doc_id, sum(it) AS n, sum(mz * it) AS t FROM pk GROUP BY doc_id) p USING (doc_id)"""
)


def _totals(df, scan):
    return df.select(
        scan.alias("scan"), "precursor_mz", "charge", F.size("mz").cast("bigint").alias("n_peaks"),
        F.round(F.aggregate("mz", F.lit(0.0), lambda a, m: a + m), 3).alias("mz_total"),
    )


@query(ROUND_TRIP_SQL)
def mgf_round_trip(spark, sf):
    folder = f"{Scratch(spark).root}/mgf"
    _as_mgf(document_spectra(spark, sf)).write.text(folder)
    return _totals(read_mgf(spark, folder), F.col("cluster"))


@query(ROUND_TRIP_SQL)
def mzml_round_trip(spark, sf):
    folder = f"{Scratch(spark).root}/mzml"
    write_mzml(document_spectra(spark, sf).withColumn("native_id", native_id(F.col("scan"))), folder)
    return _totals(read_mzml(spark, folder), F.col("scan"))


def _as_mzml_spectrum(kind):
    """Spectra as mzML elements with empty arrays, one text row each; every third MS1, every fifth damaged."""
    scan, mass = F.col("scan").cast("string"), F.col("precursor_mz").cast("string")
    term = '<cvParam accession="MS:%d" value="'
    head = F.concat(F.lit('<spectrum\tindex="'), scan, F.lit('" id="scan='), scan, F.lit('">'))
    level = F.concat(F.lit(term % 1000511), F.when(kind == "ms1", "1").otherwise("2"), F.lit('"/>'))
    around = ["precursorList", "precursor", "selectedIonList", "selectedIon"]
    ion = F.concat(
        F.lit("".join(f"<{t}>" for t in around) + term % 1000744), mass, F.lit('"/>' + "".join(f"</{t}>" for t in around[::-1]))
    )
    start = F.lit(f'<scanList><scan>{term % 1000016}1"/></scan></scanList>')
    return F.concat(
        head, level, F.when(kind == "no ion", "").otherwise(ion), F.when(kind == "no time", "").otherwise(start), F.lit("</spectrum>")
    )


@query(
    """
SELECT path_kind AS kind, count(*) AS n, coalesce(sum(precursor), 0)::DOUBLE AS total FROM (
  SELECT CASE WHEN doc_id % 5 = 0 THEN 'no selected precursor ion' WHEN doc_id % 7 = 0 THEN 'no scan start time' ELSE 'read' END AS path_kind,
         CASE WHEN doc_id % 5 > 0 AND doc_id % 7 > 0 THEN n_chars + 100 END AS precursor
  FROM documents WHERE doc_id % 3 > 0) GROUP BY 1"""
)
def mzml_rejects(spark, sf):
    """Files with MS1 and damaged spectra among good ones: what is read, and rejects by reason."""
    folder = f"{Scratch(spark).root}/mzml"
    spectra = document_spectra(spark, sf)
    scan = F.col("scan")
    kind = F.when(scan % 3 == 0, "ms1").when(scan % 5 == 0, "no ion").when(scan % 7 == 0, "no time").otherwise("good")
    spectra.select(_as_mzml_spectrum(kind).alias("value")).write.text(folder)
    chunks = spark.read.option("lineSep", "</spectrum>").text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    rows = parse_chunks(only_ms2(chunks), "PERMISSIVE")
    reason = F.coalesce(F.regexp_extract("error", "^ValueError: (.*)$", 1), F.lit("read")).alias("kind")
    return rows.groupBy(reason).agg(F.count("*").alias("n"), F.coalesce(F.sum("precursor_mz"), F.lit(0.0)).alias("total"))


# The same bookkeeping in SQL: l0 clusters the even documents; n1 holds the odd ones with the
# representatives and samples of l0; what stays alone meets the even left-overs in the last step.
TWO_BATCHES_SQL = (
    "WITH RECURSIVE "
    + EDGES_SQL
    + """,
sim AS MATERIALIZED (
  SELECT x, y FROM edges UNION ALL SELECT y, x FROM edges UNION ALL SELECT DISTINCT doc_id, doc_id FROM vec),
e0 AS MATERIALIZED (SELECT x, y FROM sim WHERE x % 2 = 0 AND y % 2 = 0 AND x <> y),
r0 AS (SELECT DISTINCT x, x AS y FROM e0 UNION SELECT r.x, e.y FROM r0 r JOIN e0 e ON r.y = e.x),
l0 AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY root) AS cluster_id
  FROM (SELECT x AS doc_id, min(y) AS root FROM r0 GROUP BY x)),
sums AS (SELECT cluster_id, bin, sum(w) AS s FROM vec JOIN l0 USING (doc_id) GROUP BY ALL),
score AS (
  SELECT cluster_id, doc_id, round(sum(w * s) / any_value(n), 9) AS score
  FROM vec JOIN l0 USING (doc_id) JOIN sums USING (cluster_id, bin)
  JOIN (SELECT cluster_id, count(*) AS n FROM l0 GROUP BY ALL) USING (cluster_id) GROUP BY ALL),
medoid AS (SELECT cluster_id, arg_min(doc_id, (-score, doc_id)) AS doc_id FROM score GROUP BY cluster_id),
sampled AS (
  SELECT cluster_id, doc_id FROM (
    SELECT *, count(*) OVER (PARTITION BY cluster_id) AS n,
           row_number() OVER (PARTITION BY cluster_id ORDER BY md5('0|/docs/documents.mzML|' || doc_id), doc_id) AS k FROM l0)
  WHERE n > 5 AND k <= 5),
n1 AS MATERIALIZED (
  SELECT 'd' || doc_id AS k, doc_id, NULL::BIGINT AS known FROM spec WHERE doc_id % 2 = 1
  UNION ALL SELECT 'c' || cluster_id, doc_id, cluster_id FROM medoid
  UNION ALL SELECT 's' || doc_id, doc_id, cluster_id FROM sampled),
e1 AS MATERIALIZED (
  SELECT a.k AS x, b.k AS y FROM n1 a JOIN sim ON a.doc_id = sim.x JOIN n1 b ON b.doc_id = sim.y WHERE a.k <> b.k),
r1 AS (SELECT DISTINCT x, x AS y FROM e1 UNION SELECT r.x, e.y FROM r1 r JOIN e1 e ON r.y = e.x),
g1 AS MATERIALIZED (SELECT x AS k, min(y) AS root FROM r1 GROUP BY x),
c1 AS MATERIALIZED (
  SELECT root, min(known) AS known, min(CASE WHEN known IS NULL THEN doc_id END) AS first
  FROM g1 JOIN n1 USING (k) GROUP BY root),
base AS (SELECT coalesce(max(cluster_id), 0) AS top FROM l0),
id1 AS MATERIALIZED (
  SELECT root, known AS cluster_id FROM c1 WHERE known IS NOT NULL
  UNION ALL
  SELECT root, (SELECT top FROM base) + dense_rank() OVER (ORDER BY first) FROM c1 WHERE known IS NULL),
m1 AS MATERIALIZED (SELECT doc_id, cluster_id FROM n1 JOIN g1 USING (k) JOIN id1 USING (root) WHERE known IS NULL),
alone AS MATERIALIZED (
  SELECT doc_id FROM spec WHERE doc_id NOT IN (SELECT doc_id FROM l0) AND doc_id NOT IN (SELECT doc_id FROM m1)),
e2 AS MATERIALIZED (
  SELECT x, y FROM sim WHERE x <> y AND x IN (SELECT doc_id FROM alone) AND y IN (SELECT doc_id FROM alone)),
r2 AS (SELECT DISTINCT x, x AS y FROM e2 UNION SELECT r.x, e.y FROM r2 r JOIN e2 e ON r.y = e.x),
top AS (SELECT greatest((SELECT top FROM base), coalesce((SELECT max(cluster_id) FROM id1), 0)) AS t),
m2 AS (
  SELECT doc_id, (SELECT t FROM top) + dense_rank() OVER (ORDER BY root) AS cluster_id
  FROM (SELECT x AS doc_id, min(y) AS root FROM r2 GROUP BY x))
SELECT a.cluster_id::BIGINT AS cluster_id, '/docs/documents.mzML' AS path, a.doc_id AS scan, s.mass AS precursor_mz,
       (a.doc_id % 2)::BIGINT AS batch_id
FROM (SELECT doc_id, cluster_id FROM l0 UNION ALL SELECT doc_id, cluster_id FROM m1 UNION ALL SELECT doc_id, cluster_id FROM m2) a
JOIN spec s USING (doc_id)"""
)


@query(TWO_BATCHES_SQL)
def two_batches(spark, sf):
    """Even documents, then odd ones, as two batches with both phases; the final scan list."""
    spectra = document_spectra(spark, sf)
    state = State(spark, f"{Scratch(spark).root}/state")
    for batch in (0, 1):
        run_batch(spectra.where(F.col("scan") % 2 == batch), state, batch, PARAMS)
    return state.read("scan_list").select("cluster_id", "path", "scan", "precursor_mz", "batch_id")


RESENT_SQL = TWO_BATCHES_SQL.replace(
    "FROM spec WHERE doc_id % 2 = 1",
    "FROM spec WHERE doc_id % 2 = 1 OR (doc_id % 10 = 0 AND doc_id NOT IN (SELECT doc_id FROM l0))",
).replace(
    "(a.doc_id % 2)::BIGINT AS batch_id",
    "CASE WHEN a.doc_id % 2 = 1 OR (a.doc_id % 10 = 0 AND a.doc_id NOT IN (SELECT doc_id FROM l0)) THEN 1 ELSE 0 END::BIGINT AS batch_id",
)


@query(RESENT_SQL)
def resent_batches(spark, sf):
    """The same when every tenth document comes in both batches: members stay, singletons are renewed."""
    spectra = document_spectra(spark, sf)
    state = State(spark, f"{Scratch(spark).root}/state")
    run_batch(spectra.where(F.col("scan") % 2 == 0), state, 0, PARAMS)
    run_batch(spectra.where((F.col("scan") % 2 == 1) | (F.col("scan") % 10 == 0)), state, 1, PARAMS)
    return state.read("scan_list").select("cluster_id", "path", "scan", "precursor_mz", "batch_id")


@query(TWO_BATCHES_SQL)
def streamed_batches(spark, sf):
    """The same from a landing folder, a fixed number of files per micro-batch."""
    root, files = Scratch(spark).root, 4
    spectra = document_spectra(spark, sf)
    for part in (0, 1):
        dealt = spectra.where(F.col("scan") % 2 == part).repartitionByRange(files, F.xxhash64("scan"))
        write_table(dealt, f"{root}/landing", "append")
    stream = spark.readStream.schema(spectra.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/landing")
    state = State(spark, f"{root}/state")
    landing.start(stream, state, PARAMS).awaitTermination()
    return state.read("scan_list").select("cluster_id", "path", "scan", "precursor_mz", "batch_id")
