import numpy as np
import pytest
from helpers import dbscan, random_spectra, spectra_frame, vector
from pyspark.sql import functions as F

from peakloom.functions.peaks import hash_bin, vectorise
from peakloom.operators import cluster, rangejoin
from peakloom.operators.cluster import cluster_spectra, prepare
from peakloom.operators.components import components
from peakloom.operators.ids import dense_index
from peakloom.operators.network import greedy_matches, network_pairs, prepare_network
from peakloom.operators.similarity import explode_prefixes, feature_counts, prefixes
from peakloom.params import ClusterParams, Tolerance


def labels_of(result):
    return {(r.path, r.scan): r.temp_cluster for r in result.assign.collect()}


@pytest.mark.parametrize(("chunk", "hash_len"), [(4096, None), (3, None), (4096, 400)])
def test_clusters_equal_brute_force(spark, scratch, chunk, hash_len):
    rows = random_spectra(5)
    params = ClusterParams(hash_len=hash_len)
    got = cluster_spectra(spectra_frame(spark, rows).repartition(3), params, scratch, chunk)
    want = dbscan(rows, ClusterParams())
    if hash_len:
        # Hashing folds bins together, so only true neighbours are sure to stay together.
        found = labels_of(got)
        ours = {}
        for key, old in want.items():
            if old >= 0:
                ours.setdefault(old, set()).add(found[key])
        assert all(len(v) == 1 and -1 not in v for v in ours.values())
    else:
        assert labels_of(got) == want


@pytest.mark.parametrize("unit", ["0.02 Da", "40 ppm"])
def test_copies_and_a_hot_bucket(spark, scratch, unit):
    """A third of all rows are copies; another third near copies that differ a little."""
    rng = np.random.default_rng(3)
    mz, inten = np.sort(rng.uniform(100, 900, 15)), rng.uniform(10, 100, 15)
    rows = []
    for n in range(60):
        rows.append(dict(path="/d/copy.mzML", scan=n, precursor_mz=500.0, charge=2, mz=mz, intensity=inten))
    for n in range(60):
        rows.append(
            dict(path="/d/near.mzML", scan=n, precursor_mz=500.0 + 0.004 * n, charge=2, mz=mz, intensity=inten * rng.uniform(0.5, 1.5, 15))
        )
    rows += [dict(r, path="/d/rest.mzML") for r in random_spectra(8, 5, 6)]
    rows.append(dict(path="/d/rest.mzML", scan=9998, precursor_mz=None, charge=None, mz=[], intensity=[]))
    rows.append(dict(path="/d/rest.mzML", scan=9999, precursor_mz=500.0, charge=2, mz=[np.nan, np.inf], intensity=[1, 1]))
    params = ClusterParams(precursor_tol=unit)
    got = cluster_spectra(spectra_frame(spark, rows).repartition(4), params, scratch, 10)
    plain = [dict(r, precursor_mz=r["precursor_mz"] or 0.0, mz=[] if r["scan"] == 9999 else r["mz"]) for r in rows]
    assert labels_of(got) == dbscan(plain, params)


def test_medoid_is_least_summed_distance(spark, scratch):
    rows = random_spectra(11, 6, 7)
    rows += [dict(rows[0], scan=900 + n) for n in range(4)]
    params = ClusterParams()
    got = cluster_spectra(spectra_frame(spark, rows), params, scratch)
    labels = dbscan(rows, params)
    byscan = {(r["path"], r["scan"]): vector(r, params.fragment_tol) for r in rows}
    reps = {r.temp_cluster: (r.path, r.scan) for r in got.representatives.collect()}
    assert set(reps) == {v for v in labels.values() if v >= 0}
    for cluster, rep in reps.items():
        members = sorted(k for k, v in labels.items() if v == cluster)
        cost = {
            m: round(sum(1 - sum(w * byscan[o].get(b, 0.0) for b, w in byscan[m].items()) for o in members), 7)
            for m in members
        }
        assert rep == min(members, key=lambda m: (cost[m], m))


def test_vectors(spark):
    rows = [
        dict(path="p", scan=1, precursor_mz=1.0, charge=1, mz=[100.01, 100.02, 300.0, 5.0, np.nan], intensity=[3, 1, 3, 9, 1]),
        dict(path="p", scan=2, precursor_mz=1.0, charge=1, mz=[100.0, 110.0], intensity=[1, 1]),
        dict(path="p", scan=3, precursor_mz=1.0, charge=1, mz=[], intensity=[]),
    ]
    params = ClusterParams(min_mz=10, max_mz=1000, min_mz_range=50)
    got = vectorise(spectra_frame(spark, rows), params).collect()
    assert [r.scan for r in got] == [1]
    assert got[0].bins == [2000, 6000] and got[0].weights == pytest.approx([0.8, 0.6])
    hashed = vectorise(spectra_frame(spark, rows[1:2]), ClusterParams(hash_len=400)).collect()[0]
    want = spark.createDataFrame([(2000,), (2200,)], "b long").select(hash_bin(F.col("b"), 400).alias("h")).collect()
    assert hashed.bins == sorted(r.h for r in want)


@pytest.mark.parametrize("text", ["0.5 Da", "20 ppm", "2000ppm", "0.1 da"])
@pytest.mark.parametrize("chunk", [4096, 2])
def test_tolerance_join(spark, scratch, text, chunk):
    rng = np.random.default_rng(2)
    values = [float(v) for v in np.r_[rng.uniform(300, 330, 120), np.arange(300, 310, 0.1), [300.0] * 5, 600 * (1 + 1e-5 * np.arange(20))]]
    tol = Tolerance.parse(text)
    df = spark.createDataFrame([(n, v, n % 2) for n, v in enumerate(values)], "id long, v double, g int")
    got = rangejoin.tolerance_self_join(df, "v", "id", tol, scratch, ["g"], chunk)
    found = [(r.id_l, r.id_r) for r in got.collect()]
    window = lambda a, b: tol.value if tol.unit == "da" else tol.relative * max(a, b)
    want = set()
    for i, a in enumerate(values):
        for j in range(i + 1, len(values)):
            b = values[j]
            if i % 2 == j % 2 and max(a, b) - min(a, b) <= window(a, b):
                want.add((i, j) if (a, i) < (b, j) else (j, i))
    assert len(found) == len(set(found)) and set(found) == want


@pytest.mark.parametrize("text", ["300 ppm", "0.4 Da"])
def test_chains_equal_components_of_pairs(spark, scratch, text):
    rng = np.random.default_rng(9)
    values = [float(v) for v in np.r_[rng.uniform(100, 2000, 300), np.repeat(500.25, 60), [0.0, 0.0, -1.0, -1.2]]]
    rows = [(n * 7 % 401, v, n % 3) for n, v in enumerate(values)] + [(900, None, 1), (901, float("nan"), 1), (902, 500.25, None)]
    df = spark.createDataFrame(rows, "key int, value double, kind int").repartition(5)
    tol = Tolerance.parse(text)
    got = {r.node: r.root for r in rangejoin.tolerance_chains(df, "value", "key", tol, scratch, ["kind"]).collect()}
    pairs = rangejoin.tolerance_self_join(df.where("key < 900"), "value", "key", tol, scratch, ["kind"])
    want = {r.node: r.root for r in components(pairs.select(F.col("key_l").cast("bigint").alias("a"), F.col("key_r").cast("bigint").alias("b")), scratch, "a", "b").collect()}
    assert got == want and len(set(want.values())) > 5
    assert rangejoin.tolerance_chains(df.where("false"), "value", "key", tol, scratch).count() == 0


def test_components(spark, scratch):
    rng = np.random.default_rng(4)
    edges = [(n, n + 1) for n in range(0, 60)] + [(100, n) for n in range(101, 160)] + [(int(a), int(b)) for a, b in rng.integers(200, 300, (60, 2))]
    got = components(spark.createDataFrame(edges, "u long, v long"), scratch).collect()
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    assert {r.node: r.root for r in got} == {n: find(n) for n in parent}
    assert len(got) == len(parent)


def test_dense_index(spark, scratch):
    df = spark.createDataFrame([((n * 37) % 101,) for n in range(101)], "k long").repartition(7)
    got = dense_index(df, [F.col("k")], "id", scratch, 10).collect()
    assert {r.k: r.id for r in got} == {n: n + 11 for n in range(101)}


def test_dense_index_over_several_partitions(spark, scratch):
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1kb",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = spark.range(20000).selectExpr("(id * 7919) % 20011 AS k").repartition(5)
        got = dense_index(df, [F.col("k").desc()], "id", scratch)
        rows = got.collect()
        assert got.rdd.getNumPartitions() > 1
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    want = {k: n for n, k in enumerate(sorted((r.k for r in rows), reverse=True), 1)}
    assert {r.k: r.id for r in rows} == want and len(rows) == 20000


def greedy_cosine(a, b, tol):
    def unit(r):
        p = sorted((m, i) for m, i in zip(r["mz"], r["intensity"], strict=True))
        n = np.sqrt(sum(i * i for _, i in p))
        return [(m, i / n) for m, i in p]

    pa, pb = unit(a), unit(b)
    hits = sorted(
        ((-(wa * wb), i, j) for i, (ma, wa) in enumerate(pa) for j, (mb, wb) in enumerate(pb) if abs(ma - mb) <= tol)
    )
    ui, uj, total, n = set(), set(), 0.0, 0
    for p, i, j in hits:
        if i not in ui and j not in uj:
            ui.add(i)
            uj.add(j)
            total -= p
            n += 1
    return total, n


@pytest.mark.parametrize("chunk", [4096, 2])
def test_network_equals_brute_force(spark, scratch, chunk):
    rng = np.random.default_rng(6)
    rows = random_spectra(7, 6, 5)
    for r in rows:  # peaks shift by up to 0.04, and some peaks stand close together
        r["mz"] = np.asarray(r["mz"]) + rng.uniform(-0.02, 0.02, 20)
        r["mz"] = np.r_[r["mz"], r["mz"][:3] + 0.03]
        r["intensity"] = np.r_[r["intensity"], r["intensity"][:3] * 0.7]
    params = ClusterParams(min_cosine=0.7)
    frame = spectra_frame(spark, rows).withColumnRenamed("scan", "id")
    got = {(r.left_id, r.right_id): (r.cosine, r.matched_peaks) for r in network_pairs(frame, params, scratch, None, chunk).collect()}
    want = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            c, n = greedy_cosine(a, b, params.fragment_tol)
            if c >= 0.7:
                want[(a["scan"], b["scan"])] = (pytest.approx(c, abs=1e-9), n)
    assert got == want and len(want) > 20
    shards = [network_pairs(frame, params, scratch, (k, 3), chunk).count() for k in range(3)] if chunk == 4096 else [len(want)]
    assert sum(shards) == len(want)


def plain_score(a, b, params):
    """Score and matched peaks by trying every pair of peaks, best gain first."""

    def weights(r):
        p = sorted((m, i) for m, i in zip(r["mz"], r["intensity"], strict=True))
        if params.peak_filter:
            p = [q for q in p if abs(q[0] - r["precursor_mz"]) > 17]
            p = [q for q in p if sum(o[1] > q[1] and abs(o[0] - q[0]) <= 50 for o in p) < 6]
        if params.score == "cosine":
            n = np.sqrt(sum(i * i for _, i in p))
            return [(m, i / n) for m, i in p]
        share = [i / sum(i for _, i in p) for _, i in p]
        s = -sum(x * np.log(x) for x in share)
        flat = [x ** (0.25 + 0.25 * s) if s < 3 else x for x in share]
        return [(m, x / sum(flat)) for (m, _), x in zip(p, flat, strict=True)]

    def gain(x, y):
        return x * y if params.score == "cosine" else ((x + y) * np.log2(x + y) - x * np.log2(x) - y * np.log2(y)) / 2

    delta = b["precursor_mz"] - a["precursor_mz"]
    if params.max_shift is not None and abs(delta) > params.max_shift:
        return 0.0, 0
    tol, pa, pb = params.fragment_tol, weights(a), weights(b)
    hits = []
    for i, (ma, wa) in enumerate(pa):
        for j, (mb, wb) in enumerate(pb):
            if abs(ma - mb) <= tol or (params.max_shift is not None and abs(ma + delta - mb) <= tol):
                hits.append((-gain(wa, wb), i, j))
    ui, uj, total, n = set(), set(), 0.0, 0
    for g, i, j in sorted(hits):
        if i not in ui and j not in uj:
            ui.add(i)
            uj.add(j)
            total -= g
            n += 1
    return total, n


@pytest.mark.parametrize(
    "params",
    [
        ClusterParams(min_cosine=0.6, max_shift=40.0),
        ClusterParams(min_cosine=0.6, score="entropy"),
        ClusterParams(min_cosine=0.6, score="entropy", max_shift=40.0),
        ClusterParams(min_cosine=0.6, peak_filter=True),
    ],
    ids=["shift", "entropy", "entropy and shift", "filter"],
)
def test_other_scores_equal_brute_force(spark, scratch, params):
    """Families whose members lose a group: half the peaks move with the precursor, and several stand close together."""
    rng = np.random.default_rng(8)
    rows = []
    for family in range(5):
        mz, strength = rng.uniform(60, 400, 25), rng.exponential(10, 25) + 0.1
        for member in range(6):
            delta = [0.0, 14.02, 15.99, 28.03, 100.0, 0.04][member]
            own = np.where(np.arange(25) % 2 == 0, mz, mz + delta) + rng.uniform(-0.02, 0.02, 25)
            own, force = np.r_[own, own[:4] + 0.03], np.r_[strength, strength[:4] * 0.8] * rng.uniform(0.7, 1.3, 29)
            rows.append(dict(path="p", scan=len(rows), precursor_mz=420.0 + 3 * family + delta, charge=1, mz=own, intensity=force))
    frame = spectra_frame(spark, rows).withColumnRenamed("scan", "id").repartition(3)
    want = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            total, n = plain_score(a, b, params)
            if total >= params.min_cosine:
                want[(a["scan"], b["scan"])] = (pytest.approx(total, abs=1e-9), n)
    assert len(want) > 10
    for chunk in (4096, 7):
        made = network_pairs(frame, params, scratch, None, chunk)
        assert {(r.left_id, r.right_id): (r[params.score], r.matched_peaks) for r in made.collect()} == want
    assert sum(network_pairs(frame, params, scratch, (k, 2)).count() for k in range(2)) == len(want)


def test_blocks_too_unlike_form_no_cell(spark, scratch):
    """Spectra of two peaks against spectra of four hundred: sums and largest weights bound the cosine below 0.8."""
    sizes = [2 if n < 140 else 400 for n in range(280)]
    rows = [
        dict(path="p", scan=n, precursor_mz=500.0, charge=1, mz=100 + np.arange(k) * 0.5, intensity=np.ones(k)) for n, k in enumerate(sizes)
    ]
    frame = spectra_frame(spark, rows).withColumnRenamed("scan", "id")
    params = ClusterParams(min_cosine=0.8)
    prepared = prepare_network(frame, params, scratch)
    assert prepared.blocks == 4
    assert {(r.block, r.other) for r in prepared.cells.collect()} == {(a, b) for a in range(4) for b in range(4) if a // 2 == b // 2}
    assert network_pairs(frame, params, scratch, prepared=prepared).count() == 2 * (140 * 139 // 2)


def test_precursors_that_are_unknown(spark, scratch):
    rows = [dict(path="p", scan=n, precursor_mz=500.0 + 5 * n, charge=1, mz=[100.0, 200.0 + 5 * n], intensity=[1.0, 1.0]) for n in range(3)]
    frame = spectra_frame(spark, rows).withColumnRenamed("scan", "id").selectExpr(
        "id", "CASE WHEN id < 2 THEN precursor_mz END AS precursor_mz", "mz", "intensity"
    )
    params = ClusterParams(min_cosine=0.4, max_shift=50.0)
    got = {(r.left_id, r.right_id): (round(r.cosine, 9), r.matched_peaks, r.delta_mz) for r in network_pairs(frame, params, scratch).collect()}
    assert got == {(0, 1): (1.0, 2, 5.0), (0, 2): (0.5, 1, None), (1, 2): (0.5, 1, None)}


def test_network_without_any_match(spark, scratch):
    """Peaks in neighbouring bins that are further apart than the tolerance."""
    rows = [
        dict(path="p", scan=n, precursor_mz=1.0, charge=1, mz=[100.001 + 0.06 * n], intensity=[1.0]) for n in range(2)
    ]
    frame = spectra_frame(spark, rows).withColumnRenamed("scan", "id")
    assert network_pairs(frame, ClusterParams(), scratch).count() == 0


def test_greedy_prefers_the_larger_product():
    keep = greedy_matches(np.zeros(3, int), np.array([0, 0, 1]), np.array([5, 6, 5]), np.array([0.9, 0.2, 0.5]))
    assert keep.tolist() == [True, False, False]


@pytest.mark.parametrize("bad", ["20", "x ppm", "-1 Da", "0 ppm"])
def test_tolerance_needs_a_unit(bad):
    with pytest.raises(ValueError):
        Tolerance.parse(bad)


def test_spectra_that_share_one_strong_peak_do_not_all_meet(spark, scratch):
    """1,500 dissimilar spectra with a common peak of one mass make next to no candidate pairs."""
    count = 1500
    rows = [
        dict(path="/d/a.mzML", scan=n, precursor_mz=500.0, charge=2, mz=[150.0, 200.0 + 0.2 * n], intensity=[10.0, 10.0])
        for n in range(count)
    ]
    vectors = prepare(spectra_frame(spark, rows), ClusterParams(), scratch)
    ordered = prefixes(vectors.select("spec_id", "bins", "weights"), ClusterParams().similarity, feature_counts(vectors))
    meetings = explode_prefixes(ordered).groupBy("feature").count().selectExpr("sum(count * (count - 1) / 2)").first()[0]
    assert meetings < 10 * count
    assert cluster_spectra(spectra_frame(spark, rows), ClusterParams(), scratch).assign.where("temp_cluster >= 0").count() == 0


@pytest.mark.parametrize("copied", [False, True])
def test_neighbourhood_of_four_equals_brute_force(spark, scratch, copied):
    rows = random_spectra(11, 10, 5, jitter=6e-6)
    if copied:
        alone = dict(rows[0], precursor_mz=900.0, mz=[77.0, 78.0], intensity=[1.0, 2.0])
        extra = [rows[n] for n in range(0, len(rows), 4) for _ in range(1 + n % 3)]
        extra += [alone] * 4 + [dict(alone, precursor_mz=950.0)] * 3
        rows = rows + [dict(r, scan=1000 - n) for n, r in enumerate(extra)]
    params = ClusterParams(min_samples=4)
    vecs = [vector(r, params.fragment_tol) for r in rows]
    near = {n: {} for n in range(len(rows))}
    for a in near:
        for b in near:
            ma, mb = rows[a]["precursor_mz"], rows[b]["precursor_mz"]
            same = rows[a]["charge"] == rows[b]["charge"] and abs(ma - mb) <= params.precursor_tol.relative * max(ma, mb)
            cosine = sum(w * vecs[b].get(k, 0.0) for k, w in vecs[a].items())
            if a != b and same and cosine >= params.similarity:
                near[a][b] = cosine
    core = {n for n in near if len(near[n]) + 1 >= 4}
    group = {n: n for n in core}
    for _ in core:
        for n in core:
            group[n] = min([group[n], *(group[m] for m in near[n] if m in core)])
    for n in set(near) - core:
        best = min(((-round(c, 9), rows[m]["scan"], group[m]) for m, c in near[n].items() if m in core), default=None)
        if best:
            group[n] = best[2]
    got = labels_of(cluster_spectra(spectra_frame(spark, rows).repartition(3), params, scratch))
    found, want = {}, {}
    for n, r in enumerate(rows):
        label = got[r["path"], r["scan"]]
        assert (label < 0) == (n not in group)
        if n in group:
            found.setdefault(label, set()).add(n)
            want.setdefault(group[n], set()).add(n)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values())) and len(want) > 3


def test_core_counting_does_not_list_pairs_of_copies(spark, scratch, monkeypatch):
    """A spectrum with 5,000 copies is one row where pairs are sought; near ones join it, three others are too few."""
    one = dict(path="/d/a.mzML", scan=1, precursor_mz=500.0, charge=2, mz=[150.0, 250.0], intensity=[3.0, 4.0])
    frame = spectra_frame(spark, [one]).withColumn("scan", F.explode(F.expr("sequence(1L, 5000L)")))
    others = [dict(one, scan=6000, intensity=[3.0, 4.1]), dict(one, scan=6001, mz=[150.0, 250.0, 260.0], intensity=[3.0, 4.0, 0.1])]
    few = [dict(one, scan=7000 + n, precursor_mz=700.0) for n in range(3)]
    sought = []
    real = cluster.scored_pairs
    monkeypatch.setattr(cluster, "scored_pairs", lambda vectors, *rest: sought.append(vectors.count()) or real(vectors, *rest))
    every = frame.unionByName(spectra_frame(spark, [*others, *few]))
    got = cluster_spectra(every.repartition(4), ClusterParams(min_samples=4), scratch)
    assert sought == [4]
    sizes = {r.temp_cluster: r["count"] for r in got.assign.groupBy("temp_cluster").count().collect()}
    assert sizes == {0: 5002, -1: 3}
    assert [(r.temp_cluster, r.scan) for r in got.representatives.collect()] == [(0, 1)]
