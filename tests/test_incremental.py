import hashlib

import numpy as np
import pytest
from helpers import dbscan, spectra_frame, vector
from pyspark.sql import functions as F

from peakloom.operators.merge import merge_clusters
from peakloom.params import ClusterParams
from peakloom.plans import incremental
from peakloom.plans.state import State
from peakloom.sources.mzml import read_mzml
from peakloom.sources.tables import assignment_rows

PARAMS = ClusterParams()


def medoid(keys, rows):
    vecs = {k: vector(rows[k], PARAMS.fragment_tol) for k in keys}
    cost = {a: round(sum(1 - sum(w * vecs[b].get(n, 0.0) for n, w in vecs[a].items()) for b in keys), 7) for a in keys}
    return min(keys, key=lambda k: (cost[k], k))


class Model:
    """The same bookkeeping with plain dictionaries and all-pairs clustering."""

    def __init__(self):
        self.members, self.reps, self.samples, self.singles = {}, {}, {}, {}
        self.stored = {}

    def _cluster(self, rows):
        labels = dbscan(list(rows.values()), PARAMS)
        groups = {}
        for key, label in labels.items():
            if label >= 0:
                groups.setdefault(label, []).append(key)
        return labels, {label: rows[medoid(keys, rows)] for label, keys in groups.items()}

    def _merge(self, labels, reps, known):
        mapping = {}
        for key, cid in known.items():
            if labels[key] >= 0:
                mapping[labels[key]] = min(cid, mapping.get(labels[key], cid))
        top = max(self.members, default=0)
        fresh = sorted({v for k, v in labels.items() if k not in known and v >= 0} - set(mapping))
        for n, label in enumerate(fresh, 1):
            mapping[label] = top + n
        for key, label in labels.items():
            if key not in known and label >= 0:
                self.members.setdefault(mapping[label], []).append(key)
        for label, rep in reps.items():
            if label in mapping:
                self.reps[mapping[label]] = rep
        return [k for k, v in labels.items() if v < 0 and k not in known]

    def batch(self, rows):
        sent = {(r["path"], r["scan"]): r for r in rows}
        placed = {k for keys in self.members.values() for k in keys}
        rows = {k: r for k, r in sent.items() if k not in placed}
        self.singles = {k: r for k, r in self.singles.items() if k not in sent}
        if not self.members and not self.singles:
            labels, reps = self._cluster(rows)
            left = self._merge(labels, reps, {})
            pool = rows
        else:
            known, both = {}, dict(rows)
            for cid, rep in self.reps.items():
                key = (f"consensus_{cid}", cid)
                both[key], known[key] = dict(rep, path=key[0], scan=cid), cid
            for cid, keys in self.samples.items():
                for key in keys:
                    both[key], known[key] = self.stored[key], cid
            labels, reps = self._cluster(both)
            left = self._merge(labels, reps, known)
            pool = {**{k: rows[k] for k in left}, **self.singles}
            labels, reps = self._cluster(pool)
            left = self._merge(labels, reps, {})
        self.stored.update(sent)
        self.singles = {k: pool[k] for k in left}
        for cid, keys in self.members.items():
            if len(keys) > 5 and cid not in self.samples:
                digest = lambda k: hashlib.md5(f"0|{k[0]}|{k[1]}".encode()).hexdigest()
                self.samples[cid] = sorted(keys, key=lambda k: (digest(k), k))[:5]


def family_rows(rng, count):
    families = []
    for f in range(count):
        families.append((np.sort(rng.uniform(100, 900, 15)), rng.uniform(10, 100, 15), rng.uniform(300, 900), 1 + f % 3))
    return families


def draw(rng, families, picks, path):
    rows = []
    for scan, f in enumerate(picks, 1):
        mz, inten, mass, charge = families[f]
        rows.append(
            dict(
                path=path, scan=scan, precursor_mz=float(mass * (1 + rng.normal(0, 1.5e-6))), charge=charge if f != 3 else None,
                mz=mz, intensity=inten * rng.uniform(0.75, 1.3, 15), rt_sec=float(scan),
            )
        )
    return rows


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Three batches: clusters growing past five, singletons joined later, an empty batch."""
    rng = np.random.default_rng(21)
    families = family_rows(rng, 10)
    batches = [
        draw(rng, families, [0, 0, 0, 0, 1, 1, 2, 3, 3, 4], "/one/a.mzML"),
        draw(rng, families, [0, 0, 1, 1, 1, 1, 1, 2, 5, 5, 6], "/two/a.mzML"),
        [],
        draw(rng, families, [0, 4, 6, 6, 7, 3, 5, 8, 8, 1], "/three/b.mzML"),
    ]
    state = State(spark, "file://" + str(tmp_path_factory.mktemp("state")))
    model, seen = Model(), []
    for batch_id, rows in enumerate(batches):
        incremental.run_batch(spectra_frame(spark, rows), state, batch_id, PARAMS)
        model.batch(rows)
        seen.append(({(r.path, r.scan): r.cluster_id for r in state.read("scan_list").collect()},
                     {(r.path, r.scan) for r in state.read("singletons").collect()},
                     {(r.cluster_id, r.path, r.scan) for r in state.read("sample_list").collect()},
                     {k: (r["precursor_mz"]) for k, r in model.reps.items()},
                     {k: c for c, keys in model.members.items() for k in keys}, set(model.singles),
                     {(c, *k) for c, keys in model.samples.items() for k in keys}))
    return state, model, batches, seen


def test_every_batch_equals_the_model(run):
    _, _, _, seen = run
    for got, singles, samples, _, want, want_singles, want_samples in seen:
        assert got == want
        assert singles == want_singles
        assert samples == want_samples
    assert len(seen[-1][6]) >= 5


def test_representatives_are_carried_forward(run):
    state, model, _, _ = run
    reps = {r.cluster_id: r.precursor_mz for r in state.read("consensus").collect()}
    assert reps == {c: r["precursor_mz"] for c, r in model.reps.items()}
    assert set(reps) == set(model.members)


def test_each_scan_is_in_one_place(run):
    state, _, batches, seen = run
    scans = {(r["path"], r["scan"]) for b in batches for r in b}
    got, singles = seen[-1][0], seen[-1][1]
    assert set(got) | singles == scans and not set(got) & singles
    assert incremental.missing_samples(state).count() == 0


def test_committed_batch_is_left_alone(spark, run):
    state, _, batches, seen = run
    facts = incremental.run_batch(spectra_frame(spark, batches[0]), state, 0, PARAMS)
    assert facts["batch_id"] == 0 and state.read("scan_list").count() == len(seen[-1][0])
    with pytest.raises(ValueError, match="comes before"):
        incremental.run_batch(spectra_frame(spark, []), state, -1, PARAMS)


def test_results_and_exports(spark, run, tmp_path):
    state, model, _, seen = run
    incremental.export_results(state, 3, "file://" + str(tmp_path), PARAMS)
    info = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "cluster_info.tsv"))
    assert info.columns == ["cluster", "filename", "scan", "precursor_mz", "retention_time", "new_batch"]
    assert info.where("new_batch = 'yes'").count() == len([k for k in seen[-1][0] if k[0] == "/three/b.mzML"])
    summary = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "cluster_summary.tsv"))
    sizes = {int(r["cluster index"]): int(r["number of spectra"]) for r in summary.collect()}
    assert sizes == {c: len(k) for c, k in model.members.items()}
    out = read_mzml(spark, str(tmp_path / "consensus"))
    large = [c for c, k in model.members.items() if len(k) > 5]
    assert out.count() == len(model.members) + 5 * len(large)
    assert read_mzml(spark, str(tmp_path / "singletons")).count() == len(model.singles)
    assert (tmp_path / "timing_report.json").exists()


def _spectra(spark, rows):
    return spark.createDataFrame([(p, n, float(m)) for p, n, m in rows], "path string, scan long, precursor_mz double")


def _written(state, batch, rows):
    frame = _spectra(state.spark, rows).withColumn("batch_id", F.lit(batch).cast("bigint"))
    state.write("store", batch, frame)
    state.commit(batch)


def _masses(df):
    return {(r.path, r.scan): r.precursor_mz for r in df.collect()}


def test_readers_adopt_a_compacted_store(spark, tmp_path):
    state = State(spark, "file://" + str(tmp_path))
    assert not state.compact("store") and state.drop_replaced("store") == []
    _written(state, 0, [("a", 1, 1), ("b", 2, 2)])
    _written(state, 1, [("b", 2, 20), ("c", 3, 3)])
    held = {("a", 1): 1, ("b", 2): 20, ("c", 3): 3}
    assert state.compact("store") and not state.compact("store")
    assert len(state.live_folders("store")) == 1 and "compact-1-" in state.live_folders("store")[0]
    assert _masses(state.read("store")) == _masses(state.store()) == held
    assert state.drop_replaced("store") == ["batch=0", "batch=1"]
    assert _masses(state.store()) == held
    # a later batch is read beside it, one that is not committed is neither read nor dropped
    _written(state, 2, [("a", 1, 10)])
    state.write("store", 3, _spectra(spark, [("z", 9, 9)]).withColumn("batch_id", F.lit(3)))
    assert len(state.live_folders("store")) == 2
    assert _masses(state.store()) == {**held, ("a", 1): 10}
    assert state.compact("store")
    assert sorted(n[:7] for n in state.drop_replaced("store")) == ["batch=2", "compact"]
    assert _masses(state.read("store")) == {**held, ("a", 1): 10}
    assert (tmp_path / "store" / "batch=3").exists()
    with pytest.raises(ValueError, match="replaced by each batch"):
        state.compact("consensus")


def test_a_compaction_lost_before_its_record_changes_nothing(spark, tmp_path, monkeypatch):
    state = State(spark, "file://" + str(tmp_path))
    _written(state, 0, [("a", 1, 1)])
    monkeypatch.setattr("peakloom.plans.state.write_text", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        state.compact("store")
    monkeypatch.undo()
    assert [f.rsplit("/", 1)[1] for f in state.live_folders("store")] == ["batch=0"]
    assert state.compact("store") and _masses(state.read("store")) == {("a", 1): 1}
    assert {n[:7] for n in state.drop_replaced("store")} == {"batch=0", "compact"}


def test_point_reads(spark, tmp_path):
    state = State(spark, "file://" + str(tmp_path))
    _written(state, 0, [("a", 1, 1), ("b", 2, 2)])
    _written(state, 1, [("b", 2, 20)])
    assert _masses(state.spectrum("b", 2)) == {("b", 2): 20}
    assert state.spectrum("b", 1).count() == 0
    plan = state.spectrum("b", 2)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(path,b)" in plan and "EqualTo(scan,2)" in plan


def test_one_representative_where_samples_lie_apart(spark, scratch):
    """Two temporary clusters stand for known cluster 7: one holds its representative, one a sample."""
    rows = spark.createDataFrame(
        [(0, "s", 4, "sample", 7), (0, "d", 5, "batch", None), (1, "consensus_7", 7, "consensus", 7), (1, "d", 6, "batch", None)],
        "temp_cluster long, path string, scan long, source string, ref_cluster long",
    )
    reps = spark.createDataFrame([(0, "first"), (1, "second")], "temp_cluster long, title string")
    got = merge_clusters(rows, 7, scratch, reps)
    assert [tuple(r) for r in got.representatives.select("cluster_id", "title").collect()] == [(7, "first")]
    assert {(r.cluster_id, r.scan) for r in got.members.collect()} == {(7, 5), (7, 6)}


def test_merge_of_an_imported_result(spark, scratch):
    """Two known clusters in one temporary cluster, noise and unreadable references."""
    rows = [
        (0, "consensus.mzML", "12"), (0, "consensus.mzML", "scan=7_2"), (0, "a.mzML", "/x/b.mzML_5"),
        (1, "a.mzML", "6"), (2, "a.mzML", "8"), (-1, "consensus.mzML", "9"), (-1, "a.mzML", "10"),
        (3, "consensus.mzML", "oops"), (3, "a.mzML", "11"),
    ]
    frame = spark.createDataFrame(
        [(c, 1.0, 2.0, "", f, s) for c, f, s in rows],
        "cluster long, precursor_mz double, retention_time double, identifier string, filename string, scan string",
    )
    reps = spark.createDataFrame([(0, "a"), (1, "b"), (-1, "n")], "temp_cluster long, title string")
    known = spark.createDataFrame([(7,), (9,), (12,)], "cluster_id long")
    got = merge_clusters(assignment_rows(frame, "/in"), 12, scratch, reps, known)
    assert {(r.cluster_id, r.path, r.scan) for r in got.members.collect()} == {
        (7, "/x/b.mzML", 5), (13, "/in/a.mzML", 6), (14, "/in/a.mzML", 8), (15, "/in/a.mzML", 11),
    }
    assert [(r.path, r.scan) for r in got.singletons.collect()] == [("/in/a.mzML", 10)]
    assert {(r.kept_id, r.other_id) for r in got.merge_candidates.collect()} == {(7, 12)}
    assert {(r.cluster_id, r.title) for r in got.representatives.collect()} == {(7, "a"), (13, "b")}
    with pytest.raises(ValueError, match="unknown clusters"):
        merge_clusters(assignment_rows(frame, "/in"), 12, scratch, clusters=known.where("cluster_id > 7"))


def test_repeated_scan_counts_once(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = draw(rng, family_rows(rng, 2), [0, 0, 1], "/d/a.mzML")
    state = State(spark, "file://" + str(tmp_path))
    facts = incremental.run_batch(spectra_frame(spark, [*rows, dict(rows[0], precursor_mz=1.0)]).coalesce(1), state, 0, PARAMS)
    assert facts["n_incoming"] == 3
    assert state.read("singletons").where(F.col("scan") == 1).first().precursor_mz == 1.0


def test_spectra_sent_again_stay_in_one_place(spark, tmp_path):
    """Singletons, members and samples come again, changed or not, over four batches."""
    rng = np.random.default_rng(33)
    families = family_rows(rng, 8)
    first = draw(rng, families, [0, 0, 0, 0, 0, 0, 1, 1, 2, 4], "/one/a.mzML")
    other = draw(rng, families, [2, 4, 5, 5, 6], "/two/a.mzML")
    moved = dict(first[8], mz=families[6][0], intensity=families[6][1], precursor_mz=float(families[6][2]), charge=1 + 6 % 3)
    batches = [first, [first[9], first[8], first[0], first[6], *other[:1]], [*first[:3], moved, *other], [*first, *other]]
    state, model = State(spark, "file://" + str(tmp_path)), Model()
    for batch_id, rows in enumerate(batches):
        incremental.run_batch(spectra_frame(spark, rows), state, batch_id, PARAMS)
        model.batch(rows)
        members = [(r.path, r.scan) for r in state.read("scan_list").collect()]
        singles = [(r.path, r.scan) for r in state.read("singletons").collect()]
        places = members + singles
        assert len(places) == len(set(places))
        got = {}
        for r in state.read("scan_list").collect():
            got.setdefault(r.cluster_id, set()).add((r.path, r.scan))
        assert got == {c: set(keys) for c, keys in model.members.items()}
        assert set(singles) == set(model.singles)


def test_rejects_of_a_batch(spark, tmp_path):
    from helpers import mzml_text

    good = [dict(scan=n, mass=400.0, charge=1, rt=1.0, mz=[100.0, 200.0], intensity=[1.0, 2.0]) for n in (1, 2)]
    bad = dict(scan=3, mass=1.0, rt=1.0, mz=[1], intensity=[1], no_ion=True)
    (tmp_path / "a.mzML").write_text(mzml_text([*good, bad]))
    state = State(spark, "file://" + str(tmp_path / "state"))
    facts = incremental.run_batch(read_mzml(spark, str(tmp_path), "PERMISSIVE"), state, 0, PARAMS)
    assert (facts["n_incoming"], facts["rejected"]) == (2, {"ValueError": 1})
    row = state.read("rejects").head()
    assert row.path.endswith("/a.mzML") and row["index"] == 2 and "no selected precursor ion" in row.error


def test_samples_that_are_not_stored_end_the_batch(spark, tmp_path):
    """A sample whose spectrum the store lost stops the batch before its commit."""
    samples = spark.createDataFrame([("a", 1), ("a", 2)], "path string, scan bigint")
    incremental._all_stored(samples, samples)
    with pytest.raises(ValueError, match="a:2"):
        incremental._all_stored(samples, samples.where("scan = 1"))
