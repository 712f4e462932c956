"""What stays on disk: no shuffle files of written tables, no second copy of the spectra."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from helpers import random_spectra, spectra_frame
from peakloom.operators.cluster import cluster_spectra
from peakloom.params import ClusterParams
from peakloom.plans.incremental import run_batch
from peakloom.plans.state import State
from peakloom.session import FREE_SHUFFLES, Scratch


def _folders(root):
    return {p.parent.name for p in Path(root.removeprefix("file://").removeprefix("file:")).rglob("part-*.parquet")}


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {found.name for folder in blocks.localDirs() for found in Path(folder.getPath()).rglob("shuffle_*.data")}


def test_shuffle_files_go_with_the_write(spark, scratch):
    before = _shuffle_files(spark)
    rows = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    table = scratch.save(rows, "sums")
    for _ in range(50):  # they go in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert sorted(r.k for r in table.collect()) == list(range(7)) == sorted(r.k for r in rows.collect())
    assert spark.conf.get(FREE_SHUFFLES, "false") == "false"


def test_clustering_leaves_its_results_only(spark, scratch):
    rows = random_spectra(5, families=8, size=6)
    twice = spectra_frame(spark, rows).unionByName(spectra_frame(spark, [dict(r, path="/d/again.mzML") for r in rows[:9]]))
    for least in (2, 4):
        area = scratch.inner(f"of-{least}")
        saved, real = {}, Scratch.save

        def save(self, df, name, saved=saved, real=real):
            table = real(self, df, name)
            saved.setdefault(name, table.columns)
            return table

        Scratch.save = save
        try:
            got = cluster_spectra(twice, ClusterParams(min_samples=least), area)
        finally:
            Scratch.save = real
        assert got.assign.count() == len(rows) + 9 and got.representatives.count() > 0
        assert {name.split("-", 1)[1] for name in _folders(area.root)} == {"assign", "representatives"}
        assert [name for name, columns in saved.items() if "mz" in columns] == ["vectors", "representatives"]


def test_a_later_batch_makes_no_copy_of_what_came(spark, tmp_path, monkeypatch):
    state = State(spark, f"file://{tmp_path}/state")
    rows = random_spectra(9, families=8, size=6)
    frame = spectra_frame(spark, rows)
    run_batch(frame.where("scan % 2 = 0"), state, 0, ClusterParams())
    saved, real = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: saved.append((name, df.columns)) or real(self, df, name))
    run_batch(frame.where("scan % 2 = 1 OR scan % 6 = 0"), state, 1, ClusterParams())
    peaks = [name for name, columns in saved if "mz" in columns]
    assert peaks == ["incoming", "known", "representatives", "vectors", "representatives", "renewed"]
    scans = state.read("scan_list").unionByName(state.read("singletons"), allowMissingColumns=True)
    assert sorted((r.path, r.scan) for r in scans.select("path", "scan").collect()) == sorted((r["path"], r["scan"]) for r in rows)
