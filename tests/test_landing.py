import numpy as np
from helpers import mzml_text

from peakloom import cli
from peakloom.params import ClusterParams
from peakloom.plans.state import State
from peakloom.sources.mzml import stream_mzml
from peakloom.streaming import landing


def folder(tmp_path, name, scans, seed):
    rng = np.random.default_rng(5)
    mz, inten = np.sort(rng.uniform(100, 900, 15)), rng.uniform(10, 100, 15)
    rng = np.random.default_rng(seed)
    rows = [dict(scan=n, mass=500.0, charge=2, rt=1.0 * n, mz=mz, intensity=inten * rng.uniform(0.9, 1.1, 15)) for n in scans]
    rows.append(dict(scan=99, mass=700.0 + seed, charge=1, rt=5.0, mz=rng.uniform(100, 900, 9), intensity=rng.uniform(1, 9, 9)))
    (tmp_path / name).mkdir(parents=True, exist_ok=True)
    (tmp_path / name / f"{name}.mzML").write_text(mzml_text(rows))
    return tmp_path / name


def test_command_line_runs_two_batches(spark, tmp_path):
    args = ["--checkpoint_dir", f"file://{tmp_path}/state", "--eps", "0.1", "--compact", "Yes"]
    for n, scans in enumerate(([1, 2, 3], [4, 5, 6, 7])):
        source = folder(tmp_path, f"in{n}", scans, n)
        facts = cli.main(["--folder", str(source), "--output_dir", f"file://{tmp_path}/out{n}", *args])
        assert facts["batch_id"] == n and facts["n_members"] == len(scans) and facts["n_singletons"] == n + 1
        state = State(spark, f"file://{tmp_path}/state")  # the second batch reads what the first has compacted
        assert all(len(state.live_folders(t)) == 1 for t in ("scan_list", "store", "sample_list", "rejects"))
    assert facts["max_cluster_id"] == 1 and state.read("scan_list").count() == 7
    for name in ("cluster_info.tsv", "cluster_summary.tsv", "consensus", "singletons", "networking/merged_pairs.tsv"):
        assert (tmp_path / "out1" / name).exists()


def test_stream_of_mzml_files(spark, tmp_path):
    folder(tmp_path, "landing", [1, 2, 3], 1)
    state = State(spark, f"file://{tmp_path}/state")
    for _ in range(2):  # starting again finds nothing new
        landing.start(stream_mzml(spark, str(tmp_path / "landing")), state, ClusterParams()).awaitTermination()
    assert state.commits() == [0]
    assert state.read("scan_list").count() == 3 and state.read("singletons").count() == 1
