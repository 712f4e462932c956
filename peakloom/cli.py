"""Command line: cluster one folder of mzML files against a checkpoint.

    python -m peakloom.cli --folder in/ --checkpoint_dir state/ --output_dir out/ --batch 0
    spark-submit --py-files peakloom.zip peakloom/cli.py --folder in/ --checkpoint_dir state/ --output_dir out/
"""

from __future__ import annotations

import argparse

from peakloom import __version__
from peakloom.params import ClusterParams
from peakloom.plans.incremental import export_results, run_batch
from peakloom.plans.state import APPENDED, State
from peakloom.session import build_session
from peakloom.sources.mzml import read_mzml


def parser() -> argparse.ArgumentParser:
    base = ClusterParams()
    p = argparse.ArgumentParser(prog="peakloom", description=__doc__.splitlines()[0])
    p.add_argument("--version", action="version", version=__version__)
    p.add_argument("--folder", required=True, help="folder or glob of mzML files")
    p.add_argument("--checkpoint_dir", required=True, help="folder of the cluster tables")
    p.add_argument("--output_dir", required=True)
    p.add_argument("--batch", type=int, help="batch id; default: one after the last committed")
    p.add_argument("--precursor_tol", default="20 ppm", help="number and unit, ppm or Da")
    p.add_argument("--fragment_tol", type=float, default=base.fragment_tol)
    p.add_argument("--min_mz_range", type=float, default=base.min_mz_range)
    p.add_argument("--min_mz", type=float, default=base.min_mz)
    p.add_argument("--max_mz", type=float, default=base.max_mz)
    p.add_argument("--eps", type=float, default=base.eps)
    p.add_argument("--hash_len", type=int, default=base.hash_len)
    p.add_argument("--do_networking", choices=["Yes", "No"], default="Yes")
    p.add_argument("--min_cosine", type=float, default=base.min_cosine)
    p.add_argument("--min_matched_peaks", type=int, default=base.min_matched_peaks)
    p.add_argument("--similarity", choices=["cosine", "entropy"], default=base.score, help="score of the network's pairs")
    p.add_argument("--max_shift", type=float, default=base.max_shift, help="match shifted peaks up to this precursor difference")
    p.add_argument("--enable_peak_filtering", choices=["Yes", "No"], default="Yes", help="strongest peaks only, in the network")
    p.add_argument("--search", choices=["exact", "approximate"], default="exact", help="how neighbours are found")
    p.add_argument("--probes", type=int, default=base.probes, help="lists that an approximate search looks into")
    p.add_argument("--neighbours", type=int, default=base.neighbours, help="neighbours that an approximate search keeps")
    p.add_argument("--mode", choices=["PERMISSIVE", "DROPMALFORMED", "FAILFAST"], default="PERMISSIVE")
    p.add_argument("--sample_size", type=int, default=base.sample_size)
    p.add_argument("--sample_seed", default=base.sample_seed)
    p.add_argument("--min_samples", type=int, default=base.min_samples)
    p.add_argument("--compact", choices=["Yes", "No"], default="No", help="compact the tables of all batches afterwards")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    params = ClusterParams(
        precursor_tol=args.precursor_tol,
        fragment_tol=args.fragment_tol,
        min_mz_range=args.min_mz_range,
        min_mz=args.min_mz,
        max_mz=args.max_mz,
        eps=args.eps,
        hash_len=args.hash_len,
        do_networking=args.do_networking == "Yes",
        min_cosine=args.min_cosine,
        min_matched_peaks=args.min_matched_peaks,
        score=args.similarity,
        approximate=args.search == "approximate",
        probes=args.probes,
        neighbours=args.neighbours,
        max_shift=args.max_shift,
        peak_filter=args.enable_peak_filtering == "Yes",
        sample_size=args.sample_size,
        sample_seed=args.sample_seed,
        min_samples=args.min_samples,
    )
    spark = build_session("peakloom")
    state = State(spark, args.checkpoint_dir.rstrip("/"))
    done = state.commits()
    batch = args.batch if args.batch is not None else (done[-1] + 1 if done else 0)
    facts = run_batch(read_mzml(spark, args.folder, args.mode), state, batch, params)
    export_results(state, batch, args.output_dir.rstrip("/"), params)
    if args.compact == "Yes":
        for table in APPENDED:
            state.compact(table)
    return facts


if __name__ == "__main__":
    main()
