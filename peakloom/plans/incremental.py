"""One batch: cluster it against what is known, merge, export, commit.

Phase 1 clusters the batch with the representatives and samples of known clusters. Spectra left
over meet the singletons of earlier batches in phase 2, where every cluster is new. What is left
then becomes the new set of singletons.
"""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom import schemas
from peakloom.functions.text import native_id, path_scan_id, sample_id
from peakloom.operators.cluster import cluster_spectra
from peakloom.operators.ids import max_id
from peakloom.operators.merge import initial_clusters, merge_clusters, overwrite
from peakloom.operators.network import network_pairs
from peakloom.operators.sample import draw_samples, samples_of_clusters, scans_to_keep
from peakloom.operators.store import lookup
from peakloom.operators.summary import cluster_info, cluster_summary
from peakloom.params import ClusterParams
from peakloom.plans.state import REJECTS, State
from peakloom.session import Scratch, write_text
from peakloom.sources.mzml_writer import write_mzml
from peakloom.sources.tables import write_cluster_info, write_cluster_summary, write_tsv

SPECTRUM_COLUMNS = ["path", "filename", "scan", "precursor_mz", "rt_sec", "charge", "title", "mz", "intensity"]


@dataclass
class Timing:
    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def step(self, name: str):
        start = time.monotonic()
        yield
        self.seconds[name] = time.monotonic() - start

    def report(self) -> dict[str, float]:
        total = sum(self.seconds.values())
        return {**{k: round(v, 2) for k, v in self.seconds.items()}, "total wall time (hours)": round(total / 3600, 4)}


def _as_input(df: DataFrame, source: str, ref: str | None = None) -> DataFrame:
    reference = F.col(ref) if ref else F.lit(None)
    if "batch_id" not in df.columns:
        df = df.withColumn("batch_id", F.lit(None).cast("bigint"))
    number = [c for c in df.columns if c == "spec_id"]
    return df.withColumn("source", F.lit(source)).withColumn("ref_cluster", reference.cast("bigint")).select(
        *number, *SPECTRUM_COLUMNS, "batch_id", "source", "ref_cluster"
    )


def known_spectra(state: State) -> DataFrame:
    """Representatives, and the sampled members of large clusters, as clustering input."""
    consensus = (
        state.current_consensus()
        .withColumn("path", F.concat(F.lit("consensus_"), F.col("cluster_id").cast("string")))
        .withColumn("filename", F.col("path"))
        .withColumn("scan", F.col("cluster_id"))
    )
    samples = samples_of_clusters(state.read("sample_list"), state.read("scan_list"))
    stored = state.stored(samples).join(samples.select("path", "scan", "cluster_id"), ["path", "scan"])
    return _as_input(consensus, "consensus", "cluster_id").unionByName(_as_input(stored, "sample", "cluster_id"))


def _scan_rows(members: DataFrame) -> DataFrame:
    """Scan-list rows; each carries the batch in which its spectrum first came."""
    return members.withColumn("retention_time", F.coalesce("rt_sec", F.lit(0.0))).select(
        *schemas.columns(schemas.SCAN_LIST)
    )


def _split(spectra: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Good spectra, and the rejects if the reader has kept them (a column ``error``)."""
    if "error" not in spectra.columns:
        return spectra, None
    parsed = scratch.save(spectra, "parsed")
    rejects = parsed.where(F.col("error").isNotNull()).select("path", "index", "error")
    return parsed.where(F.col("error").isNull()).drop("index", "error"), rejects


def _once(spectra: DataFrame, batch_id: int, scratch: Scratch) -> DataFrame:
    """The batch as a written table with one row per (path, scan), the last of repeated ones, and its ``spec_id``.

    Only keys are shuffled to find repeats; peaks move only if there are any.
    """
    raw = scratch.save(
        schemas.conform(spectra.withColumn("ms_level", F.lit(2)), schemas.SPECTRUM)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .withColumn("spec_id", F.monotonically_increasing_id()),
        "incoming",
    )
    repeats = scratch.save(
        raw.groupBy("path", "scan").agg(F.count("*").alias("_n"), F.max("spec_id").alias("_last")).where("_n > 1").drop("_n"),
        "repeats",
    )
    if repeats.isEmpty():
        return raw
    kept = raw.join(repeats, ["path", "scan"], "left").where("_last IS NULL OR spec_id = _last")
    once = scratch.save(kept.drop("_last"), "once")
    scratch.drop(raw)
    return once


def run_batch(
    spectra: DataFrame, state: State, batch_id: int, params: ClusterParams | None = None, chunk: int = 4096
) -> dict:
    """Process one batch and commit it; returns its commit record.

    A batch that is already committed is left as it is. ``spectra`` has the layout
    ``schemas.SPECTRUM``; of a (path, scan) given twice the last counts. Rows with ``error``
    become the batch's rejects, counted by kind in the commit record.

    A spectrum that is sent again stays where it is if it is a member of a cluster; its peaks are
    renewed in the store. If it is still a singleton, the new one takes its place.
    """
    params = params or ClusterParams()
    if state.committed(batch_id):
        return state.meta(batch_id)
    earlier = state.commits()
    if earlier and batch_id < earlier[-1]:
        raise ValueError(f"batch {batch_id} comes before the committed batch {earlier[-1]}")
    scratch = Scratch(state.spark)
    try:
        return _run(spectra, state, batch_id, params, chunk, earlier, scratch)
    finally:
        scratch.clear()


def _all_stored(samples: DataFrame, stored: DataFrame) -> None:
    """Fail before the commit if a new sample's spectrum is nowhere in the store."""
    lost = samples.select("path", "scan").join(stored, ["path", "scan"], "left_anti").limit(3).collect()
    if lost:
        raise ValueError("sampled spectra are not in the store, among them " + ", ".join(f"{r.path}:{r.scan}" for r in lost))


def _run(
    spectra: DataFrame, state: State, batch_id: int, params: ClusterParams, chunk: int, earlier: list[int], scratch: Scratch
) -> dict:
    timing = Timing()
    spectra, rejects = _split(spectra, scratch)
    incoming = _once(spectra, batch_id, scratch)
    key = ["path", "scan"]
    old_singles = state.read("singletons")
    new = incoming
    if earlier:
        # Of what came again only the keys are written; without any, no peaks move to leave it out.
        sent = incoming.select(*key)
        again = scratch.save(sent.join(state.read("scan_list").select(*key), key, "left_semi"), "again")
        new = incoming.join(again, key, "left_anti")
        fresher = scratch.save(sent.join(old_singles.select(*key), key, "left_semi"), "fresher")
        old_singles = old_singles.join(fresher, key, "left_anti")
    base = state.max_cluster_id()
    fresh = _as_input(new, "batch")

    if not earlier:
        with timing.step("cluster"):
            first = cluster_spectra(fresh, params, scratch, chunk, numbered=True)
        merged = initial_clusters(first.assign, scratch)
        members, left_over = merged.members, merged.singletons
        reps = first.representatives.withColumn("cluster_id", F.col("temp_cluster") + 1).drop("temp_cluster")
        candidates = merged.merge_candidates
    else:
        with timing.step("phase 1 cluster"):
            # Numbers below those of the batch.
            known = known_spectra(state).withColumn("spec_id", -1 - F.monotonically_increasing_id())
            both = fresh.unionByName(scratch.save(known, "known"))
            one = cluster_spectra(both, params, scratch, chunk, numbered=True)
        with timing.step("phase 1 merge"):
            first = merge_clusters(one.assign, base, scratch, one.representatives, state.read("scan_list"))
            top = max(base, max_id(first.id_map))
        alone = new.drop("spec_id").join(first.singletons.select(*key), key, "left_semi")
        second_input = alone.unionByName(old_singles)
        with timing.step("phase 2 cluster"):
            two = cluster_spectra(_as_input(second_input, "singleton"), params, scratch, chunk)
        with timing.step("phase 2 merge"):
            second = merge_clusters(two.assign, top, scratch, two.representatives)
        members = first.members.unionByName(second.members)
        left_over = second.singletons
        reps = first.representatives.unionByName(second.representatives)
        candidates = first.merge_candidates

    with timing.step("save"):
        added = state.write("scan_list", batch_id, _scan_rows(members))
        scan_list = state.read("scan_list").unionByName(added)
        renewed = reps.where(F.size("mz") > 0).withColumn("updated_batch", F.lit(batch_id).cast("bigint"))
        renewed = scratch.save(schemas.conform(renewed, schemas.CONSENSUS), "renewed")
        consensus = state.write("consensus", batch_id, overwrite(state.read("consensus"), renewed, ["cluster_id"]))
        old_samples = state.read("sample_list")
        drawn = state.write(
            "sample_list", batch_id, draw_samples(scan_list, old_samples, params.sample_size, params.sample_seed)
        )
        singles = state.write(
            "singletons",
            batch_id,
            new.drop("spec_id").unionByName(old_singles).join(left_over.select(*key), key, "left_semi"),
        )
        # The new samples may be members stored by earlier batches; only this batch's own are added.
        keep = scans_to_keep(scan_list, old_samples.unionByName(drawn), singles, batch_id, params.sample_size)
        stored = lookup(incoming, keep)
        if earlier:  # a member that came again is stored anew where the store holds it
            held = state.read("store").select(*key).join(incoming.select(*key), key, "left_semi")
            stored = lookup(incoming, keep.unionAll(held).distinct())
        stored = state.write("store", batch_id, stored)
        _all_stored(drawn, state.read("store").select(*key).unionAll(stored.select(*key)))
        state.write("merge_candidates", batch_id, candidates)
        top_id = max(base, max_id(consensus), max_id(added))
    rejected = state.write("rejects", batch_id, state.spark.createDataFrame([], REJECTS) if rejects is None else rejects)
    kinds = rejected.groupBy(F.substring_index("error", ":", 1).alias("kind")).agg(F.count("*").alias("n"))
    facts = {
        "rejected": {r.kind: r.n for r in kinds.orderBy("kind").collect()},
        "max_cluster_id": int(top_id),
        "n_incoming": incoming.count(),
        "n_members": added.count(),
        "n_singletons": singles.count(),
        "seconds": timing.report(),
    }
    state.commit(batch_id, **facts)
    return state.meta(batch_id)


def consensus_export(state: State, size: int = 5) -> DataFrame:
    """Rows of the representatives' export: one per cluster, and the samples of large clusters."""
    peaks = ["precursor_mz", "rt_sec", "charge", "mz", "intensity"]
    reps = state.current_consensus().select(native_id(F.col("cluster_id")).alias("native_id"), *peaks)
    samples = samples_of_clusters(state.read("sample_list"), state.read("scan_list"))
    numbered = samples.where(F.col("sample_no") <= size).select("cluster_id", "sample_no", "path", "scan")
    stored = state.stored(numbered).select("path", "scan", *peaks)
    named = sample_id(F.col("cluster_id"), F.col("sample_no"))
    return reps.unionByName(stored.join(numbered, ["path", "scan"]).select(native_id(named).alias("native_id"), *peaks))


def missing_samples(state: State) -> DataFrame:
    """Sampled spectra that the store does not hold (expected to be none)."""
    return state.read("sample_list").join(state.read("store").select("path", "scan"), ["path", "scan"], "left_anti")


def singleton_export(state: State) -> DataFrame:
    name = native_id(path_scan_id(F.col("path"), F.col("scan")))
    return state.read("singletons").select(name.alias("native_id"), "precursor_mz", "rt_sec", "charge", "mz", "intensity")


def result_tables(state: State, batch_id: int) -> tuple[DataFrame, DataFrame]:
    scan_list = state.read("scan_list")
    return cluster_info(scan_list, batch_id), cluster_summary(scan_list, state.current_consensus())


def export_results(state: State, batch_id: int, folder: str, params: ClusterParams | None = None) -> None:
    """Write result tables, spectra, the pair list and the timing report into a folder."""
    params = params or ClusterParams()
    info, summary = result_tables(state, batch_id)
    write_cluster_info(info, f"{folder}/cluster_info.tsv")
    write_cluster_summary(summary, f"{folder}/cluster_summary.tsv")
    write_mzml(consensus_export(state, params.sample_size), f"{folder}/consensus", "consensus")
    write_mzml(singleton_export(state), f"{folder}/singletons", "singletons")
    if params.do_networking:
        scratch = Scratch(state.spark)
        spectra = state.current_consensus().select(F.col("cluster_id").alias("id"), "precursor_mz", "mz", "intensity")
        write_tsv(network_pairs(spectra, params, scratch), f"{folder}/networking/merged_pairs.tsv")
        scratch.clear()
    write_text(state.spark, f"{folder}/timing_report.json", json.dumps(state.meta(batch_id)["seconds"], indent=1))
