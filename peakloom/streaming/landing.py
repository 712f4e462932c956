"""Batches from a landing folder: a stream whose every micro-batch is one incremental batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from peakloom.params import ClusterParams
from peakloom.plans.incremental import run_batch
from peakloom.plans.state import State


def start(
    spectra: DataFrame, state: State, params: ClusterParams | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Feed a stream of spectra (layout ``schemas.SPECTRUM``) into the cluster tables.

    The micro-batch number is the batch id. The stream's own checkpoint lives with the tables, so
    both move on together; a micro-batch delivered again finds its commit and does nothing.
    """

    def step(rows: DataFrame, epoch: int) -> None:
        run_batch(rows, state, epoch, params)

    writer = spectra.writeStream.foreachBatch(step).option("checkpointLocation", f"{state.folder}/_stream")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
