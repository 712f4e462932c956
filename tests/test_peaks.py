import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from peakloom.functions import peaks
from peakloom.params import ClusterParams


class _Frame:
    """Takes the place of a DataFrame to get at the kernel."""

    schema = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("mz", "intensity")])

    def mapInArrow(self, kernel, schema):  # noqa: N802
        return kernel


def test_a_batch_is_vectorised_in_bounded_runs(monkeypatch):
    rng = np.random.default_rng(2)
    lists = [None if k % 9 == 0 else (100 + 50 * rng.random(rng.integers(0, 12))).tolist() for k in range(60)]
    batch = pa.RecordBatch.from_pydict({c: pa.array(lists, pa.list_(pa.float64())) for c in ("mz", "intensity")})
    params = ClusterParams(fragment_tol=5.0)
    whole = list(peaks.vectorise(_Frame(), params)(iter([batch])))
    monkeypatch.setattr(peaks, "VECTORISED", 40)
    cut = list(peaks.vectorise(_Frame(), params)(iter([batch])))
    assert len(whole) == 1 and len(cut) > 5
    assert all(sum(len(m or []) for m in b.to_pydict()["mz"]) <= 40 for b in cut)
    assert pa.Table.from_batches(cut).to_pydict() == whole[0].to_pydict()
    # a slice of a larger batch counts its own rows only
    part = list(peaks.vectorise(_Frame(), params)(iter([batch.slice(7, 20)])))
    assert pa.Table.from_batches(part).to_pydict() == whole[0].slice(7, 20).to_pydict()
