import pyarrow as pa
from helpers import mzml_text

from peakloom.sources import mzml
from peakloom.sources.mzml_writer import COLUMNS, document, packed, spectrum_xml


def test_text_is_parsed_in_bounded_runs(monkeypatch):
    about = {"level": 2, "charge": 2, "rt": 10.0, "mz": [100.0, 200.5], "intensity": [1.0, 2.0]}
    text = mzml_text([{"scan": k, "mass": 300.0 + k, **about} for k in range(1, 31)])
    chunks = text.split("</spectrum>")[:-1]
    batch = pa.RecordBatch.from_pydict({"path": ["file:/a.mzML"] * len(chunks), "value": chunks})
    whole = list(mzml._decode(iter([batch])))
    monkeypatch.setattr(mzml, "PARSED_AT_ONCE", 5000)
    cut = list(mzml._decode(iter([batch])))
    assert len(whole) == 1 and whole[0].num_rows == 30 and len(cut) > 3
    assert pa.Table.from_batches(cut).to_pydict() == whole[0].to_pydict()


def test_a_document_comes_in_parts():
    parts = list(document(["<spectrum/>\n"] * 3))
    assert len(parts) == 6 and max(map(len, parts)) < 200 and "".join(parts).count('count="3"') == 1


def test_packed_spectra_are_written_alike(spark):
    rows = [("scan=1", 500.0, 1.5, 2, [100.0, 200.5], [1.0, 2.0]), ("scan=2", 300.0, None, None, None, None), ("scan=3", 0.0, 2.0, 1, [], [])]
    kinds = "native_id string, precursor_mz double, rt_sec double, charge int, mz array<double>, intensity array<double>"
    frame = spark.createDataFrame(rows, kinds)
    plain = {r["native_id"]: spectrum_xml(0, r) for r in frame.select(*COLUMNS).collect()}
    small = packed(frame)
    assert dict(small.dtypes)["mz"] == "string"
    assert {r["native_id"]: spectrum_xml(0, r) for r in small.collect()} == plain
