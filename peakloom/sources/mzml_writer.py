"""mzML export as a Spark data source: every task writes complete documents of its own.

``df.write.format("mzml").mode("overwrite").save(folder)`` with columns native_id, precursor_mz,
rt_sec, charge, mz, intensity. Options: ``prefix`` (file name start) and ``maxRecords``
(spectra per file, so that a task's memory stays bounded).
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import quoteattr

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from peakloom.functions.peaks import VECTORISED, list_lengths, runs
from peakloom.session import qualified, shuffles_freed
from peakloom.sources.mzml import file_system

COLUMNS = ["native_id", "precursor_mz", "rt_sec", "charge", "mz", "intensity"]


def _cv(accession: str, name: str, value: object = "", unit: str = "") -> str:
    return f'<cvParam cvRef="MS" accession="{accession}" name="{name}" value="{value}"{unit}/>'


def _encoded(values) -> str:
    return base64.b64encode(zlib.compress(np.asarray(values, dtype="<f8").tobytes())).decode()


def _binary(values, accession: str, name: str) -> str:
    data = values if isinstance(values, str) else _encoded(values)
    terms = _cv("MS:1000523", "64-bit float") + _cv("MS:1000574", "zlib compression") + _cv(accession, name)
    return f'<binaryDataArray encodedLength="{len(data)}">{terms}<binary>{data}</binary></binaryDataArray>'


def spectrum_xml(index: int, row) -> str:
    """``row`` has arrays, or those of ``packed``."""
    mz, intensity = row["mz"] or [], row["intensity"] or []
    count = row["n_peaks"] if isinstance(mz, str) else len(mz)
    second = ' unitCvRef="UO" unitAccession="UO:0000010" unitName="second"'
    return (
        f'<spectrum index="{index}" id={quoteattr(row["native_id"])} defaultArrayLength="{count}">'
        + _cv("MS:1000511", "ms level", 2)
        + _cv("MS:1000127", "centroid spectrum")
        + '<scanList count="1"><scan>'
        + _cv("MS:1000016", "scan start time", repr(float(row["rt_sec"] or 0.0)), second)
        + '</scan></scanList><precursorList count="1"><precursor><selectedIonList count="1"><selectedIon>'
        + _cv("MS:1000744", "selected ion m/z", repr(float(row["precursor_mz"] or 0.0)))
        + _cv("MS:1000041", "charge state", int(row["charge"] or 0))
        + '</selectedIon></selectedIonList></precursor></precursorList><binaryDataArrayList count="2">'
        + _binary(mz, "MS:1000514", "m/z array")
        + _binary(intensity, "MS:1000515", "intensity array")
        + "</binaryDataArrayList></spectrum>\n"
    )


def packed(df: DataFrame) -> DataFrame:
    """Spectra with the peaks as the text that goes into a file, and ``n_peaks``: rows of Python stay small. Map-only."""
    lists = ["mz", "intensity"]
    table = df.select(*COLUMNS)
    fields = [T.StructField(f.name, T.StringType()) if f.name in lists else f for f in table.schema.fields]
    schema = T.StructType([*fields, T.StructField("n_peaks", T.LongType())])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in runs(list_lengths(batch.column("mz")), VECTORISED):
                part = batch.slice(rows.start, rows.stop - rows.start)
                columns = {n: part.column(n) for n in COLUMNS}
                for name in lists:
                    lengths = list_lengths(part.column(name))
                    pieces = np.split(part.column(name).flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)[:-1])
                    columns[name] = pa.array([_encoded(v) for v in pieces], pa.string())
                columns["n_peaks"] = pa.array(list_lengths(part.column("mz")), pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    return table.mapInArrow(kernel, schema)


def document(spectra: list[str]) -> Iterator[str]:
    """The text of a document in parts, so that it is never whole in memory."""
    yield '<?xml version="1.0" encoding="utf-8"?>\n<mzML xmlns="http://psi.hupo.org/ms/mzml" version="1.1.0">\n'
    yield f'<run id="run"><spectrumList count="{len(spectra)}">\n'
    yield from spectra
    yield "</spectrumList></run>\n</mzML>\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    spectra: int


class MzMLWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.prefix = options.get("prefix", "part")
        self.limit = int(options.get("maxrecords", options.get("maxRecords", 5000)))
        self.overwrite = overwrite
        self.attempt = f"_pending-{uuid.uuid4().hex}"

    def _system(self):
        return file_system(self.path)

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext

        system, base = self._system()
        folder = f"{base}/{self.attempt}"
        system.create_dir(folder, recursive=True)
        task = TaskContext.get()
        names, pending, total = [], [], 0

        def flush() -> None:
            name = f"{self.prefix}-{task.partitionId():05d}-{task.taskAttemptId()}-{len(names):04d}.mzML"
            with system.open_output_stream(f"{folder}/{name}") as out:
                for part in document(pending):
                    out.write(part.encode())
            names.append(name)
            pending.clear()

        for row in rows:
            pending.append(spectrum_xml(len(pending), row))
            total += 1
            if len(pending) >= self.limit:
                flush()
        if pending:
            flush()
        return Written(names, total)

    def commit(self, messages: list[Written | None]) -> None:
        """Old files go only once all new ones are there; then the new ones move in."""
        from pyarrow import fs

        system, base = self._system()
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if info.type == fs.FileType.File and info.base_name.startswith(f"{self.prefix}-"):
                    system.delete_file(info.path)
        for message in messages:
            for name in message.files if message else []:
                system.move(f"{base}/{self.attempt}/{name}", f"{base}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, base = self._system()
        from pyarrow import fs

        if system.get_file_info(f"{base}/{self.attempt}").type != fs.FileType.NotFound:
            system.delete_dir(f"{base}/{self.attempt}")


class MzMLDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mzml"

    def schema(self) -> str:
        return "native_id string, precursor_mz double, rt_sec double, charge int, mz array<double>, intensity array<double>"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return MzMLWriter(self.options, overwrite)


def write_mzml(df, folder: str, prefix: str = "part", max_records: int = 5000) -> None:
    """Export spectra (columns as in ``COLUMNS``) as mzML files in a folder."""
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(MzMLDataSource)
    # Resolved here, so that a path without a scheme means the session's file system on every machine.
    folder = qualified(spark, folder)
    with shuffles_freed(spark):
        packed(df).write.format("mzml").mode("overwrite").option("prefix", prefix).option(
            "maxRecords", str(max_records)
        ).save(folder)
