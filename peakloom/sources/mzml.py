"""mzML reader.

The file is read as text cut at ``</spectrum>``, so Spark splits large files by byte range and
packs small ones, on any file system it knows. Spectra of other MS levels are dropped on the
JVM before any Python; an Arrow kernel decodes the rest.

A file of a kind this reader does not take (profile spectra, other compressions, other number
types) is an error in every mode, as it would lose all its spectra. Single damaged spectra are
handled by mode; a batch keeps them in a table of rejects.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom import schemas
from peakloom.functions.peaks import runs
from peakloom.functions.text import basename

# Accessions of the controlled vocabulary used in mzML files.
MS_LEVEL = "MS:1000511"
SCAN_START = "MS:1000016"
UNIT_MINUTE = "UO:0000031"
SELECTED_MZ = "MS:1000744"
CHARGE_STATE = "MS:1000041"
PROFILE = "MS:1000128"
MZ_ARRAY = "MS:1000514"
INTENSITY_ARRAY = "MS:1000515"
FLOAT_32 = "MS:1000521"
FLOAT_64 = "MS:1000523"
ZLIB = "MS:1000574"
NO_COMPRESSION = "MS:1000576"

PARSED = T.StructType(
    [
        *[f for f in schemas.SPECTRUM.fields if f.name != "filename"],
        T.StructField("index", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)
_TAG = re.compile(r"<spectrum[\s>]")


class UnsupportedSpectrum(ValueError):
    """Valid data of a kind that is not read; never left out silently."""


_SHARED_GROUPS = "<referenceableParamGroup "


def _terms(element: ElementTree.Element, groups: dict[str, dict]) -> dict[str, dict]:
    """Parameters of an element by accession, those of referenced groups first."""
    found: dict[str, dict] = {}
    for child in element:
        if child.tag == "referenceableParamGroupRef":
            found.update(groups.get(child.get("ref"), {}))
    for child in element:
        if child.tag == "cvParam":
            found[child.get("accession")] = child.attrib
    return found


def param_groups(text: str) -> dict[str, dict]:
    """Shared parameter groups of a file header."""
    start, end = text.find("<referenceableParamGroupList"), text.find("</referenceableParamGroupList>")
    if start < 0 or end < 0:
        return {}
    root = ElementTree.fromstring(text[start:end] + "</referenceableParamGroupList>")
    return {group.get("id"): _terms(group, {}) for group in root}


def _array(element: ElementTree.Element, terms: dict[str, dict]) -> np.ndarray:
    raw = base64.b64decode(element.findtext("binary") or "")
    if ZLIB in terms:
        raw = zlib.decompress(raw) if raw else raw
    elif NO_COMPRESSION not in terms and raw:
        raise UnsupportedSpectrum("array compression is neither zlib nor none")
    if FLOAT_64 not in terms and FLOAT_32 not in terms and raw:
        raise UnsupportedSpectrum("array values are neither 32-bit nor 64-bit floats")
    return np.frombuffer(raw, dtype="<f8" if FLOAT_64 in terms else "<f4").astype(np.float64)


def _scan_number(attrib: dict[str, str]) -> int:
    """Number after ``scan=`` in the native id, else the last number of the id, else the index.

    Ids of our own exports are read too: the cluster of ``scan=12_1`` (a sample of cluster 12) and
    the scan of ``scan=/d/a.mzML_17`` (a singleton).
    """
    text = attrib.get("id", "")
    for part in text.split():
        if part.startswith("scan=") and part[5:].isdigit():
            return int(part[5:])
    exported = re.search(r"scan=(?:(\d+)_\d+|.*_(\d+))$", text)
    if exported:
        return int(exported[1] or exported[2])
    tail = text.rsplit("=", 1)[-1]
    return int(tail) if tail.isdigit() else int(attrib["index"]) + 1


def parse_spectrum(xml: str, groups: dict[str, dict]) -> dict | None:
    """One ``<spectrum>`` element as a row; null unless its MS level is 2."""
    root = ElementTree.fromstring(xml)
    terms = _terms(root, groups)
    level = int(terms.get(MS_LEVEL, {}).get("value", 0))
    if level != 2:
        return None
    if PROFILE in terms:
        raise UnsupportedSpectrum("profile spectra are not supported: centroid them first")
    selected = root.find("precursorList/precursor/selectedIonList/selectedIon")
    if selected is None:
        raise ValueError("no selected precursor ion")
    ion = _terms(selected, groups)
    scan = root.find("scanList/scan")
    start = _terms(scan, groups).get(SCAN_START) if scan is not None else None
    if start is None:
        raise ValueError("no scan start time")
    minutes = start.get("unitAccession") == UNIT_MINUTE or start.get("unitName") == "minute"
    arrays = {}
    for element in root.iterfind("binaryDataArrayList/binaryDataArray"):
        about = _terms(element, groups)
        for kind in (MZ_ARRAY, INTENSITY_ARRAY):
            if kind in about:
                arrays[kind] = _array(element, about)
    none = np.zeros(0)
    mz, intensity = arrays.get(MZ_ARRAY, none), arrays.get(INTENSITY_ARRAY, none)
    if len(mz) != len(intensity):
        raise ValueError("m/z and intensity arrays differ in length")
    charge = ion.get(CHARGE_STATE, {}).get("value")
    return {
        "scan": _scan_number(root.attrib),
        "ms_level": level,
        "precursor_mz": float(ion[SELECTED_MZ]["value"]),
        "rt_sec": float(start["value"]) * (60.0 if minutes else 1.0),
        "charge": int(charge) if charge else None,
        "title": root.get("id"),
        "mz": mz,
        "intensity": intensity,
    }


def file_system(path: str):
    """(file system, path inside) of a qualified path, as Spark names it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)


def _read_header(path: str) -> str:
    """Text of a file up to its first spectrum list; read only for files that share groups."""
    system, inner = file_system(path)
    text = ""
    with system.open_input_stream(inner) as stream:
        while "<spectrumList" not in text and "</referenceableParamGroupList>" not in text:
            block = stream.read(1 << 16)
            if not block:
                break
            text += block.decode("utf-8", "replace")
    return text


# Characters of text that are parsed at once, about.
PARSED_AT_ONCE = 1 << 22


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of bounded text, so that memory does not follow the rows of a batch."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("value")), 0).to_numpy(zero_copy_only=False)
        for rows in runs(sizes, PARSED_AT_ONCE):
            yield batch.slice(rows.start, rows.stop - rows.start)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict[str, dict] = {}
    names = [f.name for f in PARSED.fields]
    for batch in _pieces(batches):
        rows: list[dict] = []
        for path, chunk in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
            found = _TAG.search(chunk)
            if not found:
                continue
            xml = chunk[found.start() :] + "</spectrum>"
            if "<referenceableParamGroupRef" in xml and path not in cache:
                cache[path] = param_groups(chunk if _SHARED_GROUPS in chunk else _read_header(path))
            try:
                row = parse_spectrum(xml, cache.get(path, {}))
            except UnsupportedSpectrum as problem:
                raise UnsupportedSpectrum(f"{path}: {problem}") from problem
            except Exception as problem:  # one bad spectrum must not lose the others
                number = re.search(r'\sindex="(\d+)"', xml[: xml.find(">")])
                row = {"error": f"{type(problem).__name__}: {problem}", "index": int(number[1]) if number else None}
            if row is not None:
                row["path"] = path
                rows.append(row)
        columns = []
        for name in names:
            values = [row.get(name) for row in rows]
            kind = {
                "path": pa.string(), "scan": pa.int64(), "ms_level": pa.int32(), "precursor_mz": pa.float64(),
                "rt_sec": pa.float64(), "charge": pa.int32(), "title": pa.string(), "mz": pa.list_(pa.float64()),
                "intensity": pa.list_(pa.float64()), "index": pa.int64(), "error": pa.string(),
            }[name]
            columns.append(pa.array(values, kind))
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _chunks(spark: SparkSession, paths: str | list[str], recursive: bool) -> DataFrame:
    reader = spark.read.option("lineSep", "</spectrum>").option("recursiveFileLookup", str(recursive).lower())
    return _only_mzml(reader.option("pathGlobFilter", "*.mzML").text(paths))


def _only_mzml(text: DataFrame) -> DataFrame:
    """Text of MS2 spectra of .mzML files other than ``consensus.mzML``."""
    return only_ms2(text.select(F.col("_metadata.file_path").alias("path"), "value"))


def only_ms2(chunks: DataFrame) -> DataFrame:
    """Chunks (path, value) that may hold an MS2 spectrum, decided on the JVM."""
    tag = F.regexp_extract("value", r'<cvParam[^>]*"' + MS_LEVEL + r'"[^>]*>', 0)
    level = F.regexp_extract(tag, r'value="([^"]*)"', 1)
    return (
        chunks.where(basename(F.col("path")) != "consensus.mzML")
        # Without a level of its own the spectrum may get one from a shared group: Python decides.
        .where((tag == "") | (level == "2"))
        .where(F.col("value").rlike(r"<spectrum[\s>]"))
    )


def parse_chunks(chunks: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """Spectra of text chunks (path, value). The default keeps bad ones as rows with ``index`` and ``error``;
    ``FAILFAST`` stops at the first, ``DROPMALFORMED`` leaves them out."""
    parsed = chunks.mapInArrow(_decode, PARSED).withColumn("filename", basename(F.col("path")))
    columns = [f.name for f in schemas.SPECTRUM.fields]
    if mode == "PERMISSIVE":
        return parsed.select(*columns, "index", "error")
    if mode == "FAILFAST":
        failed = F.raise_error(F.concat(F.lit("unreadable spectrum in "), "path", F.lit(": "), "error"))
        checked = F.when(F.col("error").isNull(), F.col("path")).otherwise(failed.cast("string"))
        return parsed.withColumn("path", checked).select(*columns)
    if mode != "DROPMALFORMED":
        raise ValueError(f"unknown mode {mode!r}")
    return parsed.where(F.col("error").isNull()).select(*columns)


def read_mzml(
    spark: SparkSession, paths: str | list[str], mode: str = "PERMISSIVE", recursive: bool = False
) -> DataFrame:
    """MS2 spectra of mzML files or folders (layout ``schemas.SPECTRUM``), times in seconds."""
    return parse_chunks(_chunks(spark, paths, recursive), mode)


def stream_mzml(spark: SparkSession, folder: str, mode: str = "PERMISSIVE", files_per_trigger: int = 1000) -> DataFrame:
    """The same reader over a landing folder, as a stream of new files."""
    text = (
        spark.readStream.option("lineSep", "</spectrum>")
        .option("pathGlobFilter", "*.mzML")
        .option("maxFilesPerTrigger", files_per_trigger)
        .text(folder)
    )
    return parse_chunks(_only_mzml(text), mode)
