"""Column expressions for identifiers, scan texts, charges and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identifier_filename(identifier: Column) -> Column:
    """Run name (third colon field) with the file suffix."""
    return F.concat(F.get(F.split(identifier, ":"), F.lit(2)), F.lit(".mzML"))


def identifier_scan(identifier: Column) -> Column:
    """Scan text: the last colon field."""
    return F.element_at(F.split(identifier, ":"), -1)


def composite_scan(text: Column) -> Column:
    """Scan number of ``17`` or ``/dir/run.mzML_17``; null for any other text."""
    tail = F.regexp_extract(text, r"\.mzML_(\d+)$", 1)
    return F.when(tail != "", tail.try_cast("bigint")).otherwise(F.trim(text).try_cast("bigint"))


def composite_path(text: Column) -> Column:
    """Path part of ``/dir/run.mzML_17``; null when the text is only a number."""
    return F.when(text.rlike(r"\.mzML_\d+$"), F.regexp_replace(text, r"_\d+$", ""))


def consensus_scan(text: Column) -> Column:
    """Cluster id in the scan text of a representative or sample; null if unreadable.

    Takes what follows the last ``=`` and precedes the first ``_`` after it.
    """
    tail = F.element_at(F.split(text, "="), -1)
    return F.trim(F.get(F.split(tail, "_"), F.lit(0))).try_cast("bigint")


def hashed_scan(text: Column) -> tuple[Column, Column]:
    """``HASH_stem_17`` as (map key, scan): split at the last underscore before digits."""
    key = F.regexp_extract(text, r"^(.*)_(\d+)$", 1)
    scan = F.regexp_extract(text, r"^(.*)_(\d+)$", 2)
    return F.when(key != "", key), F.when(scan != "", scan.try_cast("bigint"))


def path_key(path: Column) -> Column:
    """Short map key of a file: first 8 hex digits of the path's MD5, then the stem."""
    return F.concat_ws("_", F.substring(F.md5(path), 1, 8), stem(path))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.mzML$", "")


def charge_number(text: Column) -> Column:
    """``2+`` gives 2; anything that is not all digits once ``+`` is removed gives 0."""
    digits = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\+", "")
    return F.when(digits.rlike(r"^[0-9]+$"), digits.try_cast("int")).otherwise(F.lit(0))


def signed_charge_number(text: Column) -> Column:
    """Older rule: strip ``+`` at both ends, keep negative numbers, else 0."""
    bare = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"^\++|\++$", "")
    return F.coalesce(F.when(bare.rlike(r"^-?[0-9]+$"), bare.try_cast("int")), F.lit(0))


def first_number(text: Column) -> Column:
    """First blank-separated token as a number (``PEPMASS=445.12 1000`` gives 445.12)."""
    return F.get(F.split(F.trim(text), r"\s+"), F.lit(0)).try_cast("double")


def precursor_probe(*candidates: Column) -> Column:
    """First candidate that is present, as a number; 0 when there is none."""
    return F.coalesce(*[first_number(c.cast("string")) for c in candidates], F.lit(0.0))


def seconds(value: Column, unit: Column) -> Column:
    return F.when(unit == "minute", value * F.lit(60.0)).otherwise(value)


def native_id(scan: Column) -> Column:
    return F.concat(F.lit("controllerType=0 controllerNumber=1 scan="), scan.cast("string"))


def sample_id(cluster_id: Column, sample_no: Column) -> Column:
    return F.concat_ws("_", cluster_id.cast("string"), sample_no.cast("string"))


def path_scan_id(path: Column, scan: Column) -> Column:
    return F.concat_ws("_", path, scan.cast("string"))


def or_zero(value: Column, kind: str = "double") -> Column:
    return F.coalesce(value.try_cast(kind), F.lit(0).cast(kind))
