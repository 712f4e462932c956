"""MGF reader, in Spark SQL functions only.

Files are cut at ``BEGIN IONS``; a block counts once its ``END IONS`` line is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.functions.text import charge_number, first_number, precursor_probe

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|infinity|nan)$"


def _value(pairs: Column, key: str) -> Column:
    """Value of a key; the last line wins, missing keys give null."""
    hits = F.filter(pairs, lambda p: p["key"] == key)
    return F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """Spectra of text blocks (column ``value``, other columns pass through)."""
    rest = [c for c in blocks.columns if c != "value"]
    lines = F.transform(F.split("value", r"\r\n|\r|\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    ended = blocks.withColumn("_l", lines).withColumn("_end", F.array_position("_l", "END IONS"))
    body = ended.where("_end > 0").withColumn("_l", F.expr("slice(_l, 1, cast(_end - 1 as int))"))
    pairs = F.transform(
        F.filter("_l", lambda s: F.instr(s, "=") > 0),
        lambda s: F.struct(
            F.lower(F.substring_index(s, "=", 1)).alias("key"),
            F.regexp_replace(s, r"^[^=]*=", "").alias("value"),
        ),
    )
    tokens = F.filter(
        F.transform(F.filter("_l", lambda s: F.instr(s, "=") == 0), lambda s: F.split(s, r"\s+")),
        lambda t: (F.size(t) == 2) & F.forall(t, lambda v: F.lower(v).rlike(_NUMBER)),
    )
    wide = body.withColumn("_kv", pairs).withColumn("_pk", tokens)
    keys = F.array_distinct(F.transform("_kv", lambda p: p["key"]))
    fields = F.map_from_entries(
        F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter("_kv", lambda p: p["key"] == k), -1)["value"].alias("value")))
    )
    kv = F.col("_kv")
    return wide.select(
        *rest,
        _value(kv, "cluster").try_cast("bigint").alias("cluster"),
        _value(kv, "title").alias("title"),
        precursor_probe(_value(kv, "pepmass"), _value(kv, "precursor_mz")).alias("precursor_mz"),
        F.coalesce(first_number(_value(kv, "rtinseconds")), F.lit(0.0)).alias("rt_sec"),
        charge_number(_value(kv, "charge")).alias("charge"),
        F.transform("_pk", lambda t: t[0].cast("double")).alias("mz"),
        F.transform("_pk", lambda t: t[1].cast("double")).alias("intensity"),
        fields.alias("fields"),
    )


def read_mgf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Spectra of MGF files with the known keys typed and all keys, lower-cased, in ``fields``."""
    text = spark.read.option("lineSep", "BEGIN IONS").text(paths)
    return parse_blocks(text.select(F.col("_metadata.file_path").alias("path"), "value"))
