"""Document fingerprints: threshold-scaled sketches of word shingles.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so its length follows the text.
The sketch of a union is the union of sketches, and the sketches of a short and a very long text tell what share
of the short one the long one contains: both keep or drop a common shingle together.

Only DataFrame functions are used. Shingles hold five words (letters, digits and characters outside ASCII, lower
case); fewer words make one shingle. The text form of a fingerprint is the number of distinct shingles, the
smallest hash, and the kept hashes in ascending order, all in hexadecimal.

Defined cases: null counts as empty; an empty text has no shingle and the fingerprint ``0::``. Two fingerprints of
which one keeps no hash are alike (1) if they are equal, else 0. Repeated rows are handled one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakloom.llm.columns import unused, without

SHINGLE = 5
FRACTION = 4  # one hash in so many is kept
NON_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_sketch(df: DataFrame, text: Column, name: str, k: int = SHINGLE, fraction: int = FRACTION) -> DataFrame:
    """``df`` with a column struct(n, least, kept) of the text's sketch.

    Words, their hashes and the shingles are columns of their own, so that none is evaluated again for each element.
    A column called ``name`` already, in whatever case, is replaced.
    """
    df = without(df, name)
    held, made = unused(df, "words", "runs")
    bound = -(1 << 63) + (1 << 64) // fraction
    words = F.split(F.translate(F.coalesce(text, F.lit("")), *_LOWER), NON_WORDS)
    hashed = F.filter(F.transform(words, lambda w: F.when(w != "", F.xxhash64(w))), lambda h: h.isNotNull())
    size = F.size(held)
    starts = F.slice(held, F.lit(1), F.greatest(size - F.lit(k - 1), F.lit(0)))
    runs = F.transform(starts, lambda _, i: F.xxhash64(*[F.get(held, i + j) for j in range(k)]))
    few = F.when(size > 0, F.array(F.xxhash64(held))).otherwise(F.array().cast("array<bigint>"))
    out = df.withColumn(held, hashed)
    out = out.withColumn(made, F.array_distinct(F.when(size >= k, runs).otherwise(few))).drop(held)
    kept = F.array_sort(F.filter(made, lambda h: h < F.lit(bound)))
    sketch = F.struct(F.size(made).alias("n"), F.array_min(made).alias("least"), kept.alias("kept"))
    return out.withColumn(name, sketch).drop(made)


def fingerprint(sketch: Column) -> Column:
    """The text form."""
    return F.concat_ws(
        ":",
        F.hex(sketch["n"].cast("long")),
        F.coalesce(F.hex(sketch["least"]), F.lit("")),
        F.array_join(F.transform(sketch["kept"], lambda h: F.hex(h)), ","),
    )


def containment(one: Column, other: Column) -> Column:
    """Estimated share of the smaller text's shingles that the larger one holds too."""
    least = F.least(F.size(one["kept"]), F.size(other["kept"]))
    same = (one["n"] == other["n"]) & one["least"].eqNullSafe(other["least"]) & (one["kept"] == other["kept"])
    share = F.size(F.array_intersect(one["kept"], other["kept"])) / least
    return F.when(least > 0, share).otherwise(F.when(same, 1.0).otherwise(0.0))


def merged(one: Column, other: Column) -> Column:
    """Kept hashes of two texts put together."""
    return F.array_sort(F.array_union(one["kept"], other["kept"]))


def with_next(
    docs: DataFrame, columns: list[str], key: str = "doc_id", prepare: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """``docs`` with the ``columns`` of the next row in ascending ``key`` as ``next_*``; after the last, the first.

    ``prepare`` adds columns before rows move; they may be among ``columns``.

    Rows are dealt to key ranges, several for each shuffle partition, and each range also gets a copy of the first
    row of the range after it. So every text moves once and no range is larger than its share of the rows. Rows of
    equal key follow one another; null keys come first. Columns called like the new ones, in whatever case, are replaced.
    """
    spark = docs.sparkSession
    docs = without(docs, *[f"next_{c}" for c in columns])
    at, part, to, last, copy = unused(docs, "order", "range", "to", "last", "copy")
    order = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx(order.cast("double"), [i / ranges for i in range(1, ranges)], 100 * ranges)).head()[0]
    splits = [-float("inf"), *sorted(set(cuts or [0.0])), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol=at, outputCol=part)
    dealt = bucketizer.transform(docs.withColumn(at, order.cast("double"))).withColumn(at, order)
    # one row for each range that has any: the range before it, and the place of its first row
    firsts = dealt.groupBy(part).agg(F.min(at).alias(at))
    listed = sorted((r[part], r[at]) for r in firsts.collect())
    if not listed:
        return prepare(docs).select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    before = {first: listed[i - 1][0] for i, (_, first) in enumerate(listed)}
    wrapped = listed[0][1]
    moved = spark.createDataFrame(
        [(first, place, first == wrapped) for first, place in before.items()], f"{at} bigint, {to} double, {last} boolean"
    )
    heads = dealt.join(F.broadcast(moved), at)
    own = F.lit(False).alias(copy)
    names = docs.columns
    body = dealt.select(*names, at, part, own, F.lit(False).alias(last))
    copies = heads.select(*names, at, F.col(to).alias(part), F.lit(True).alias(copy), last)
    together = prepare(body.unionAll(copies))
    row = Window.partitionBy(part).orderBy(last, at, copy, *columns)
    out = together.select("*", *[F.lead(c).over(row).alias(f"next_{c}") for c in columns])
    return out.where(~F.col(copy)).drop(at, part, copy, last)


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as many characters of the following one (or all it has)."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, 1, F.length(text) - half), F.substring(following, 1, half))
