"""Table layouts. Every reader and writer uses these; nothing is inferred."""

from pyspark.sql import types as T

PEAKS = [
    T.StructField("mz", T.ArrayType(T.DoubleType())),
    T.StructField("intensity", T.ArrayType(T.DoubleType())),
]

SPECTRUM = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("scan", T.LongType()),
        T.StructField("ms_level", T.IntegerType()),
        T.StructField("precursor_mz", T.DoubleType()),
        T.StructField("rt_sec", T.DoubleType()),
        T.StructField("charge", T.IntegerType()),
        T.StructField("title", T.StringType()),
        *PEAKS,
    ]
)

SCAN_LIST = T.StructType(
    [
        T.StructField("cluster_id", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("scan", T.LongType()),
        T.StructField("precursor_mz", T.DoubleType()),
        T.StructField("retention_time", T.DoubleType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

SAMPLE_LIST = T.StructType([*SCAN_LIST.fields, T.StructField("sample_no", T.IntegerType())])

CONSENSUS = T.StructType(
    [
        T.StructField("cluster_id", T.LongType()),
        T.StructField("precursor_mz", T.DoubleType()),
        T.StructField("rt_sec", T.DoubleType()),
        T.StructField("charge", T.IntegerType()),
        T.StructField("title", T.StringType()),
        *PEAKS,
        T.StructField("updated_batch", T.LongType()),
    ]
)

STORE = T.StructType(
    [
        *SPECTRUM.fields,
        T.StructField("batch_id", T.LongType()),
    ]
)

CLUSTERING_CSV = T.StructType(
    [
        T.StructField("cluster", T.LongType()),
        T.StructField("precursor_mz", T.DoubleType()),
        T.StructField("retention_time", T.DoubleType()),
        T.StructField("identifier", T.StringType()),
    ]
)

ASSIGNMENT_TSV = T.StructType(
    [
        *CLUSTERING_CSV.fields,
        T.StructField("filename", T.StringType()),
        T.StructField("scan", T.StringType()),
    ]
)

PAIRS = T.StructType(
    [
        T.StructField("left_id", T.LongType()),
        T.StructField("right_id", T.LongType()),
        T.StructField("cosine", T.DoubleType()),
        T.StructField("matched_peaks", T.IntegerType()),
        T.StructField("delta_mz", T.DoubleType()),
    ]
)


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def conform(df, schema: T.StructType):
    """Select and cast to a layout; columns the frame lacks become null."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
