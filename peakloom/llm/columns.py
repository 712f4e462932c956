"""Column names of tables that come with columns of their own. Spark compares names without regard to case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that are called like an output, in whatever case: the output replaces them."""
    gone = {n.lower() for n in names}
    return df.select(*[df[c] for c in df.columns if c.lower() not in gone]) if gone & {c.lower() for c in df.columns} else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """A name for each of ``names`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def aside(df: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns called like inner ``names`` put under other names, and all columns under their own again."""
    taken = {n.lower() for n in names}
    clashing = [c for c in df.columns if c.lower() in taken]
    if not clashing:
        return df, [F.col(c) for c in df.columns]
    other = dict(zip(clashing, unused(df, *[f"{c}_own" for c in clashing]), strict=True))
    return df.withColumnsRenamed(other), [F.col(other.get(c, c)).alias(c) for c in df.columns]
