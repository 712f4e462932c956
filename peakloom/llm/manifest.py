"""Merkle manifest of a dataset, kept as a postorder append log.

Rows are the leaves of one tree for each group, in ascending order of a key; the trees' roots, ordered by group, are the
leaves of one tree above. In a tree every two consecutive nodes of a level make one of the next, a last lone node makes
one by itself. Nodes are named by level and index from 0. The log holds them in the order in which they are complete:

* a node whose leaves all exist, ending with leaf j, stands at 2j - popcount(j) + level,
* a node of the right edge that waits for leaves that never come is written at the end of the n leaves:
  2n - popcount(n) + level - (trailing zeros of n) - 1.

So a position needs no index, and leaves that are appended later move no complete node. ``position`` is this form.

Builders are aligned: each takes 2^bits consecutive leaves of one tree, whose nodes are consecutive in the log, and
writes them as one row (a segment). The tops of segments are leaves of the next tier, built the same way, so a tree of
any size never meets in one task. Proofs go down: a segment receives the path above its top and takes the siblings
inside by their positions.

Leaves are hashed where the rows are read; only digests move, once to sort them by (group, key) in ranges and once to
the builders. A group of any share of the rows is spread over ranges and segments.

Defined cases: a null field is hashed as ``-``, anything else as its UTF-8 length, a colon and itself. The null group
comes first, null keys come first in their tree; rows of equal group and key are ordered by their leaves, so repeated
rows are leaves of their own. A single leaf is its tree's root, a single tree's root is the root. Empty tables have no
root and no proofs. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from peakloom.llm.words import bound_batches, releasing
from peakloom.session import Scratch

BITS = 10  # leaves of a builder, as a power of two
_ROW = 33  # bits of the row number in monotonically_increasing_id


def hashed(*inputs: bytes) -> bytes:
    """Lower-case hexadecimal SHA-256 of the inputs put together."""
    return sha256(b"".join(inputs)).hexdigest().encode()


def leaf_digest(*fields: Column) -> Column:
    """The leaf of a row, as bytes: H of each field as length:value, or - if null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def height(leaves: int) -> int:
    return max(leaves - 1, 0).bit_length()


def position(level: int, index: int, leaves: int) -> int:
    """Place of a node in the log of a tree of so many leaves."""
    end = (index + 1) << level
    if end <= leaves:
        return 2 * (end - 1) - (end - 1).bit_count() + level
    zeros = (leaves & -leaves).bit_length() - 1
    return 2 * leaves - leaves.bit_count() + level - zeros - 1


def log_nodes(leaves: list[bytes], top: int) -> list[bytes]:
    """Nodes of a segment up to the level ``top``, in the order of their completion."""
    nodes, open_ = [], []
    for j, node in enumerate(leaves, 1):
        nodes.append(node)
        while j % 2 == 0:
            node = hashed(open_.pop(), node)
            nodes.append(node)
            j //= 2
        open_.append(node)
    level, count = (len(leaves) & -len(leaves)).bit_length() - 1, len(leaves)
    node = open_.pop()
    while level < top:
        node = hashed(open_.pop(), node) if -(-count >> level) % 2 == 0 else hashed(node)
        nodes.append(node)
        level += 1
    return nodes


@lru_cache(16)
def sibling_places(leaves: int, top: int) -> np.ndarray:
    """For each leaf and level below ``top``: the sibling's position, or -1."""
    out = np.full((leaves, top), -1, np.int64)
    for level in range(top):
        count = -(-leaves >> level)
        own = [position(level, i ^ 1, leaves) if i ^ 1 < count else -1 for i in range(count)]
        out[:, level] = np.array(own, np.int64)[np.arange(leaves) >> level]
    return out


def _texts(packed: bytes) -> list[bytes]:
    text = packed.hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its path (side, sibling) lead to."""
    for side, sibling in path:
        leaf = hashed(sibling, leaf) if side == b"L" else hashed(leaf, sibling)
    return leaf


def read_path(path: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(path):
        side = path[at : at + 1]
        size = 0 if side == b"-" else 64
        out.append((side, path[at + 1 : at + 1 + size]))
        at += 1 + size
    return out


def _local_path(i: int, places: np.ndarray, nodes: list[bytes]) -> list[tuple[bytes, bytes]]:
    return [
        (b"-", b"") if at < 0 else (b"L" if i >> level & 1 else b"R", nodes[at]) for level, at in enumerate(places[i].tolist())
    ]


@dataclass
class Manifest:
    """Written tiers of the groups' trees, lowest first, of the tree above, and the root (None: no rows)."""

    tiers: list[DataFrame]
    above: list[DataFrame]
    trees: DataFrame
    root: str | None
    bits: int


def _numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` (tree, ...) with number and total in their tree, in ascending ``order``.

    Ranges of (tree, order) are sorted and written; offsets come from one row per range and tree.
    """
    keys = [F.asc_nulls_first(c) for c in ("tree", *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = scratch.save(placed.withColumn("range", F.shiftright("at", _ROW)), "ordered")
    runs = placed.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("tree")
    before = F.sum("n").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "range", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total"))
    runs = scratch.save(runs, "runs")
    return placed.join(runs, ["tree", "range"]).withColumn("number", F.col("before") + F.col("at") - F.col("first")).drop("range", "at", "first", "before")


def _builder(bits: int, payload: pa.DataType, changed: bool):
    """Leaves sorted by (tree, segment, number) to one row for each segment."""
    schema = pa.schema(
        [
            ("tree", pa.string()),
            ("segment", pa.int64()),
            ("total", pa.int64()),
            ("leaves", pa.int32()),
            ("nodes", pa.binary()),
            ("top", pa.binary()),
            ("keys", pa.list_(payload)),
            ("changed", pa.list_(pa.binary())),
        ]
    )

    def segment(tree: str, number: int, rows: list[tuple]) -> pa.RecordBatch:
        total = rows[0][0]
        top = height(total) if total <= 1 << bits else bits
        nodes = [bytes.fromhex(n.decode()) for n in log_nodes([r[1].hex().encode() for r in rows], top)]
        row = {"tree": tree, "segment": number, "total": total, "leaves": len(rows), "nodes": b"".join(nodes), "top": nodes[-1]}
        row |= {"keys": [r[2] for r in rows], "changed": [r[3] for r in rows] if changed else None}
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for tree, number, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree, number) != now:
                    if rows:
                        yield segment(*now, rows)
                    now, rows = (tree, number), []
                rows.append(row)
        if rows:
            yield segment(*now, rows)

    return run


def _tiers(leaves: DataFrame, bits: int, changed: bool, scratch: Scratch) -> list[DataFrame]:
    """Written segments of every tier; ``leaves`` has tree, number, total, digest, key and changed."""
    out = []
    key = leaves.schema["key"].dataType
    while True:
        schema = T.StructType(
            [
                T.StructField("tree", T.StringType()),
                T.StructField("segment", T.LongType()),
                T.StructField("total", T.LongType()),
                T.StructField("leaves", T.IntegerType()),
                T.StructField("nodes", T.BinaryType()),
                T.StructField("top", T.BinaryType()),
                T.StructField("keys", T.ArrayType(key)),
                T.StructField("changed", T.ArrayType(T.BinaryType())),
            ]
        )
        rows = leaves.withColumn("segment", F.shiftright("number", bits))
        rows = rows.repartition("tree", "segment").sortWithinPartitions("tree", "segment", "number")
        rows = rows.select("tree", "segment", "total", "digest", "key", "changed")
        payload = pa.string() if isinstance(key, T.StringType) else pa.int64()
        built = rows.mapInArrow(releasing(_builder(bits, payload, changed and not out)), schema)
        built = scratch.save(built, f"tier-{len(out)}")
        out.append(built)
        upper = built.where(F.col("total") > 1 << bits)
        if upper.select("tree").limit(1).count() == 0:
            return out
        leaves = upper.select(
            "tree",
            F.col("segment").alias("number"),
            F.shiftright(F.col("total") + ((1 << bits) - 1), bits).alias("total"),
            F.col("top").alias("digest"),
            F.col("segment").alias("key"),
            F.lit(None).cast("binary").alias("changed"),
        )
        key = T.LongType()


def _tops(tiers: list[DataFrame], bits: int) -> DataFrame:
    """(tree, top) of every tree."""
    out = None
    for tier in tiers:
        ended = tier.where(F.col("total") <= 1 << bits).select("tree", "top")
        out = ended if out is None else out.unionAll(ended)
    return out


def build(
    docs: DataFrame, group: Column, key: Column, leaf: Column, changed: Column, bits: int = BITS, scratch: Scratch | None = None
) -> Manifest:
    """The manifest of ``docs``: trees by ``group`` (a string), leaves in the order of ``key`` (a whole number).

    ``changed`` is a second digest of a row, null for most rows, that ``proofs`` folds in place of its leaf: what is
    held against the manifest, where that is not what it was built from.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = scratch or Scratch(spark)
    rows = docs.select(
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("tree"),
        key.cast("bigint").alias("key"),
        leaf.alias("digest"),
        changed.alias("changed"),
    )
    numbered = _numbered(scratch.save(rows, "leaves"), ["key", "digest", "changed"], scratch)
    tiers = _tiers(numbered, bits, True, scratch)
    trees = scratch.save(_tops(tiers, bits), "trees")
    upper = trees.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("top").alias("digest"), F.lit(None).cast("binary").alias("changed"))
    above = _tiers(_numbered(upper, ["key"], scratch), bits, False, scratch)
    root = _tops(above, bits).head()
    return Manifest(tiers, above, trees, root["top"].hex() if root else None, bits)


def _down(above: bool):
    """Segments with the path above their tops to (tree, number, key, path) of their leaves."""
    kind = pa.string() if above else pa.int64()
    schema = pa.schema([("tree", pa.string()), ("number", pa.int64()), ("key", kind), ("path", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, n = _texts(row["nodes"]), row["leaves"]
                places = sibling_places(n, _top(n, nodes))
                out = {"tree": [], "number": [], "key": [], "path": []}
                for i, key in enumerate(row["keys"]):
                    own = b"".join(side + sibling for side, sibling in _local_path(i, places, nodes))
                    out["tree"].append(row["tree"])
                    out["number"].append((row["segment"] << row["bits"]) + i)
                    out["key"].append(key)
                    out["path"].append(own + row["path"])
                yield pa.RecordBatch.from_pydict(out, schema)

    return run


def _top(leaves: int, nodes: list[bytes]) -> int:
    """The level of a segment's top: the levels of complete nodes and one for each node of the right edge."""
    complete = 2 * leaves - leaves.bit_count()
    return (leaves & -leaves).bit_length() - 1 + len(nodes) - complete


def _paths(tiers: list[DataFrame], tops: DataFrame, bits: int, above: bool, scratch: Scratch) -> DataFrame:
    """(tree, number, path) for the leaves of the lowest of ``tiers``, or of its segments where ``above`` is false.

    ``tops`` has (tree, path): what stands above each tree's root.
    """
    paths = None
    for depth in range(len(tiers) - 1, -1, -1):
        ended = tiers[depth].where(F.col("total") <= 1 << bits).select("tree", "segment").join(tops, "tree")
        paths = ended if paths is None else ended.unionAll(paths.select("tree", F.col("number").alias("segment"), "path"))
        if depth == 0 and not above:
            return paths
        held = tiers[depth].select("tree", "segment", "leaves", "nodes", "keys", F.lit(bits).alias("bits"))
        kind = "string" if above and depth == 0 else "bigint"
        paths = held.join(paths, ["tree", "segment"]).mapInArrow(releasing(_down(kind == "string")), f"tree string, number bigint, key {kind}, path binary")
        paths = scratch.save(paths, f"paths-{depth}")
    return paths


def _prove(with_paths: bool):
    names = ["key", "leaf", "subroot", "proof_sha256", "folded_root"]
    schema = pa.schema([(n, pa.int64() if n == "key" else pa.string()) for n in names] + [("path", pa.binary())] * with_paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, n = _texts(row["nodes"]), row["leaves"]
                places = sibling_places(n, _top(n, nodes))
                rest = read_path(row["path"])
                beyond = b"".join(s for _, s in rest)
                subroot = row["subroot"].hex()
                out = {name: [] for name in schema.names}
                for i, (key, changed) in enumerate(zip(row["keys"], row["changed"], strict=True)):
                    leaf = nodes[position(0, i, n)]
                    local = _local_path(i, places, nodes)
                    siblings = b"".join(s for _, s in local) + beyond
                    out["key"].append(key)
                    out["leaf"].append(leaf.decode())
                    out["subroot"].append(subroot)
                    out["proof_sha256"].append(hashed(siblings).decode())
                    out["folded_root"].append(fold(fold(changed.hex().encode() if changed else leaf, local), rest).decode())
                    if with_paths:
                        out["path"].append(b"".join(side + s for side, s in local) + row["path"])
                yield pa.RecordBatch.from_pydict(out, schema)

    return run


def proofs(manifest: Manifest, scratch: Scratch, with_paths: bool = False) -> DataFrame:
    """One row per leaf: key, leaf, subroot, root, proof_sha256, folded_root and verified, on request its path.

    ``path`` holds, from the leaf upward, the side (L, R, or - for none) and the sibling of each level.
    ``folded_root`` is the root that the changed digest, else the leaf, leads to; it is verified if it is the root.
    """
    tiers, bits = manifest.tiers, manifest.bits
    alone = manifest.above[-1].select("tree").distinct().select("tree", F.lit(b"").alias("path"))
    tops = _paths(manifest.above, alone, bits, True, scratch).select(F.col("key").alias("tree"), "path")
    paths = scratch.save(_paths(tiers, tops, bits, False, scratch), "segment-paths")
    subroots = manifest.trees.select("tree", F.col("top").alias("subroot"))
    held = tiers[0].select("tree", "segment", "leaves", "nodes", "keys", "changed").join(paths, ["tree", "segment"]).join(subroots, "tree")
    schema = "key bigint, leaf string, subroot string, proof_sha256 string, folded_root string" + ", path binary" * with_paths
    found = held.drop("tree", "segment").mapInArrow(releasing(_prove(with_paths)), schema)
    root = F.lit(manifest.root).cast("string")
    return found.withColumn("root", root).withColumn("verified", F.col("folded_root") == root)
