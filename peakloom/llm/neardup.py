"""Near-duplicate documents: universal hash minima, banding, verification, connected components.

A document's set holds its distinct shingles of ``k`` words, as 64-bit hashes. ``BANDS * ROWS`` universal hash
functions give a signature of minima; documents that agree in all rows of a band meet in a bucket.

* Equal sets are one class from the start, however many rows share them.
* In each bucket, every class is compared with the bucket's hub, its smallest id, which is linear. Classes of one
  hub make a group, whatever their buckets.
* What is left are groups whose classes lie in different components. There, classes outside the hub's component are
  compared with all others. Small groups list their pairs. Larger ones are dealt to pairs of blocks of bounded
  size; a task counts all intersections of its two blocks as a product of indicator matrices and returns only
  links that join components, so rows stay linear in the blocks.
* Listed pairs are first estimated on the signatures (one byte a function). The bound lies 4.5 standard deviations
  below the threshold. Survivors are confirmed on the full sets, computed again for the classes concerned.
* Links go to components by alternating large-star and small-star; the second round runs on the roots only.

A pair at a similarity of 0.85 misses all bands with a chance of 4e-7 (0.80: 6e-5), and chains of links make a
lost one seldom matter. Hub pairs are split over tasks by their count. All intermediate tables are written under
the checkpoint folder. No bucket, class or component is gathered in one task or on the driver.

Defined cases: null or empty texts and texts without words have an empty set and are linked with nothing;
fewer than ``k`` words make one shingle; a row without doc_id is linked with nothing and kept; rows that repeat
doc_id and set are the same document; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.llm.stars import components
from peakloom.llm.words import SPACED, Classes, binary, bound_batches, buffers, groups, mix, shingles, releasing, words_of
from peakloom.session import Scratch

BANDS, ROWS = 25, 5
FUNCTIONS = BANDS * ROWS
HUB_PART = 2_000  # pairs of one hub that go to one task
SMALL_GROUP = 12  # classes of a group whose pairs are listed
BLOCK_CLASSES, BLOCK_SHINGLES = 800, 1_000_000
COLUMNS = 4096  # shingles of one matrix product
BITMAP = 1 << 25  # bits that tell which ids may go
_draw = np.random.default_rng(7)
FACTORS = _draw.integers(0, 1 << 32, FUNCTIONS, dtype=np.uint32) | np.uint32(1)
TERMS = _draw.integers(0, 1 << 32, FUNCTIONS, dtype=np.uint32)
BAND_FACTORS = _draw.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def _minima(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Signature of each row (rows without shingles must be left out): minima of a * x + b modulo 2^32."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first), FUNCTIONS), np.uint32)
    work = np.empty_like(short)
    for i in range(FUNCTIONS):
        np.multiply(short, FACTORS[i], out=work)
        np.add(work, TERMS[i], out=work)
        out[:, i] = np.minimum.reduceat(work, first)
    return out


def _sketch(column: pa.Array, k: int, classes: Classes) -> list[pa.Array]:
    data, offsets = buffers(column)
    sizes, digests, signatures, bands = [], [], [], []
    for low, high in groups(offsets):
        hashes, first = shingles(words_of(data, offsets[low : high + 1], classes), k)
        filled = np.flatnonzero(np.diff(first))
        lists = iter([])
        if len(filled):
            minima = _minima(hashes, first[filled])
            keys = (minima.reshape(-1, BANDS, ROWS).astype(np.uint64) * BAND_FACTORS).sum(axis=2, dtype=np.uint64)
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            lists = iter(zip(minima.astype(np.uint8), keys, strict=True))
        for row in range(high - low):
            if first[row] == first[row + 1]:
                for values, nothing in ((sizes, 0), (digests, None), (signatures, None), (bands, None)):
                    values.append(nothing)
                continue
            own = np.unique(hashes[first[row] : first[row + 1]])
            minimum, key = next(lists)
            sizes.append(len(own))
            digests.append(blake2b(own.tobytes(), digest_size=16).digest())
            signatures.append(minimum.tobytes())
            bands.append(key)
    return [
        pa.array(sizes, pa.int64()),
        pa.array(digests, pa.binary()),
        pa.array(signatures, pa.binary()),
        pa.array(bands, pa.list_(pa.int64())),
    ]


def _sketches(docs: DataFrame, k: int, classes: Classes) -> DataFrame:
    names = ["doc_id", "n_shingles", "digest", "signature", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = _sketch(binary(batch.column("text")), k, classes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, digest binary, signature binary, bands array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(releasing(run), schema)


def _sets(docs: DataFrame, k: int, classes: Classes) -> DataFrame:
    """(node, digest, shingles): the full sets of the given documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = binary(batch.column("text"))
            data, offsets = buffers(column)
            for low, high in groups(offsets):
                hashes, first = shingles(words_of(data, offsets[low : high + 1], classes), k)
                own = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                digests = [blake2b(x.tobytes(), digest_size=16).digest() for x in own]
                arrays = [
                    batch.column("node").slice(low, high - low),
                    pa.array(digests, pa.binary()),
                    pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "digest", "shingles"])

    kind = docs.schema["node"].dataType.simpleString()
    return docs.mapInArrow(releasing(run), f"node {kind}, digest binary, shingles array<bigint>")


class _Links:
    """Candidate pairs to confirmed links."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, k: int, percent: int, classes: Classes, scratch: Scratch):
        self.docs, self.nodes, self.scratch = docs, nodes, scratch
        self.k, self.percent, self.classes = k, percent, classes
        similarity = percent / 100
        bound = similarity - 4.5 * math.sqrt(similarity * (1 - similarity) / FUNCTIONS)
        self.agreeing = math.floor(FUNCTIONS * (bound + (1 - bound) / 256))

    def _likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose signatures agree in enough places."""
        least = self.agreeing
        signature = self.nodes.select("node", "signature")
        joined = pairs.join(signature.select(F.col("node").alias("hub"), F.col("signature").alias("hub_signature")), "hub")
        joined = joined.join(signature, "node").select("node", "hub", "signature", "hub_signature")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield _agreeing(batch, least)

        return joined.mapInArrow(releasing(run), pairs.schema)

    def _sets_of(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of the given classes, from the whole text of the document they are named after."""
        wanted = self.scratch.save(nodes.distinct(), "wanted")
        texts = self.docs.select(F.col("doc_id").alias("node"), "text").join(wanted, "node")
        sets = _sets(texts, self.k, self.classes).join(self.nodes.select("node", "digest"), ["node", "digest"])
        return self.scratch.save(sets.select("node", "shingles"), "sets")

    def in_blocks(self, groups: DataFrame) -> DataFrame:
        """Links (left, right) that join components of large groups."""
        dealt = _dealt(groups, self.scratch)
        sets = self._sets_of(groups.where(F.col("size") > SMALL_GROUP).select("node"))
        percent = self.percent
        kind = groups.schema["node"].dataType.simpleString()
        arrow = pa.schema([("left", pa.int64()), ("right", pa.int64())])

        def run(table: pa.Table) -> pa.Table:
            return pa.table(list(_block_links(table, percent)), schema=arrow)

        found = dealt.join(sets, "node").groupBy("hub", "first", "kind", "second").applyInArrow(run, "left bigint, right bigint")
        found = found.select(F.col("left").cast(kind).alias("left"), F.col("right").cast(kind).alias("right"))
        return self.scratch.save(found, "links")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Links (left, right) among the pairs (node, hub); hubs may stand in any number of pairs."""
        likely = self.scratch.save(self._likely(pairs), "likely")
        sets = self._sets_of(likely.select("node").unionAll(likely.select(F.col("hub").alias("node"))))
        parts = likely.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_PART).alias("parts"))
        parts = self.scratch.save(parts, "parts")
        many = parts.where(F.col("parts") > 1)
        part = F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).alias("part")
        dealt = likely.join(many, "hub", "left").select("node", "hub", part)
        hubs = sets.join(parts, F.col("node") == F.col("hub")).select(
            "hub",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
            F.col("shingles").alias("hub_shingles"),
        )
        both = dealt.join(hubs, ["hub", "part"]).join(sets, "node")
        common = F.size(F.array_intersect("shingles", "hub_shingles"))
        union = F.size("shingles") + F.size("hub_shingles") - common
        linked = both.where(F.lit(100) * common >= F.lit(self.percent) * union)
        return self.scratch.save(linked.select(F.col("node").alias("left"), F.col("hub").alias("right")), "links")


def _joined(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels after some more links."""
    left = labels.select(F.col("node").alias("left"), F.col("label").alias("left_label"))
    right = labels.select(F.col("node").alias("right"), F.col("label").alias("right_label"))
    met = links.join(left, "left").join(right, "right")
    roots = components(met.select(F.col("left_label").alias("left"), F.col("right_label").alias("right")), scratch)
    roots = roots.select(F.col("node").alias("label"), "root")
    moved = labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return scratch.save(moved, "labels")


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, classes: Classes = SPACED, scratch: Scratch | None = None
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, and ``copies`` (rows of the same doc_id and set).

    Documents are linked whose sets' intersection is ``percent`` hundredths of their union or more;
    component_id is the smallest doc_id reachable, and the document of that id is kept.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    bound_batches(docs.sparkSession)
    rows = scratch.save(_sketches(docs, k, classes), "sketches")
    filled = rows.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    rows_of = filled.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    classes_table = scratch.save(
        rows_of.groupBy("digest").agg(F.min("doc_id").alias("node"), F.max("copies").alias("copies")), "classes"
    )
    nodes = filled.withColumnRenamed("doc_id", "node").join(classes_table.select("node", "digest"), ["node", "digest"])
    nodes = scratch.save(nodes.select("node", "digest", "n_shingles", "signature", "bands"), "nodes")
    met = nodes.select("node", F.explode("bands").alias("bucket"))
    hubs = met.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    hubs = scratch.save(hubs.where(F.col("hub") < F.col("last")).drop("last"), "hubs")
    members = scratch.save(met.join(hubs, "bucket").select("node", "hub").distinct(), "members")
    links = _Links(docs, nodes, k, percent, classes, scratch)

    labels = scratch.save(members.select("node").distinct().select("node", F.col("node").alias("label")), "labels")
    labels = _joined(labels, links.confirmed(members.where(F.col("node") != F.col("hub"))), scratch)
    groups = _groups(members, labels, nodes, scratch)
    listed = links.confirmed(_pairs(groups))
    if not groups.where(F.col("size") > SMALL_GROUP).isEmpty():
        listed = listed.unionAll(links.in_blocks(groups))
    labels = _joined(labels, listed, scratch)

    roots = labels.select("node", F.col("label").alias("root"))
    root_of = classes_table.join(roots, "node", "left")
    root_of = scratch.save(root_of.select("digest", "copies", F.coalesce("root", "node").alias("root")), "roots")
    found = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    component = F.coalesce("root", "doc_id")
    return found.join(root_of, "digest", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
    )


def _groups(members: DataFrame, labels: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(hub, node, label, apart, size): groups of more than one component; ``apart`` from that of the hub."""
    labelled = members.join(labels, "node").join(nodes.select("node", "n_shingles"), "node")
    of_hub = F.min(F.when(F.col("node") == F.col("hub"), F.col("label")))
    total = labelled.groupBy("hub").agg(
        of_hub.alias("hub_label"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.count(F.lit(1)).alias("size"),
    )
    total = scratch.save(total.where((F.col("low") < F.col("high")) & (F.col("size") > 2)).drop("low", "high"), "groups")
    apart = (F.col("label") != F.col("hub_label")).alias("apart")
    return scratch.save(labelled.join(total, "hub").select("hub", "node", "n_shingles", "label", apart, "size"), "apart")


def _pairs(groups: DataFrame) -> DataFrame:
    """Pairs (node, hub) of different components in small groups; those with the hub itself are known already."""
    small = groups.where((F.col("size") <= SMALL_GROUP) & (F.col("node") != F.col("hub")))
    one, two = small.where("apart").alias("one"), small.alias("two")
    met = (F.col("one.hub") == F.col("two.hub")) & (F.col("one.label") != F.col("two.label"))
    once = ~F.col("two.apart") | (F.col("one.node") < F.col("two.node"))
    return one.join(two, met & once).select(F.col("one.node").alias("node"), F.col("two.node").alias("hub")).distinct()


def _dealt(groups: DataFrame, scratch: Scratch) -> DataFrame:
    """Classes of large groups with every pair of blocks (hub, first, kind, second) they take part in.

    Blocks of classes apart from the hub meet each other and all blocks of the hub's component.
    """
    large = groups.where(F.col("size") > SMALL_GROUP)
    count, volume = F.count(F.lit(1)), F.sum("n_shingles")
    blocks = F.ceil(F.greatest(count / BLOCK_CLASSES, volume / BLOCK_SHINGLES))
    sizes = large.groupBy("hub", "apart").agg(blocks.alias("blocks")).groupBy("hub")
    sizes = sizes.agg(
        F.coalesce(F.max(F.when(F.col("apart"), F.col("blocks"))), F.lit(0)).alias("outer"),
        F.coalesce(F.max(F.when(~F.col("apart"), F.col("blocks"))), F.lit(0)).alias("inner"),
    )
    sizes = scratch.save(sizes, "blocks")
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.when(F.col("apart"), F.col("outer")).otherwise(F.col("inner")))
    placed = large.join(sizes, "hub").withColumn("block", own)

    def up_to(n):
        return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))

    def meeting(first, kind, second):
        return F.struct(first.alias("first"), F.lit(kind).alias("kind"), second.alias("second"))

    block = F.col("block")
    with_outer = F.transform(up_to(F.col("outer")), lambda j: meeting(F.least(block, j), "outer", F.greatest(block, j)))
    with_inner = F.transform(up_to(F.col("inner")), lambda j: meeting(block, "inner", j))
    from_inner = F.transform(up_to(F.col("outer")), lambda i: meeting(i, "inner", block))
    meetings = F.when(F.col("apart"), F.concat(with_outer, with_inner)).otherwise(from_inner)
    dealt = placed.select("hub", "node", "label", "apart", "block", F.explode(meetings).alias("m"))
    return dealt.select("hub", "m.first", "m.kind", "m.second", "node", "label", "apart", "block")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    columns = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    places = []
    for sets in (left, right):
        values = np.concatenate(sets)
        rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(columns, values), max(len(columns) - 1, 0))
        there = columns[at] == values if len(columns) else np.zeros(len(values), bool)
        at, rows = at[there], rows[there]
        order = np.argsort(at, kind="stable")
        places.append((at[order], rows[order]))
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(columns), COLUMNS):
        dense = []
        for (at, rows), sets in zip(places, (left, right), strict=True):
            low, high = np.searchsorted(at, [start, start + COLUMNS])
            part = np.zeros((len(sets), min(COLUMNS, len(columns) - start)), np.float32)
            part[rows[low:high], at[low:high] - start] = 1
            dense.append(part)
        total += dense[0] @ dense[1].T
    return total.astype(np.int64)


def _block_links(table: pa.Table, percent: int) -> tuple[list, list]:
    """Links between two blocks that join components, at most one fewer than there are components."""
    first, kind, second = (table.column(c)[0].as_py() for c in ("first", "kind", "second"))
    apart, block = table.column("apart").to_numpy(), table.column("block").to_numpy()
    is_left = apart & (block == first)
    is_right = (apart & (block == second)) if kind == "outer" else ~apart
    if not is_left.any() or not is_right.any():
        return [], []
    nodes, labels = table.column("node").to_pylist(), table.column("label").to_pylist()
    sets = [np.asarray(x.values) for x in table.column("shingles")]
    sizes = np.array([len(x) for x in sets])
    left, right = np.flatnonzero(is_left), np.flatnonzero(is_right)
    common = _common([sets[i] for i in left], [sets[i] for i in right])
    union = sizes[left][:, None] + sizes[right][None, :] - common
    root = {label: label for label in labels}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found = ([], [])
    for i, j in zip(*np.nonzero(100 * common >= percent * union), strict=True):
        a, b = left[i], right[j]
        x, y = find(labels[a]), find(labels[b])
        if x != y:
            root[x] = y
            found[0].append(nodes[a])
            found[1].append(nodes[b])
    return found


def _agreeing(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    one, two = (
        np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, FUNCTIONS)
        for c in ("signature", "hub_signature")
    )
    return batch.select(["node", "hub"]).filter(pa.array((one == two).sum(axis=1) >= least))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the ids of ``gone``, moving few rows besides theirs.

    A bitmap of ``BITMAP`` bits, 4 MB whatever the data, holds a hash of every id that goes. Rows that do not hit it
    stay where they are; only the others, which are those to go and a few more, are joined with the ids.
    """
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(BITMAP))
    words = gone.select(place.alias("p")).groupBy(F.shiftright("p", 5).cast("int").alias("word"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(31).cast("int"))
    words = words.agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP // 32, np.uint32)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def marked(places: pa.Array) -> pa.Array:
        at = places.fill_null(0).to_numpy()
        return pa.array((shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 > 0)

    hit = F.col("doc_id").isNotNull() & marked(place)
    names = docs.columns
    stay = docs.where(~hit).select(*names)
    return stay.unionAll(docs.where(hit).join(gone, "doc_id", "left_anti").select(*names))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept; of rows that repeat a doc_id and its set, one."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.save(near_duplicates(docs, k, percent, scratch=scratch), "found")
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    left = _without(docs, scratch.save(gone, "gone"))
    repeated = found.where(F.col("kept") & (F.col("copies") > 1)).select("doc_id").distinct()
    repeated = scratch.save(repeated, "repeated")
    if repeated.isEmpty():
        return left
    single = left.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    return single.unionAll(left.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"]))
