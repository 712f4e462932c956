from hashlib import sha256

from pyspark.sql import functions as F

from peakloom.llm import manifest

SCHEMA = "doc_id bigint, lang string, text string, tree string, Leaf int"


def _h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _siblings(levels, i):
    out = []
    for row in levels[:-1]:
        out.append((i & 1, row[i ^ 1] if i ^ 1 < len(row) else ""))
        i //= 2
    return out


def _leaf(row, changed=False):
    fields = [row[0], row[1], None if row[2] is None else row[2] + "!" * changed]
    return _h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def _plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault((row[1] is not None, (row[1] or "").encode()), []).append(row)
    trees = []
    for group in sorted(groups):
        own = sorted(groups[group], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees.append((own, _levels([_leaf(r) for r in own])))
    above = _levels([t[1][-1][0] for t in trees])
    root, out = above[-1][0], []
    for t, (own, levels) in enumerate(trees):
        for i, row in enumerate(own):
            path = _siblings(levels, i) + _siblings(above, t)
            folded = _leaf(row, changed=bool(row[0] and row[0] % 7 == 0))
            for left, sibling in path:
                folded = _h(sibling, folded) if left else _h(folded, sibling)
            out.append((row[0], _leaf(row), levels[-1][0], root, _h(*(s for _, s in path)), folded, folded == root))
    return sorted(out, key=str)


def _check(spark, scratch, rows, bits):
    docs = spark.createDataFrame([(*r, "own", 1) for r in rows], SCHEMA).repartition(3)
    leaf = manifest.leaf_digest(F.col("doc_id"), F.col("lang"), F.col("text"))
    changed = manifest.leaf_digest(F.col("doc_id"), F.col("lang"), F.concat("text", F.lit("!")))
    changed = F.when((F.col("doc_id") % 7 == 0) & (F.col("doc_id") != 0), changed)
    built = manifest.build(docs, F.col("lang"), F.col("doc_id"), leaf, changed, bits=bits, scratch=scratch)
    found = manifest.proofs(built, scratch, with_paths=True)
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = found.collect()
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == _plain(rows)
    for r in got:
        siblings = [s for _, s in manifest.read_path(bytes(r["path"]))]
        assert sha256(b"".join(siblings)).hexdigest() == r["proof_sha256"]
        assert manifest.fold(r["leaf"].encode(), manifest.read_path(bytes(r["path"]))).decode() == r["root"]
    return built


def test_against_a_plain_tree(spark, scratch):
    rows = [(i, "en", f"text {i}") for i in range(1, 71)]
    rows += [(i, None, None) for i in (None, None, 3, 3, -5)] + [(9, "en", "text 9"), (9, "en", "other"), (None, "en", "")]
    rows += [(1, "", "x" * 300_000), (7, "de", "ä😀"), (14, "de", None), (10**18, "é", "0"), (5, "z", "-")]
    for bits in (1, 2, 3, 10):  # up to seven tiers
        _check(spark, scratch, rows, bits)


def test_few_rows(spark, scratch):
    _check(spark, scratch, [(7, "en", "a")], 10)
    _check(spark, scratch, [(7, None, "a"), (1, "", "b")], 1)
    empty = spark.createDataFrame([], SCHEMA)
    leaf = manifest.leaf_digest(F.col("doc_id"))
    built = manifest.build(empty, F.col("lang"), F.col("doc_id"), leaf, leaf, scratch=scratch)
    assert built.root is None and manifest.proofs(built, scratch).count() == 0


def test_positions_are_the_order_of_completion():
    for n in [*range(1, 40), 64, 100, 127, 128, 129]:
        leaves = [_h(str(i)) for i in range(n)]
        levels = _levels(leaves)
        nodes = manifest.log_nodes([x.encode() for x in leaves], manifest.height(n))
        assert len(nodes) == sum(map(len, levels)) and manifest.height(n) == len(levels) - 1
        for level, row in enumerate(levels):
            for i, digest in enumerate(row):
                assert nodes[manifest.position(level, i, n)] == digest.encode()


def test_appended_leaves_move_no_complete_node():
    for n in range(1, 60):
        for level in range(manifest.height(n) + 1):
            for i in range(n >> level):
                assert manifest.position(level, i, n) == manifest.position(level, i, n + 17)


def test_segments_are_runs_of_the_log(spark, scratch):
    """Nodes of the lowest tier lie one after the other in the log of the whole tree."""
    rows = [(i, "en", str(i)) for i in range(45)]
    built = _check(spark, scratch, rows, 3)
    log = manifest.log_nodes([_leaf(r).encode() for r in rows], manifest.height(45))
    for r in built.tiers[0].collect():
        start = manifest.position(0, r["segment"] << 3, 45)
        own = [bytes(r["nodes"])[i : i + 32].hex().encode() for i in range(0, len(r["nodes"]), 32)]
        assert log[start : start + len(own)] == own
