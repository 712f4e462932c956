import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.operators import window
from peakloom.operators.components import components
from peakloom.operators.rangejoin import bucket
from peakloom.params import Tolerance


def _rows(spark, table, tol, parts):
    """Rows and vectors of (id, charge, mass, weights by bin)."""
    rows = spark.createDataFrame([(i, c, float(m)) for i, c, m, _ in table], "id bigint, charge int, lo double")
    rows = rows.withColumn("hi", F.col("lo")).withColumn("bucket", bucket(F.col("lo"), tol, parts))
    vectors = [(i, sorted(v), [v[b] for b in sorted(v)]) for i, _, _, v in table]
    return rows, spark.createDataFrame(vectors, "id bigint, bins array<bigint>, weights array<double>")


def _families(seed, families, size, width=30, jitter=0.3, masses=4):
    """Noisy copies of a few vectors, of a few masses."""
    rng = np.random.default_rng(seed)
    out = []
    for f in range(families):
        bins = rng.choice(200, width, replace=False)
        base = rng.random(width) + 0.2
        for _ in range(size):
            w = base * (1 + jitter * rng.random(width))
            w = w / np.sqrt((w**2).sum())
            out.append((len(out), int(f % 2), 500.0 + 4 * rng.integers(masses) + rng.random(), dict(zip(bins.tolist(), w.tolist(), strict=True))))
    return out


def _cosine(a, b):
    return sum(w * b.get(k, 0.0) for k, w in a.items())


@pytest.mark.parametrize("most", [8192, 5])
@pytest.mark.parametrize("text", ["5000 ppm", "2 da"])
def test_pairs_equal_brute_force(spark, scratch, text, most):
    tol = Tolerance.parse(text)
    table = _families(3, 8, 15)
    rows, vectors = _rows(spark, table, tol, 1)
    got = {(min(r.x, r.y), max(r.x, r.y)): r.cosine for r in window.near_pairs(rows, vectors, tol, 0.97, 1, scratch, most=most).collect()}
    want = {}
    for i, c, m, v in table:
        for j, d, n, w in table[i + 1 :]:
            gap = abs(m - n) <= (tol.value if tol.unit == "da" else tol.relative * max(m, n))
            if c == d and gap and _cosine(v, w) >= 0.97:
                want[i, j] = _cosine(v, w)
    assert len(want) > 50 and set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


@pytest.mark.parametrize("most", [8192, 100])
def test_links_of_near_copies_stay_linear(spark, scratch, most):
    """Two groups of 300 near copies make 89,700 pairs, but few links, and vectors move once or so."""
    tol = Tolerance.parse("20000 ppm")
    table = _families(4, 2, 300, jitter=0.1, masses=1)
    rows, vectors = _rows(spark, table, tol, 2)
    links = scratch.save(window.near_pairs(rows, vectors, tol, 0.9, 2, scratch, linking=True, most=most), "links")
    assert len(table) - 2 <= links.count() < 4 * len(table)
    roots = {r.node: r.root for r in components(links.select("x", "y"), scratch, "x", "y").collect()}
    assert roots == {i: 300 * (i // 300) for i in range(600)}
    # no row of a vector and a bin: 30 bins a vector would make 18,000 rows and more
    assert window._dealt(rows, vectors, 2, scratch, most).count() <= 4 * len(table)
