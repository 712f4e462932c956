"""Work that grows with the input: reading documents, sorting peaks, bounds of long vectors."""

import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from peakloom.catalog.inputs import PARAMS, document_peaks, document_spectra
from peakloom.functions.peaks import row_order
from peakloom.operators.blocks import Lists, Side, dot_products
from peakloom.operators.cluster import prepare

TEXTS = [
    (1, 10, "a b\ta\n\nc "),
    (2, 10, "  café naïve x   a"),
    (3, 10, ""),
    (4, 10, " \t\n"),
    (5, 10, None),
    (6, 10, "one\x0btwo\x0cthree\rfour"),
    (7, None, "b b b"),
    (None, 10, "a"),
]


def place(word):
    return 50.025 + (int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 19500) / 10.0


def words(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]


def documents(spark, tmp_path, rows):
    table = spark.createDataFrame([(*r, "en") for r in rows], "doc_id bigint, n_chars bigint, text string, lang string")
    table.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_documents_as_spectra(spark, tmp_path):
    sf = documents(spark, tmp_path, TEXTS)
    found = {r.scan: r for r in document_spectra(spark, sf).collect()}
    for doc_id, _, text in TEXTS:
        row = found[doc_id]
        if text is None:
            assert row.mz is None and row.intensity is None
        else:
            assert row.mz == [place(w) for w in words(text)] and row.intensity == [1.0] * len(row.mz)


def test_documents_as_peaks_with_repeated_keys(spark, tmp_path):
    sf = documents(spark, tmp_path, [*TEXTS, (1, 10, "c d"), (1, 11, "e"), (None, 10, "b a"), (5, 10, None)])
    expected = {}
    for doc_id, n, text in [*TEXTS, (1, 10, "c d"), (1, 11, "e"), (None, 10, "b a")]:
        for w in words(text):
            at = expected.setdefault((doc_id, None if n is None else n + 100.0), {})
            at[place(w)] = at.get(place(w), 0.0) + 1.0
    found = {(r.id, r.precursor_mz): dict(zip(r.mz, r.intensity, strict=True)) for r in document_peaks(spark, sf).collect()}
    assert found == expected
    for row in document_peaks(spark, sf).collect():
        assert row.mz == sorted(row.mz)


def test_reading_documents_moves_nothing_and_keeps_filters_below(spark, tmp_path):
    sf = documents(spark, tmp_path, TEXTS)
    explain = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in explain(document_peaks(spark, sf))
    plan = explain(document_spectra(spark, sf).where(F.col("scan") % 2 == 0))
    assert "md5" not in plan and plan.index("ArrowEvalPython") < plan.index("Filter")


def test_row_order_is_the_stable_one():
    rng = np.random.default_rng(3)
    rows = np.sort(rng.integers(0, 40, 5000))
    for values in (rng.integers(-9, 9, 5000), rng.integers(0, 1 << 60, 5000), np.zeros(5000, np.int64)):
        assert (row_order(rows, values) == np.lexsort((values, rows))).all()
    assert len(row_order(rows[:0], rows[:0])) == 0


def sides(matrix):
    lists = Lists([], [])
    at, bins = np.nonzero(matrix)
    lists.offsets = np.r_[0, np.cumsum(np.bincount(at, minlength=len(matrix)))]
    lists.values = {"bins": bins.astype(np.int64) * 7, "weights": matrix[at, bins]}
    return Side(lists, {})


def test_long_vectors_that_are_almost_alike_are_not_scored():
    """All cosines are near 0.87, as of long texts of one language, but for some copies."""
    rng = np.random.default_rng(4)
    matrix = rng.poisson(np.full((300, 1500), 6.0)).astype(float)
    matrix[150:160] = matrix[:10]
    matrix /= np.sqrt((matrix**2).sum(1))[:, None]
    exact = matrix @ matrix.T
    x, y = np.triu_indices(300, 1)
    assert (exact[x, y] >= 0.8).all()
    side = sides(matrix)
    products = dot_products(side, side)
    kept = products.possible(x, y, 0.9 - 5e-4)
    assert kept[exact[x, y] >= 0.9].all() and kept.sum() < 0.02 * len(x)
    assert np.allclose(products(x[kept], y[kept])["cosine"], exact[x, y][kept])


def test_bounds_hold_for_any_groups():
    rng = np.random.default_rng(5)
    matrix = rng.exponential(1.0, (200, 3000)) * (rng.random((200, 3000)) < 0.4)
    matrix /= np.sqrt((matrix**2).sum(1))[:, None]
    left, right = sides(matrix[:120]), sides(matrix[120:])
    exact = matrix[:120] @ matrix[120:].T
    x, y = np.nonzero(exact >= 0)
    least = np.quantile(exact, 0.7)
    for levels in ((64,), (512, 2048), (16384,)):
        kept = dot_products(left, right).possible(x, y, least - 5e-4, levels)
        assert kept[exact[x, y] >= least].all()


def test_pairs_write_vectors_without_peaks(spark, scratch, tmp_path):
    sf = documents(spark, tmp_path, TEXTS)
    vectors = prepare(document_spectra(spark, sf), PARAMS, scratch, peaks=False)
    assert not {"mz", "intensity"} & set(vectors.columns)
    whole = prepare(document_spectra(spark, sf), PARAMS, scratch)
    assert sorted(whole.drop("mz", "intensity").collect()) == sorted(vectors.collect())
