import math
import random

import pytest
from pyspark.sql import functions as F

from peakloom.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, score string, Rank int"


def asked():
    return F.col("vec_id") % 100 == 0


def _usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def _plain(rows, k):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if _usable(v)]
    out = []
    for q, (name, mine) in enumerate(kept):
        if name is None or name % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(mine, v)), i is None, i or 0, i) for c, (i, v) in enumerate(kept) if c != q]
        out += [(name, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, "own", 7) for i, v in rows], SCHEMA)


def test_odd_rows(spark, scratch):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 0.125]),
        (0, [0.5, -0.25, 0.125]),  # a repeated query finds its twin
        (100, [0.5, 0.5, None]),
        (100, [nan, 0.5, 1.0]),
        (200, None),
        (300, [inf, 1.0, 1.0]),
        (400, []),
        (500, [1.0]),  # shorter than the others
        (600, [-1.0] * 20),
        (None, [0.5, -0.25, 0.125]),
        (None, [3.0, 3.0, 3.0]),
        *[(i, [0.5, -0.25, 0.125]) for i in range(1, 15)],  # ties
        *[(i, [-0.0001 * i, 0.3, 1e-9]) for i in range(20, 40)],
    ]
    for k in (1, 3, 10, 1000):
        assert _got(topk.search(_frame(spark, rows), asked(), k, scratch=scratch)) == _plain(rows, k)
    assert _got(topk.search(_frame(spark, []), asked(), scratch=scratch)) == []
    assert _got(topk.search(_frame(spark, [(1, [1.0])]), asked(), scratch=scratch)) == []
    assert _got(topk.search(_frame(spark, [(0, [1.0])]), asked(), scratch=scratch)) == []


def test_numbers_beyond_doubles(spark, scratch):
    rows = [(100 * i, [3e5 * (i + 1) + 0.5, -2e5 * i, 1e5]) for i in range(6)] + [(7, [-1e6, 1e-3, 4e4])]
    schema = "vec_id bigint, embedding array<double>"
    got = _got(topk.search(spark.createDataFrame(rows, schema), asked(), 4, scratch=scratch))
    assert got == _plain(rows, 4) and max(abs(r[3]) for r in got) > 1 << 53
    for far in (1e30, 1e15):
        with pytest.raises(Exception, match="does not fit a long"):
            topk.search(spark.createDataFrame([(0, [far]), (1, [far])], schema), asked(), scratch=scratch).collect()


def test_bounds_leave_out_nothing(spark, scratch, monkeypatch):
    """Several blocks, parts and groups; most candidates of a few clusters, many ties on small whole numbers."""
    monkeypatch.setattr(topk, "PART_QUERIES", 5)
    draw = random.Random(3)
    centres = [[draw.gauss(0, 1) for _ in range(40)] for _ in range(5)]
    rows = []
    for i in range(6000):
        c = centres[min(int(draw.expovariate(1)), 4)]
        size = 8 if i % 2 else 0.02
        rows.append((draw.randrange(0, 20_000), [round(size * (x + draw.gauss(0, 0.1))) / 256 for x in c]))
    df = _frame(spark, rows).repartition(3)
    assert _got(topk.search(df, asked(), 10, scratch=scratch)) == _plain(rows, 10)


def test_candidates_are_left_out_by_the_bound(monkeypatch):
    """The method itself: with a floor known, later runs of dimensions see few candidates."""
    import numpy as np

    draw = np.random.default_rng(1)
    rows = (draw.standard_normal((2048, 64)) * np.linspace(8, 0.1, 64)).round().astype(np.int64) * 10
    packed = {
        "source": 0, "sequence": 0, "ids": np.arange(2048).tobytes(), "missing": np.zeros(2048, bool).tobytes(), "width": 8,
        "runs": [np.ascontiguousarray(rows[:, i : i + 8].T).tobytes() for i in range(0, 64, 8)],
    }
    asked = {
        "source": 1, "sequence": 0, "asked_width": 64, "asked_at": np.arange(40, dtype=np.int32).tobytes(),
        "ids": np.arange(2048).tobytes(), "asked_values": rows[:40].tobytes(),
    }
    queries = topk._Queries([asked], 10)
    queries.see(topk._Block(packed))
    survivors = []
    see = topk._Queries._see_pairs
    monkeypatch.setattr(topk._Queries, "_see_pairs", lambda self, *a: survivors.append(len(a[5])) or see(self, *a))
    queries.see(topk._Block({**packed, "sequence": 1}))
    assert survivors and max(survivors) < 0.2 * 40 * 2048
    exact = rows[:40] @ rows.T
    for q in range(40):
        assert queries.best[q][0].tolist() == sorted([*exact[q], *exact[q]], reverse=True)[:10]
