"""Top-k inner products against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import lakeseries.llm.topk as topk
from lakeseries.llm.topk import top_products

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, "s", "r") for i, v in rows], SCHEMA)


def _brute(rows, k, scale=64, step=5):
    kept = []
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, [math.floor(scale * float(np.float32(c))) for c in v]))
    out = []
    for at, (i, v) in enumerate(kept):
        if i is None or i % step:
            continue
        scores = []
        for other, (j, w) in enumerate(kept):
            if other != at:
                scores.append((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j))
        scores.sort(key=lambda s: s[:3])
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(scores[:k])]
    return sorted(out, key=repr)


def _result(frame, k, step=5):
    found = top_products(frame, F.col("id") % step == 0, k=k)
    assert found.dtypes == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")
    ]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture
def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1 + i % 3, 6).tolist()) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(60)]  # one vector in a third of the rows
    rows += [(5, rows[5][1]), (5, rows[5][1]), (10, [1.0] * 6), (None, [2.0] * 6), (None, [2.0] * 6)]
    rows += [(300, None), (305, [1.0, None]), (310, [float("nan")] * 6), (315, [float("inf")] * 6)]
    rows += [(320, []), (325, [3.0]), (-5, [1.5] * 6), (330, [0.0] * 6)]
    return rows


def test_equals_all_products(spark, odd_rows):
    assert _result(_frame(spark, odd_rows), 7) == _brute(odd_rows, 7)


def test_small_blocks_and_steps(spark, odd_rows, monkeypatch):
    for name, value in {"QUERIES": 7, "HEAD": 3, "STEP": 4, "_PENDING": 10}.items():
        monkeypatch.setattr(topk, name, value)
    assert _result(_frame(spark, odd_rows), 7) == _brute(odd_rows, 7)


def test_fewer_rows_than_k(spark):
    rows = [(i, [float(i), 1.0]) for i in range(4)]
    assert _result(_frame(spark, rows), 20) == _brute(rows, 20)
    assert _result(_frame(spark, rows[:1]), 20) == []


def test_without_rows_or_queries(spark):
    assert _result(_frame(spark, []), 3) == []
    assert _result(_frame(spark, [(1, [1.0]), (2, [1.0])]), 3) == []


def test_large_entries(spark):
    rows = [(i, [float(2**22 + i), float(i - 4)]) for i in range(8)]
    assert _result(_frame(spark, rows), 3) == _brute(rows, 3)
    with pytest.raises(ArithmeticError):
        _result(_frame(spark, [(0, [1e30]), (1, [1.0])]), 3)


def test_bounds_rule_out_pairs():
    """Where few dimensions hold the length, most pairs get no exact product."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 1, (3000, 32)) * (64 * 0.6 ** np.arange(32))).astype(np.int64)
    x = x[np.argsort(-(x**2).sum(1))]
    rotation = topk._Rotation(np.eye(32), [3, 8], np.float64)
    exact = []
    rotation.scores = lambda a, b: (exact.append(len(a)), np.einsum("ij,ij->i", a, b).astype(np.int64))[1]
    names = np.arange(len(x))
    block = (x, names, np.zeros(len(x), bool), np.ones(len(x), np.int64))
    best = topk._search(x[:50], iter([block]), rotation, np.full(50, -np.inf), 5)
    products = x[:50] @ x.T
    want = [sorted(zip(-row, names))[:5] for row in products]
    got = [list(zip(-best._kept[1][i * 5 : i * 5 + 5], best._kept[2][i * 5 : i * 5 + 5])) for i in range(50)]
    assert got == want
