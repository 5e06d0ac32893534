"""Whitening against a plain computation over the distinct vectors."""

import math

import numpy as np
import pytest

from lakeseries.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, n string, x string, whitened string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, "n", "x", "w") for i, v in rows], SCHEMA)


def _brute(rows, components=4, counts=False, scale=256):
    d = max((len(v) for _, v in rows if v is not None), default=0)
    kept = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(scale * float(np.float32(c))) for c in v]
            kept.append((i, tuple(x + [0] * (d - len(x)))))
    fit = [x for _, x in kept] if counts else sorted({x for _, x in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(total) / n
    variances = centred.T @ centred / n
    values, axes = np.linalg.eigh(variances)
    order = np.argsort(-values)[:components]
    out = {}
    for i, x in kept:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, total))
        white = (np.array(x) - np.array(total) / n) @ axes[:, order] / np.sqrt(values[order])
        out.setdefault(i, []).append((n, deviation, white))
    return out, values[order] / np.trace(variances)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_equals_plain_computation(spark, weights):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(0, 1, 6) * [3, 2, 1, 0.7, 0.3, 0.2]).tolist()) for i in range(200)]
    rows += [(300 + i, [0.25] * 6) for i in range(100)]  # one vector in a third of the rows
    rows += [(7, [1.0] * 6), (None, [2.0] * 6), (400, None), (401, [None] * 6)]
    rows += [(402, [float("nan")] * 6), (403, [float("-inf")] * 6), (404, [1.5]), (405, [-0.0] * 6)]
    want, shares = _brute(rows, counts=weights == "count")
    found = whiten(_frame(spark, rows), weights=weights)
    assert found.columns == COLUMNS
    got = {}
    for r in found.collect():
        assert r.identity_error < 1e-9
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        got.setdefault((r.vec_id, r.deviation), {})[r.component] = (r.n, r.whitened)
    for vec_id, wanted in want.items():
        for n, deviation, white in wanted:
            values = got[vec_id, deviation]
            assert {v[0] for v in values.values()} == {n}
            assert [abs(values[c][1]) for c in range(1, 5)] == pytest.approx(np.abs(white), abs=1e-9)
    assert found.count() == 4 * sum(len(w) for w in want.values())
    # Signs are the same for all rows: whitened values have no correlation left.
    rows_of = {}
    for r in found.collect():
        rows_of.setdefault(r.deviation, {})[r.component] = r.whitened
    if weights == "one":
        white = np.array([[v[c] for c in range(1, 5)] for v in rows_of.values()])
        assert white.T @ white / len(white) == pytest.approx(np.eye(4), abs=1e-6)


def test_components_without_variance(spark):
    found = whiten(_frame(spark, [(1, [1.0, 0.0]), (2, [3.0, 0.0])])).collect()
    assert sorted((r.vec_id, r.component, r.whitened is None) for r in found) == [
        (1, 1, False), (1, 2, True), (2, 1, False), (2, 2, True)
    ]
    assert {r.identity_error for r in found} == {0.0}
    (same, *_) = whiten(_frame(spark, [(1, [1.0]), (2, [1.0])])).collect()
    assert (same.n, same.deviation, same.whitened, same.explained, same.identity_error) == (
        1, 0, None, None, None
    )


def test_without_rows(spark):
    found = whiten(_frame(spark, [(1, None), (2, [float("nan")])]))
    assert found.columns == COLUMNS and found.count() == 0
    assert whiten(_frame(spark, [])).dtypes == whiten(_frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0])])).dtypes


def test_large_entries(spark):
    rows = [(i, [float(2.0**40 + 2.0**20 * i * i), float(i)]) for i in range(5)]
    want, _ = _brute(rows, 2)
    for r in whiten(_frame(spark, rows)).collect():
        deviation = want[r.vec_id][0][1]
        assert r.deviation == (deviation if deviation < 2**63 else None)
