"""Joins on validity periods against all pairs."""

import datetime as dt
import random

import pytest

from lakeseries.operators.periods import overlaps, period_join, range_by_period

DAY = dt.date(2020, 1, 1)
ROWS = "serie_codigo int, data date, valor double"
LIMITS = "serie_codigo int, valido_de date, valido_ate date, minimo double, maximo double"


def _day(rng, span=900):
    return DAY + dt.timedelta(rng.randrange(-span, span))


def _rows(seed, n=200):
    rng = random.Random(seed)
    return [
        (rng.choice([1, 1, 1, 2, 3, None]), None if rng.random() < 0.05 else _day(rng),
         rng.choice([None, float("nan"), *map(float, range(20))]))
        for _ in range(n)
    ]


def _limits(seed, n=25):
    """Open at either end or both, overlapping, repeated, and some that end before they begin."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        begin = None if rng.random() < 0.2 else _day(rng)
        end = None if rng.random() < 0.2 else (begin or _day(rng)) + dt.timedelta(rng.randrange(-30, 400))
        out.append((rng.choice([1, 2, 4, None]), begin, end, 3.0, float(rng.randrange(5, 15))))
    return [*out, out[0], (2, None, None, 5.0, 6.0)]


def _holds(begin, end, day):
    return (begin is None or begin <= day) and (end is None or day <= end)


def _sorted(rows):
    """As texts: NaN is not equal to itself."""
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("bin_days", [1, 92, 5000])
def test_period_join(spark, how, bin_days):
    rows, limits = _rows(1), _limits(2)
    want = []
    for code, day, value in rows:
        met = [p for p in limits if None not in (code, day) and p[0] == code and _holds(p[1], p[2], day)]
        want += [(code, day, value, *p[1:]) for p in met]
        if not met and how == "left":
            want.append((code, day, value, None, None, None, None))
    found = period_join(
        spark.createDataFrame(rows, ROWS), spark.createDataFrame(limits, LIMITS), how=how, bin_days=bin_days
    )
    assert _sorted(found.collect()) == _sorted(want)


@pytest.mark.parametrize("bin_days", [1, 30, 5000])
def test_overlaps_once_each(spark, bin_days):
    schema = "serie_codigo int, de date, ate date, um int"
    other = "serie_codigo int, valido_de date, valido_ate date, dois int"
    left = [(*p[:3], i) for i, p in enumerate(_limits(3, 40))]
    right = [(*p[:3], i) for i, p in enumerate(_limits(4, 40))]
    low, high = dt.date.min, dt.date.max
    want = []
    for c, a, b, i in left:
        for d, e, f, j in right:
            a_, b_, e_, f_ = a or low, b or high, e or low, f or high
            if c is not None and c == d and a_ <= b_ and e_ <= f_ and a_ <= f_ and e_ <= b_:
                want.append((c, i, j))
    found = overlaps(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, other), bin_days=bin_days
    ).select("serie_codigo", "um", "dois")
    assert _sorted(found.collect()) == _sorted(want)


def test_overlap_of_periods_that_are_all_open(spark):
    left = spark.createDataFrame([(1, None, None)], "serie_codigo int, de date, ate date")
    right = spark.createDataFrame([(1, None, None)], "serie_codigo int, valido_de date, valido_ate date")
    assert overlaps(left, right).count() == 1


def test_range_by_period(spark):
    rows, limits = _rows(5), _limits(6)
    want = {}
    for code, day, value in rows:
        met = [p for p in limits if None not in (code, day) and p[0] == code and _holds(p[1], p[2], day)]
        count = want.setdefault(code, [0, 0, 0])
        for low, high in [(p[3], p[4]) for p in met] or [(0.0, 10.0)]:
            known = value is not None and value == value
            count[0] += 1
            count[1] += not met
            count[2] += known and not low <= value <= high
    found = range_by_period(
        spark.createDataFrame(rows, ROWS), spark.createDataFrame(limits, LIMITS), default=(0, 10)
    )
    assert _sorted(found.collect()) == _sorted((c, *n) for c, n in want.items())


def test_empty_sides_and_clashing_names(spark):
    rows, limits = spark.createDataFrame(_rows(7), ROWS), spark.createDataFrame(_limits(8), LIMITS)
    assert period_join(rows, limits.limit(0)).count() == rows.count()
    assert period_join(rows.limit(0), limits).count() == 0
    assert overlaps(
        limits.limit(0).toDF("serie_codigo", "de", "ate", "a", "b"), limits
    ).count() == 0
    with pytest.raises(ValueError, match="valor"):
        period_join(rows, limits.withColumnRenamed("minimo", "Valor"))
    with pytest.raises(ValueError, match="left or inner"):
        period_join(rows, limits, how="full")


def test_long_series_are_dealt_by_bins(spark):
    rows, limits = spark.createDataFrame(_rows(9), ROWS), spark.createDataFrame(_limits(10), LIMITS)
    plan = period_join(rows, limits)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "_bin" in plan.split("Join", 1)[1].split("\n", 1)[0]
