"""Runs, gaps and calendars against plain loops, with series cut in several pieces."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeseries.operators.gaps import month_spine, series_gaps, series_runs
from lakeseries.operators.ordered import PIECE, in_pieces

DAY = dt.date(2020, 1, 1)
SCHEMA = "serie_codigo int, data date, valor double"


@pytest.fixture(autouse=True)
def many_pieces(spark):
    """Small tables lie in four pieces too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _rows(seed, n=300, span=500):
    rng = random.Random(seed)
    return [
        (rng.choice([1, 1, 1, 1, 2, 3, None]),
         None if rng.random() < 0.05 else DAY + dt.timedelta(rng.randrange(span)),
         None if rng.random() < 0.1 else float(rng.randrange(9)))
        for _ in range(n)
    ]


def _by_key(rows):
    series = {}
    for code, day, value in rows:
        if day is not None:
            series.setdefault(code, {}).setdefault(day, []).append(value or 0.0)
    return series


def _plain_runs(rows, pause):
    out = []
    for code, days in _by_key(rows).items():
        runs = []
        for day in sorted(days):
            if not runs or (day - runs[-1][-1]).days > pause:
                runs.append([])
            runs[-1].append(day)
        for i, run in enumerate(runs):
            values = [v for d in run for v in days[d]]
            before = runs[i - 1][-1] if i else None
            out.append((code, run[0], run[-1], len(run), len(values), sum(values), before))
    return out


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("pause", [1, 2, 5, 30, 1000])
def test_runs(spark, pause):
    rows = _rows(pause)
    found = series_runs(spark.createDataFrame(rows, SCHEMA), pause_days=pause).select(
        "serie_codigo", "inicio", "fim", "dias", "linhas", "soma", "fim_anterior"
    )
    assert _sorted(found.collect()) == _sorted(_plain_runs(rows, pause))


def test_a_run_over_several_pieces_is_one(spark):
    days = [(1, DAY + dt.timedelta(i), 1.0) for i in range(400)]
    rows = spark.createDataFrame(days, SCHEMA)
    pieces = in_pieces(rows, ["serie_codigo"], ["data"]).groupBy(PIECE).count().collect()
    assert len(pieces) >= 3 and max(r["count"] for r in pieces) < 300
    (run,) = series_runs(rows).collect()
    assert (run.inicio, run.fim, run.dias, run.fim_anterior) == (DAY, days[-1][1], 400, None)


def test_gaps(spark):
    rows = _rows(7)
    want = []
    for code, begin, *_, before in _plain_runs(rows, 1):
        if before:
            one = dt.timedelta(1)
            want.append((code, before + one, begin - one, (begin - before).days - 1))
    found = series_gaps(spark.createDataFrame(rows, SCHEMA))
    assert _sorted(found.collect()) == _sorted(want)


def test_month_spine(spark):
    rows = _rows(8, 40, 2000)
    want = []
    for code, days in _by_key(rows).items():
        months = {}
        for day in days:
            months.setdefault(day.year * 12 + day.month - 1, []).extend(
                v for c, d, v in rows if c == code and d == day
            )
        last = None
        for m in range(min(months), max(months) + 1):
            known = [v for v in months.get(m, []) if v is not None]
            lacking = m - last - 1 if m in months and last is not None else 0
            last = m if m in months else last
            want.append((code, dt.date(m // 12, m % 12 + 1, 1), len(months.get(m, [])),
                         sum(known) if known else None, lacking))
    found = month_spine(spark.createDataFrame(rows, SCHEMA))
    assert _sorted(found.collect()) == _sorted(want)


def test_empty_tables(spark):
    rows = spark.createDataFrame([(1, None, 1.0)], SCHEMA)
    assert series_runs(rows).count() == series_gaps(rows).count() == month_spine(rows).count() == 0


def test_windows_lie_inside_pieces(spark):
    rows = spark.range(1000).select(
        F.lit(1).alias("serie_codigo"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("data"),
        F.lit(1.0).alias("valor"),
    )
    plan = series_runs(rows)._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        if " Window [" in line and "_dia" in line:
            assert PIECE in line
