"""Merged states against plain loops over the observations."""

import datetime as dt
import random

import pytest

from lakeseries.operators.rollup import CUBE, LEVELS, grouped, merge_states, month_states

SCHEMA = "serie_codigo int, serie_nome string, data date, valor double"


def _rows(seed, n=500):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        code = rng.choice([1, 1, 1, 2, 3, None])
        day = None if rng.random() < 0.05 else dt.date(2019, 11, 1) + dt.timedelta(rng.randrange(500))
        rows.append((code, f"s{code}", day, None if rng.random() < 0.1 else float(rng.randrange(50))))
    return rows


def _plain(rows, levels):
    keys = [k for k in LEVELS["mes"] if any(k in of for of in levels.values())]
    groups = {}
    for code, name, day, value in rows:
        if day is None or value is None:
            continue
        of = {"serie_codigo": code, "serie_nome": name, "ano": day.year,
              "trimestre": (day.month + 2) // 3, "mes": day.month}
        for level, wanted in levels.items():
            key = (level, *[of[k] if k in wanted else None for k in keys])
            groups.setdefault(key, []).append((day, value))
    out = []
    for key, points in groups.items():
        values = [v for _, v in points]
        out.append((*key, sum(values), len(values), sum(values) / len(values), min(values), max(values),
                    *min(points), *max(points), len({d for d, _ in points})))
    return sorted(out, key=repr)


def _found(table):
    return sorted((tuple(r) for r in table.collect()), key=repr)


@pytest.mark.parametrize("levels", [LEVELS, CUBE, {"mes": ("ano", "mes")}])
def test_levels(spark, levels):
    rows = _rows(1)
    states = month_states(spark.createDataFrame(rows, SCHEMA))
    assert _found(grouped(states, levels)) == _plain(rows, levels)


def test_parts_merge_to_the_whole(spark):
    parts = [_rows(seed) for seed in (2, 3, 4)]
    states = None
    for part in parts:
        new = month_states(spark.createDataFrame(part, SCHEMA))
        states = new if states is None else merge_states(states.unionByName(new))
    whole = [r for part in parts for r in part]
    assert _found(grouped(states)) == _plain(whole, LEVELS)
    at_once = month_states(spark.createDataFrame(whole, SCHEMA))
    assert _found(states) == _found(at_once)


def test_states_that_are_not_merged_yet(spark):
    parts = [_rows(seed) for seed in (5, 6)]
    both = [month_states(spark.createDataFrame(p, SCHEMA)) for p in parts]
    assert _found(grouped(both[0].unionByName(both[1]), CUBE)) == _plain(parts[0] + parts[1], CUBE)


def test_empty_tables_and_equal_levels(spark):
    states = month_states(spark.createDataFrame([(1, "a", None, 1.0)], SCHEMA))
    assert grouped(states).count() == 0
    with pytest.raises(ValueError):
        grouped(states, {"a": ("ano",), "b": ("ano",)})


def test_observations_fold_before_the_shuffle(spark):
    rows = spark.range(10_000).selectExpr(
        "1 as serie_codigo", "'a' as serie_nome", "date_add(date'2020-01-01', cast(id % 60 as int)) as data",
        "cast(id as double) as valor",
    )
    plan = grouped(month_states(rows))._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "Window" not in plan and "collect_" not in plan
