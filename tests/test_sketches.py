"""Sketches against exact quantiles and counts."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lakeseries.operators.sketches import (
    distinct_estimates,
    distinct_sketch,
    merged_sketch,
    quantile_sketch,
    quantiles,
)

DAY = dt.date(2020, 1, 1)
SCHEMA = "serie_codigo int, data date, valor double"
SHARES = [0, 0.01, 0.25, 0.5, 0.75, 0.99, 1]


def _rows(seed, n=2000):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), float("-inf")]
    return [
        (rng.choice([1, 1, 1, 2, None]),
         None if rng.random() < 0.02 else DAY + dt.timedelta(rng.randrange(400)),
         rng.choice([rng.choice(odd), 0.0, 7.0, rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 9)]))
        for _ in range(n)
    ]


def _known(rows, code):
    return sorted(
        v for c, d, v in rows if c == code and d and v is not None and math.isfinite(v)
    )


@pytest.mark.parametrize("error", [0.01, 0.2])
def test_quantiles_within_the_error(spark, error):
    rows = _rows(1)
    sketch = quantile_sketch(spark.createDataFrame(rows, SCHEMA), error=error)
    found = quantiles(sketch, SHARES, ["serie_codigo"], error).collect()
    assert len(found) == 3 * len(SHARES)
    for r in found:
        values = _known(rows, r.serie_codigo)
        place = math.floor(r.q * (len(values) - 1))
        assert (r.quantidade, r.posicao) == (len(values), place + 1)
        assert abs(r.valor - values[place]) <= error * abs(values[place]) * (1 + 1e-9)


def test_parts_merge_to_the_whole(spark):
    parts = [_rows(seed, 500) for seed in (2, 3, 4)]
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    union = quantile_sketch(spark.createDataFrame(parts[0], SCHEMA))
    for part in parts[1:]:
        union = union.unionByName(quantile_sketch(spark.createDataFrame(part, SCHEMA)))
    keys = ["serie_codigo", "ano", "mes"]
    at_once = sorted(map(repr, quantile_sketch(whole).collect()))
    columns = [*keys, "sinal", "faixa", "quantidade"]
    assert sorted(map(repr, merged_sketch(union, keys).select(*columns).collect())) == at_once
    everything = quantiles(union, [0.5]).collect()
    assert len(everything) == 1
    assert everything[0].quantidade == sum(len(_known([r for p in parts for r in p], c)) for c in (1, 2, None))


def test_distinct_within_the_error(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 3).cast("int").alias("serie_codigo"),
        F.expr("date_add(date'2020-01-01', cast(id % 700 as int))").alias("data"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 9_000).alias("item"),
    )
    sketch = distinct_sketch(rows, "item")
    merged = {r.serie_codigo: r.estimativa for r in distinct_estimates(sketch, ["serie_codigo"]).collect()}
    exact = {r.serie_codigo: r.n for r in rows.groupBy("serie_codigo").agg(
        F.countDistinct("item").alias("n")).collect()}
    assert merged.keys() == exact.keys()
    for code, n in exact.items():
        assert abs(merged[code] - n) <= 4 * 1.04 / 128 * n
    total = rows.select(F.countDistinct("item")).first()[0]
    (all_of,) = distinct_estimates(sketch).collect()
    assert abs(all_of.estimativa - total) <= 4 * 1.04 / 128 * total


def test_empty_tables_and_bad_arguments(spark):
    rows = spark.createDataFrame([(1, None, 1.0), (1, DAY, None)], SCHEMA)
    sketch = quantile_sketch(rows)
    assert sketch.count() == quantiles(sketch, [0.5], ["serie_codigo"]).count() == 0
    assert distinct_estimates(distinct_sketch(rows.limit(0), "valor"), ["serie_codigo"]).count() == 0
    for bad in ([], [1.5]):
        with pytest.raises(ValueError):
            quantiles(sketch, bad)
    with pytest.raises(ValueError):
        quantile_sketch(rows, error=1)


def test_values_fold_before_the_shuffle(spark):
    rows = spark.createDataFrame(_rows(5, 50), SCHEMA)
    sketch = quantile_sketch(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in sketch and "collect_" not in sketch
    distinct = distinct_sketch(rows, "valor")
    assert "partial_hll_sketch_agg" in distinct.drop("x")._jdf.queryExecution().executedPlan().toString()
