import datetime as dt
import random

from lakeseries.operators.gold import comparison, monthly

# The rows of the ported cases.
SILVER = [
    (11, "selic_diaria", dt.date(2024, 1, 1), 11.75),
    (11, "selic_diaria", dt.date(2024, 1, 15), 11.75),
    (11, "selic_diaria", dt.date(2024, 2, 1), 11.25),
    (433, "ipca_mensal", dt.date(2024, 1, 1), 0.42),
    (433, "ipca_mensal", dt.date(2024, 2, 1), 0.83),
]
COLUMNS = "serie_codigo int, serie_nome string, data date, valor double"


def silver(spark, rows=SILVER):
    return spark.createDataFrame(rows, COLUMNS)


def months(frame):
    return {(r.serie_codigo, r.ano, r.mes): r for r in frame.collect()}


def test_mean_and_count(spark):
    row = months(monthly(silver(spark)))[11, 2024, 1]
    assert (row.valor_medio, row.qtd_observacoes) == (11.75, 2)


def test_change_and_first_month(spark):
    table = months(monthly(silver(spark)))
    assert table[11, 2024, 2].variacao_percentual_mensal == -4.26
    assert table[11, 2024, 1].variacao_percentual_mensal is None


def test_schema_and_order(spark):
    table = monthly(silver(spark))
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [
        ("serie_codigo", "int"),
        ("serie_nome", "string"),
        ("ano", "int"),
        ("mes", "int"),
        ("valor_medio", "double"),
        ("valor_min", "double"),
        ("valor_max", "double"),
        ("qtd_observacoes", "bigint"),
        ("variacao_percentual_mensal", "double"),
    ]
    keys = [(r.serie_codigo, r.ano, r.mes) for r in table.collect()]
    assert keys == sorted(keys)


def test_gap_month_uses_previous_existing_month(spark):
    rows = [
        (1, "a", dt.date(2023, 11, 1), 10.0),
        (1, "a", dt.date(2024, 2, 1), 15.0),
    ]
    table = months(monthly(silver(spark, rows)))
    assert table[1, 2024, 2].variacao_percentual_mensal == 50.0


def test_zero_before_gives_no_change_and_sign_follows_previous(spark):
    rows = [
        (1, "a", dt.date(2024, 1, 1), 0.0),
        (1, "a", dt.date(2024, 2, 1), -0.01),
        (1, "a", dt.date(2024, 3, 1), 0.22),
    ]
    table = months(monthly(silver(spark, rows)))
    assert table[1, 2024, 2].variacao_percentual_mensal is None
    assert table[1, 2024, 3].variacao_percentual_mensal == -2300.0


def test_renamed_series_keeps_its_history(spark):
    rows = [
        (1, "old", dt.date(2024, 1, 1), 10.0),
        (1, "new", dt.date(2024, 2, 1), 11.0),
    ]
    table = months(monthly(silver(spark, rows)))
    assert table[1, 2024, 2].variacao_percentual_mensal == 10.0


def test_pivot(spark):
    wide = comparison(monthly(silver(spark)))
    assert wide.columns == ["ano", "mes", "ipca_mensal", "selic_diaria"]
    first = wide.first()
    assert (first.ano, first.mes, first.selic_diaria, first.ipca_mensal) == (2024, 1, 11.75, 0.42)


def test_pivot_missing_cell_and_given_names(spark):
    rows = [*SILVER, (9, "so_marco", dt.date(2024, 3, 1), 1.0)]
    table = monthly(silver(spark, rows), ordered=False)
    discovered = comparison(table)
    given = comparison(table, ["selic_diaria", "so_marco", "ipca_mensal"])
    assert discovered.columns == given.columns
    assert discovered.collect() == given.collect()
    march = discovered.filter("mes = 3").first()
    assert (march.selic_diaria, march.so_marco) == (None, 1.0)


def test_pivot_of_shared_name_takes_smaller_code(spark):
    rows = [
        (2, "x", dt.date(2024, 1, 1), 20.0),
        (1, "x", dt.date(2024, 1, 1), 10.0),
    ]
    assert comparison(monthly(silver(spark, rows))).first().x == 10.0


def test_no_sort_below_the_pivot(spark):
    table = monthly(silver(spark), ordered=False)
    plan = comparison(table, ["a"], ordered=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan.replace("SortOrder", "")


def test_random_series_against_brute_force(spark):
    rng = random.Random(11)
    rows = [
        (code, f"s{code}", dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 900)), float(rng.randint(-3, 3)))
        for code in range(6)
        for _ in range(60)
    ]
    groups = {}
    for code, _, date, value in rows:
        groups.setdefault((code, date.year, date.month), []).append(value)
    expected, previous = {}, {}
    for key in sorted(groups):
        values = groups[key]
        mean, before = sum(values) / len(values), previous.get(key[0])
        change = (mean - before) / before * 100 if before else None
        expected[key] = (mean, min(values), max(values), len(values), change)
        previous[key[0]] = mean
    got = months(monthly(silver(spark, rows)))
    assert got.keys() == expected.keys()
    for key, (mean, low, high, count, change) in expected.items():
        row = got[key]
        assert (row.valor_medio, row.valor_min, row.valor_max, row.qtd_observacoes) == (mean, low, high, count)
        if change is None:
            assert row.variacao_percentual_mensal is None
        else:
            assert abs(row.variacao_percentual_mensal - change) <= 0.00501

    wide = comparison(monthly(silver(spark, rows), ordered=False))
    assert wide.columns == ["ano", "mes", *[f"s{c}" for c in range(6)]]
    for row in wide.collect():
        for code in range(6):
            cell = expected.get((code, row.ano, row.mes))
            assert row[f"s{code}"] == (cell[0] if cell else None)
