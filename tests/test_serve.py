import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeseries.functions import display_label, two_decimals
from lakeseries.operators import serve

MONTHS = "serie_codigo int, serie_nome string, ano int, mes int, valor_medio double, valor_min double, valor_max double, qtd_observacoes long, variacao_percentual_mensal double"
ROWS = [
    (1, "b_x", 2023, 12, 1.0, 1.0, 1.0, 1, None),
    (1, "b_x", 2024, 1, 2.0, 1.5, 2.5, 2, 100.0),
    (2, "a", 2024, 1, 3.0, 3.0, 3.0, 1, None),
    (2, "a", 2024, 2, 2.0, 2.0, 2.0, 1, -33.33),
]


@pytest.fixture
def view(spark):
    return serve.with_period(spark.createDataFrame(ROWS, MONTHS))


def keys(frame):
    return [(r.serie_nome, r.periodo) for r in frame.collect()]


def test_monthly_view_order(spark):
    view = serve.monthly_view(spark.createDataFrame(ROWS, MONTHS))
    assert keys(view) == [
        ("a", dt.date(2024, 1, 1)),
        ("a", dt.date(2024, 2, 1)),
        ("b_x", dt.date(2023, 12, 1)),
        ("b_x", dt.date(2024, 1, 1)),
    ]


def test_options_and_bounds(view):
    assert [r.serie_nome for r in serve.series_options(view).collect()] == ["a", "b_x"]
    assert serve.period_bounds(view).first() == (dt.date(2023, 12, 1), dt.date(2024, 2, 1))


def test_filter_is_closed_and_optional(view):
    start, end = dt.date(2023, 12, 1), dt.date(2024, 1, 1)
    assert serve.filter_period(view).count() == 4
    assert serve.filter_period(view, start=start, end=end).count() == 3
    assert serve.filter_period(view, ["a"], start, end).count() == 1
    assert serve.filter_period(view, []).count() == 0


def test_year_bound_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, MONTHS).write.parquet(f"{tmp_path}/m")
    view = serve.with_period(spark.read.parquet(f"{tmp_path}/m"))
    frame = serve.filter_period(view, ["a"], dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(ano,2024)" in pushed and "serie_nome" in pushed


def test_latest_and_cards(view):
    latest = serve.latest_per_series(view)
    assert latest.columns == view.columns
    assert sorted(keys(latest)) == [("a", dt.date(2024, 2, 1)), ("b_x", dt.date(2024, 1, 1))]
    early = serve.filter_period(view, end=dt.date(2023, 12, 31))
    cards = {r.serie_nome: r for r in serve.kpi_cards(serve.latest_per_series(view)).collect()}
    assert (cards["b_x"].rotulo, cards["b_x"].valor, cards["b_x"].variacao) == ("B X", "2.00", "100.00%")
    assert cards["a"].variacao == "-33.33%"
    # A series without rows in the interval has no card; no change, no text.
    (card,) = serve.kpi_cards(serve.latest_per_series(early)).collect()
    assert (card.serie_nome, card.variacao) == ("b_x", None)


@pytest.mark.parametrize(
    "text", ["selic_diaria", "taxa_media_juros_credito", "4-NOT SPECIFIED", "ipca15_mensal", "inflação_é", ""]
)
def test_label_is_title_case(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(display_label(F.col("t")).alias("l")).first()
    assert row.l == text.replace("_", " ").title()


def test_number_text_rounds_like_printf(spark):
    values = [0.125, 0.375, 1.005, 2.675, -0.001, 1234567.891, -4.26, 0.0, 1e15]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    texts = [r.t for r in frame.select(two_decimals(F.col("v")).alias("t")).collect()]
    assert texts == [f"{v:.2f}" for v in values]


def test_points_and_details(view):
    assert serve.series_points(view).columns == ["periodo", "valor_medio", "serie_nome"]
    assert serve.detail_table(view).columns == serve.DETAIL_COLUMNS
    assert keys(serve.detail_table(view))[0] == ("a", dt.date(2024, 1, 1))


def test_wide_queries(spark):
    wide = spark.createDataFrame(
        [(2024, 2, None, 2.0), (2024, 1, 1.0, 3.0)], "ano int, mes int, `a.b` double, c double"
    )
    view = serve.comparison_view(wide)
    assert [r.periodo.month for r in view.collect()] == [1, 2]
    inside = serve.comparison_period(view, dt.date(2024, 2, 1), dt.date(2024, 2, 1))
    assert inside.count() == 1
    january, february = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert sorted(serve.comparison_long(view).collect(), key=repr) == sorted(
        [(january, "a.b", 1.0), (january, "c", 3.0), (february, "a.b", None), (february, "c", 2.0)],
        key=repr,
    )
    assert serve.comparison_long(view, ["c", "gone"]).count() == 2
    empty = serve.comparison_long(view, ["gone"])
    assert empty.columns == ["periodo", "variable", "value"] and empty.count() == 0
