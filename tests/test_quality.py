import datetime as dt

import pytest

from lakeseries.operators.quality import (
    BETWEEN,
    NOT_NULL,
    UNIQUE,
    DataQualityError,
    quality_report,
    range_violations,
    require_quality,
)

DAY = dt.date(2024, 1, 1)
COLUMNS = "serie_codigo int, serie_nome string, data date, valor double"


def silver(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def failures(frame, **options):
    return [tuple(r) for r in quality_report(frame, **options).collect()]


def test_clean_data_passes(spark):
    frame = silver(
        spark,
        (11, "selic_diaria", DAY, 11.75),
        (11, "selic_diaria", dt.date(2024, 1, 2), 11.75),
        (433, "ipca_mensal", DAY, 0.42),
    )
    assert failures(frame) == []


def test_out_of_range(spark):
    frame = silver(spark, (11, "selic_diaria", DAY, 350.0))
    assert failures(frame) == [(BETWEEN, "selic_diaria", 1)]


def test_range_belongs_to_its_series(spark):
    frame = silver(spark, (433, "ipca_mensal", DAY, 0.42), (11, "selic_diaria", DAY, 11.75))
    assert failures(frame) == []


def test_bounds_are_inclusive(spark):
    frame = silver(
        spark,
        (433, "ipca_mensal", DAY, -5.0),
        (433, "ipca_mensal", dt.date(2024, 1, 2), 5.0),
        (433, "ipca_mensal", dt.date(2024, 1, 3), 5.01),
    )
    assert failures(frame) == [(BETWEEN, "ipca_mensal", 1)]


def test_duplicates_count_every_row(spark):
    frame = silver(
        spark, (11, "selic_diaria", DAY, 11.75), (11, "selic_diaria", DAY, 11.90)
    )
    assert failures(frame) == [(UNIQUE, "global", 2)]


def test_unknown_series_has_the_wide_default(spark):
    assert failures(silver(spark, (9999, "serie_nao_mapeada", DAY, 42_000.0))) == []
    assert failures(silver(spark, (9999, "x", DAY, 1_000_001.0))) == [(BETWEEN, "x", 1)]


def test_null_and_nan_are_missing_but_not_out_of_range(spark):
    frame = silver(
        spark,
        (1, "selic_diaria", DAY, None),
        (2, "selic_diaria", DAY, float("nan")),
        (3, "selic_diaria", None, float("inf")),
    )
    assert failures(frame) == [
        (NOT_NULL, "global", 1),
        (NOT_NULL, "global", 2),
        (BETWEEN, "selic_diaria", 1),
    ]


def test_null_name_escapes_the_range_and_null_keys_the_uniqueness(spark):
    frame = silver(
        spark, (1, None, DAY, 9e9), (None, "a", None, 1.0), (None, "b", None, 1.0)
    )
    assert failures(frame) == [(NOT_NULL, "global", 2)]
    # A half-null key takes part.
    frame = silver(spark, (7, "a", None, 1.0), (7, "b", None, 1.0))
    assert (UNIQUE, "global", 2) in failures(frame)


def test_report_order(spark):
    frame = silver(
        spark,
        (11, "selic_diaria", DAY, 350.0),
        (11, "selic_diaria", DAY, None),
        (433, "ipca_mensal", None, 99.0),
    )
    assert failures(frame) == [
        (NOT_NULL, "global", 1),
        (NOT_NULL, "global", 1),
        (UNIQUE, "global", 2),
        (BETWEEN, "ipca_mensal", 1),
        (BETWEEN, "selic_diaria", 1),
    ]


def test_empty_input_passes(spark, tmp_path):
    require_quality(silver(spark), str(tmp_path / "report"))


def test_gate_raises_with_count_and_stored_report(spark, tmp_path):
    rows = [(i, f"s{i}", DAY, 2e6) for i in range(150)]
    with pytest.raises(DataQualityError, match="150 quality problem") as caught:
        require_quality(silver(spark, *rows), str(tmp_path / "report"))
    assert caught.value.count == 150
    report = caught.value.report(spark)
    assert {r.escopo for r in report.collect()} == {f"s{i}" for i in range(150)}
    assert {r.expectativa for r in report.collect()} == {BETWEEN}


def test_ranges_as_a_table_and_as_a_mapping_agree(spark):
    rows = [
        (i, name, DAY, float(i % 30) if i % 11 else None)
        for i in range(200)
        for name in ("a", "b", None)
    ]
    frame = silver(spark, *rows)
    ranges = {"a": (3, 20), "z": (0, 1)}
    as_table = spark.createDataFrame(
        [("a", 3.0, 20.0), ("z", 0.0, 1.0)], "serie_nome string, minimo double, maximo double"
    )
    found = sorted(range_violations(frame, ranges, (0, 25)).collect())
    assert sorted(range_violations(frame, as_table, (0, 25)).collect()) == found
    values = [(i % 30) if i % 11 else None for i in range(200)]
    assert found == [
        ("a", sum(v is not None and not 3 <= v <= 20 for v in values)),
        ("b", sum(v is not None and not 0 <= v <= 25 for v in values)),
    ]


@pytest.mark.parametrize("names", [("a", "a"), ("a", None), ("q", "q")])
def test_repeated_or_null_range_names_are_refused(spark, names):
    frame = silver(spark, (1, "a", None, 1.0), (2, "a", DAY, 2.0))
    bad = spark.createDataFrame(
        [(n, 0.0, 1.0) for n in names], "serie_nome string, minimo double, maximo double"
    )
    with pytest.raises(Exception, match="null or repeated"):
        range_violations(frame, bad).collect()


def test_plan_has_one_plain_join(spark):
    frame = silver(spark, (1, "a", DAY, 1.0))
    bounds = spark.range(5).selectExpr("string(id) serie_nome", "0D minimo", "1D maximo")
    plan = range_violations(frame, bounds)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "hint" not in plan.lower()
