import datetime as dt
import random

from lakeseries.operators.silver import (
    KEY,
    RECENCY,
    SILVER_COLUMNS,
    bronze_to_silver,
    discard_metric,
    document_counts,
    drop_invalid,
    keep_latest,
    normalise,
)
from lakeseries.schemas import BRONZE_SCHEMA


def bronze(spark, *documents):
    rows = [
        (code, name, day, len(records or []), records, None, None)
        for code, name, day, records in documents
    ]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def test_decimal_comma(spark):
    table = bronze_to_silver(
        bronze(spark, (11, "selic_diaria", "2026-07-23", [("01/01/2024", "11,75")]))
    )
    assert table.columns == SILVER_COLUMNS
    assert table.collect() == [(11, "selic_diaria", dt.date(2024, 1, 1), 11.75)]


def test_newest_ingestion_wins(spark):
    table = bronze_to_silver(
        bronze(
            spark,
            (11, "selic_diaria", "2026-07-20", [("01/01/2024", "11,75")]),
            (11, "selic_diaria", "2026-07-23", [("01/01/2024", "11,90")]),
        )
    )
    assert [r.valor for r in table.collect()] == [11.90]


def test_null_value_dropped(spark):
    table = bronze_to_silver(
        bronze(
            spark,
            (11, "selic_diaria", "2026-07-23", [("01/01/2024", "11,75"), ("02/01/2024", None)]),
        )
    )
    assert table.count() == 1


def test_same_date_of_two_series(spark):
    table = bronze_to_silver(
        bronze(
            spark,
            (11, "selic_diaria", "2026-07-23", [("01/01/2024", "11,75")]),
            (433, "ipca_mensal", "2026-07-23", [("01/01/2024", "0,42")]),
        )
    )
    assert table.count() == 2


def test_newer_null_does_not_hide_older_value(spark):
    table = bronze_to_silver(
        bronze(
            spark,
            (11, "s", "2026-07-20", [("01/01/2024", "1,0")]),
            (11, "s", "2026-07-23", [("01/01/2024", "n/d")]),
        )
    )
    assert [r.valor for r in table.collect()] == [1.0]


def test_text_that_ansi_casts_reject(spark):
    bad_dates = ["31/02/2024", "1/1/2024", "2024-01-01", "01/01/24", "", None]
    bad_values = ["abc", "", "1.234,56", "1,2,3", None]
    records = [(d, "1") for d in bad_dates] + [("05/01/2024", v) for v in bad_values]
    rows = normalise(bronze(spark, (1, "s", "2026-07-23", records + [("06/01/2024", "-1,5")])))
    assert [(r.data, r.valor) for r in drop_invalid(rows).collect()] == [
        (dt.date(2024, 1, 6), -1.5)
    ]
    assert discard_metric(rows).first() == (12, 1, 11)


def test_nan_text_is_a_value_here(spark):
    rows = drop_invalid(normalise(bronze(spark, (1, "s", "2026-07-23", [("01/01/2024", "NaN")]))))
    assert rows.count() == 1


def test_null_or_empty_record_array_gives_no_row(spark):
    documents = bronze(spark, (1, "s", "2026-07-23", None), (2, "t", "2026-07-23", []))
    assert bronze_to_silver(documents).count() == 0


def test_later_record_of_one_document_wins(spark):
    table = bronze_to_silver(
        bronze(spark, (1, "s", "2026-07-23", [("01/01/2024", "9"), ("01/01/2024", "3")]))
    )
    assert [r.valor for r in table.collect()] == [3.0]


def test_keep_latest_with_arbitrary_columns(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "y"), ("b", None, "z"), ("a", 3, "w")],
        "k string, v int, payload string",
    )
    result = {r.k: (r.v, r.payload) for r in keep_latest(rows, ["k"], ["v"]).collect()}
    assert result == {"a": (3, "w"), "b": (None, "z")}


def test_random_documents_against_brute_force(spark):
    rng = random.Random(7)
    documents = []
    for day in ("2026-07-20", "2026-07-21", "2026-07-22"):
        for code in (1, 2, 3):
            records = [
                (
                    rng.choice([f"{rng.randint(1, 9):02d}/01/2024", "bad", None]),
                    rng.choice([f"{rng.randint(0, 99)},5", "x", None]),
                )
                for _ in range(40)
            ]
            documents.append((code, f"s{code}", day, records))
    frame = bronze(spark, *documents)
    plain = sorted(bronze_to_silver(frame).collect())

    expected, read, valid = {}, 0, 0
    for code, name, day, records in sorted(documents, key=lambda d: d[2]):
        for date_text, value_text in records:
            read += 1
            if date_text in (None, "bad") or value_text in (None, "x"):
                continue
            valid += 1
            date = dt.datetime.strptime(date_text, "%d/%m/%Y").date()
            expected[code, date] = (code, name, date, float(value_text.replace(",", ".")))
    assert plain == sorted(expected.values())
    totals = document_counts(frame.selectExpr("*", "CAST(NULL AS STRING) AS broken"), "broken")
    assert totals.first() == (read, valid, 0)
    assert discard_metric(normalise(frame)).first() == (read, valid, read - valid)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_key_are_cut_before_the_shuffle(spark):
    documents = bronze(spark, (1, "s", "2026-07-23", [("01/01/2024", "1")]))
    text = plan(keep_latest(normalise(documents), KEY, RECENCY))
    assert text.index("Exchange") < text.index("WindowGroupLimit", text.index("Exchange"))
