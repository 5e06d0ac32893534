import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeseries.functions import br_date_text
from lakeseries.operators.pages import (
    HTTP_STATUS,
    INVALID_JSON,
    MISSING_PAGE,
    NOT_A_LIST,
    UNPLANNED_PAGE,
    assemble_documents,
    failed_series,
    series_totals,
    validate_pages,
)
from lakeseries.operators.silver import bronze_to_silver
from lakeseries.operators.windows import INVALID_DATE, START_AFTER_END, invalid_requests, year_windows
from lakeseries.plans.ingestion import check_pages, failure_count, ingest_pages
from lakeseries.schemas import PAGE_SCHEMA
from lakeseries.sources import catalog_from_rows

D = dt.date


def windows(spark, start, end, **options):
    row = {"codigo": 1, "nome": "s", "data_inicial": f"{start:%d/%m/%Y}"}
    if end is not None:
        row["data_final"] = f"{end:%d/%m/%Y}"
    table = year_windows(catalog_from_rows(spark, [row]), **options).orderBy("ordem")
    return [(r.janela_inicio, r.janela_fim) for r in table.collect()]


def expected_windows(start, end):
    result = []
    while start <= end:
        try:
            anniversary = start.replace(year=start.year + 1)
        except ValueError:
            anniversary = D(start.year + 1, 2, 28)
        stop = min(anniversary, end)
        result.append((start, stop))
        start = stop + dt.timedelta(days=1)
    return result


def test_short_interval_is_one_window(spark):
    assert windows(spark, D(2024, 1, 1), D(2024, 6, 1)) == [(D(2024, 1, 1), D(2024, 6, 1))]


def test_anniversary_belongs_to_the_window(spark):
    assert windows(spark, D(2015, 1, 1), D(2018, 6, 15)) == [
        (D(2015, 1, 1), D(2016, 1, 1)),
        (D(2016, 1, 2), D(2017, 1, 2)),
        (D(2017, 1, 3), D(2018, 1, 3)),
        (D(2018, 1, 4), D(2018, 6, 15)),
    ]


def test_leap_days(spark):
    assert windows(spark, D(2023, 2, 28), D(2026, 12, 31)) == [
        (D(2023, 2, 28), D(2024, 2, 28)),
        (D(2024, 2, 29), D(2025, 2, 28)),
        (D(2025, 3, 1), D(2026, 3, 1)),
        (D(2026, 3, 2), D(2026, 12, 31)),
    ]


def test_contiguous_with_outer_bounds_kept(spark):
    got = windows(spark, D(2015, 3, 10), D(2019, 8, 20))
    assert (got[0][0], got[-1][1]) == (D(2015, 3, 10), D(2019, 8, 20))
    assert all((b[0] - a[1]).days == 1 for a, b in zip(got, got[1:]))


def test_random_windows(spark):
    rng = random.Random(3)
    requests = {}
    for code in range(300):
        start = D(1990, 1, 1) + dt.timedelta(days=rng.randint(0, 9000))
        requests[code] = (start, start + dt.timedelta(days=rng.randint(0, 12000)))
    catalog = catalog_from_rows(
        spark,
        [
            {"codigo": c, "nome": "s", "data_inicial": f"{a:%d/%m/%Y}", "data_final": f"{b:%d/%m/%Y}"}
            for c, (a, b) in requests.items()
        ],
    )
    got = {}
    for r in year_windows(catalog).orderBy("codigo", "ordem").collect():
        got.setdefault(r.codigo, []).append((r.janela_inicio, r.janela_fim))
    assert got == {c: expected_windows(a, b) for c, (a, b) in requests.items()}


def test_open_end_is_today(spark):
    assert windows(spark, D(2024, 1, 1), None, today=D(2024, 3, 5)) == [
        (D(2024, 1, 1), D(2024, 3, 5))
    ]
    assert windows(spark, D(2024, 1, 1), None)[-1][1] >= D(2024, 3, 5)


def test_invalid_requests(spark):
    catalog = catalog_from_rows(
        spark,
        [
            {"codigo": 1, "nome": "late", "data_inicial": "01/01/2026", "data_final": "01/01/2020"},
            {"codigo": 2, "nome": "bad", "data_inicial": "2020-01-01"},
            {"codigo": 3, "nome": "unpadded", "data_inicial": "1/2/2020", "data_final": ""},
        ],
    )
    assert sorted(map(tuple, invalid_requests(catalog).collect())) == [
        (1, "late", START_AFTER_END),
        (2, "bad", INVALID_DATE),
    ]
    assert {r.codigo for r in year_windows(catalog).collect()} == {3}


def test_brazilian_date_text(spark):
    row = spark.range(1).select(br_date_text(F.lit(D(2024, 3, 5))).alias("d")).first()
    assert row.d == "05/03/2024"


def pages(spark, *rows):
    return spark.createDataFrame(
        [(c, n, start, None, 0, status, body) for c, n, start, status, body in rows], PAGE_SCHEMA
    )


@pytest.mark.parametrize(
    ("status", "body", "error", "records"),
    [
        (200, '[{"data":"01/01/2015","valor":"11,75"}]', None, [("01/01/2015", "11,75")]),
        (200, "[]", None, []),
        (200, ' [ {"valor": 2.5, "x": 1} ] ', None, [(None, "2.5")]),
        (500, None, HTTP_STATUS, None),
        (500, "[]", HTTP_STATUS, None),
        (None, "[]", HTTP_STATUS, None),
        (200, '{"nao_e_uma_lista": true}', NOT_A_LIST, None),
        (200, '"text"', NOT_A_LIST, None),
        (200, "null", NOT_A_LIST, None),
        (200, "", INVALID_JSON, None),
        (200, None, INVALID_JSON, None),
        (200, '[{"data":"01/01/2015"', INVALID_JSON, None),
        (200, "[{'data':'01/01/2015'}]", INVALID_JSON, None),
    ],
)
def test_page_validation(spark, status, body, error, records):
    row = validate_pages(pages(spark, (1, "s", D(2015, 1, 1), status, body))).first()
    assert row.erro == error
    assert (None if row.registros is None else [tuple(r) for r in row.registros]) == records


def test_text_after_the_list_is_an_error(spark):
    for body in ('[{"data":"x"}] xyz', "[1] [2]", "[1],[2]"):
        assert validate_pages(pages(spark, (1, "s", D(2015, 1, 1), 200, body))).first().erro


def test_elements_that_are_no_objects_keep_the_page(spark):
    row = validate_pages(pages(spark, (1, "s", D(2015, 1, 1), 200, '[{"data":"x"}, 3]'))).first()
    assert row.erro is None and len(row.registros) == 2 and row.registros[0].data == "x"


def page_body(*records):
    return "[" + ",".join(f'{{"data":"{d}","valor":"{v}"}}' for d, v in records) + "]"


def test_a_document_per_page_with_its_place(spark):
    landed = pages(
        spark,
        (11, "selic", D(2016, 1, 2), 200, page_body(("05/01/2016", "14,25"), ("03/01/2016", "1"))),
        (11, "selic", D(2015, 1, 1), 200, page_body(("01/01/2015", "11,75"))),
    )
    documents = assemble_documents(validate_pages(landed), D(2026, 7, 23))
    rows = documents.orderBy("janela_inicio", "pagina").collect()
    assert [(r.codigo, r.nome, r.data_ingestao) for r in rows] == [(11, "selic", "2026-07-23")] * 2
    assert [(r.janela_inicio, r.pagina, r.quantidade_registros) for r in rows] == [
        ("2015-01-01", 0, 1),
        ("2016-01-02", 0, 2),
    ]
    records = [r.data for row in rows for r in row.registros]
    assert records == ["01/01/2015", "05/01/2016", "03/01/2016"]
    assert series_totals(documents).collect() == [(11, "selic", "2026-07-23", 2, 3)]


def test_one_bad_page_fails_its_series_only(spark):
    checked = validate_pages(
        pages(
            spark,
            (1, "good", D(2015, 1, 1), 200, page_body(("01/01/2015", "1"))),
            (2, "bad", D(2015, 1, 1), 200, page_body(("01/01/2015", "1"))),
            (2, "bad", D(2016, 1, 2), 200, "{}"),
            (2, "bad", D(2017, 1, 3), 503, ""),
            (3, "empty", D(2015, 1, 1), 200, "[]"),
        )
    )
    documents = {r.codigo: r.quantidade_registros for r in assemble_documents(checked).collect()}
    assert documents == {1: 1, 3: 0}
    assert [tuple(r) for r in failed_series(checked).collect()] == [(2, "bad", NOT_A_LIST, 2)]


def test_failed_series_with_null_names(spark):
    checked = validate_pages(
        pages(
            spark,
            (1, None, D(2015, 1, 1), 200, "[]"),
            (1, None, D(2016, 1, 2), 500, None),
            (2, None, D(2015, 1, 1), 200, "[]"),
        )
    )
    assert [r.codigo for r in assemble_documents(checked).collect()] == [2]


def test_pages_without_number(spark):
    landed = pages(spark, (1, "s", D(2015, 1, 1), 200, "[]")).drop("pagina")
    assert assemble_documents(validate_pages(landed)).count() == 1


def test_ingestion_from_catalog(spark):
    catalog = catalog_from_rows(
        spark,
        [
            {"codigo": 1, "nome": "ok", "data_inicial": "01/01/2015", "data_final": "01/06/2016"},
            {"codigo": 2, "nome": "hole", "data_inicial": "01/01/2015", "data_final": "01/06/2016"},
            {"codigo": 3, "nome": "late", "data_inicial": "01/01/2026", "data_final": "01/01/2020"},
            {"codigo": 4, "nome": "http", "data_inicial": "01/01/2015", "data_final": "01/02/2015"},
        ],
    )
    landed = pages(
        spark,
        (1, "ok", D(2015, 1, 1), 200, page_body(("01/01/2015", "11,75"))),
        (1, "ok", D(2016, 1, 2), 200, page_body(("04/01/2016", "14,25"))),
        (2, "hole", D(2015, 1, 1), 200, page_body(("01/01/2015", "1"))),
        (4, "http", D(2015, 1, 1), 500, None),
        (99, "unplanned", D(2015, 1, 1), 200, "[]"),
    )
    run = ingest_pages(catalog, landed, D(2026, 7, 23))
    documents = sorted((r.codigo, r.nome, r.quantidade_registros) for r in run.documents.collect())
    assert documents == [(1, "ok", 1), (1, "ok", 1)]
    assert sorted(map(tuple, run.failures.collect())) == [
        (2, "hole", MISSING_PAGE),
        (3, "late", START_AFTER_END),
        (4, "http", HTTP_STATUS),
    ]
    assert failure_count(run.failures) == 3
    assert run.unplanned.collect() == [(99, D(2015, 1, 1), 0, UNPLANNED_PAGE)]
    run.close()
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|FileNotFound"):
        run.documents.collect()


def test_pages_outside_the_plan_fail_nothing(spark):
    catalog = catalog_from_rows(
        spark, [{"codigo": 1, "nome": "s", "data_inicial": "01/01/2015", "data_final": "01/02/2015"}]
    )
    landed = pages(
        spark,
        (1, "s", D(2015, 1, 1), 200, "[]"),
        (1, "s", D(2015, 1, 2), 500, None),
        (None, "s", D(2015, 1, 1), 200, "[]"),
        (1, "s", None, 200, "[]"),
    )
    run = ingest_pages(catalog, landed, "2026-07-23")
    assert run.documents.count() == 1 and run.failures.isEmpty()
    assert run.unplanned.count() == 3


def test_landing_is_read_once_and_parsed_after_the_join(spark, tmp_path):
    pages(spark, (1, "s", D(2015, 1, 1), 200, "[]")).write.parquet(str(tmp_path / "landing"))
    landed = spark.read.parquet(str(tmp_path / "landing"))
    catalog = catalog_from_rows(
        spark, [{"codigo": 1, "nome": "s", "data_inicial": "01/01/2015", "data_final": "01/02/2015"}]
    )
    plan = check_pages(catalog, landed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.index("from_json") < plan.index("FullOuter")


def test_copies_of_a_page_all_stay(spark):
    copies = [(1, "hot", D(2015, 1, 1), 200, page_body(("01/01/2015", "1")))] * 30
    others = [(2, "cold", D(2015, 1, 1), 200, page_body(("01/01/2015", "2")))]
    checked = validate_pages(pages(spark, *copies, *others))
    totals = series_totals(assemble_documents(checked, "2026-07-23")).collect()
    assert {r.codigo: (r.paginas, r.registros) for r in totals} == {1: (30, 30), 2: (1, 1)}


def test_page_order_decides_between_records_of_a_day(spark):
    rows = [
        (1, "s", D(2015, 1, 1), 200, page_body(("05/01/2015", "9"), ("06/01/2015", "1"))),
        (1, "s", D(2016, 1, 2), 200, page_body(("05/01/2015", "3"), ("07/01/2015", "4"), ("07/01/2015", "2"))),
    ]
    silver = bronze_to_silver(assemble_documents(validate_pages(pages(spark, *rows)), "2026-07-23"))
    assert {r.data.day: r.valor for r in silver.collect()} == {5: 3.0, 6: 1.0, 7: 2.0}
