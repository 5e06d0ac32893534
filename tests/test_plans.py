import datetime as dt
import json

import pytest

from lakeseries import BatchConfig, DataQualityError, read_table, run_batch, run_ingestion
from lakeseries.operators.silver import discard_metric, normalise
from lakeseries.schemas import BRONZE_SCHEMA, PAGE_SCHEMA, SILVER_SCHEMA
from lakeseries.sources import bronze_glob, catalog_from_rows, read_bronze, write_bronze


def config(base, **options):
    return BatchConfig(
        bronze_glob=bronze_glob(f"{base}/bronze"),
        silver_path=f"{base}/silver",
        gold_monthly_path=f"{base}/mensal",
        gold_comparison_path=f"{base}/comparativo",
        **options,
    )


def put(spark, base, *rows):
    documents = spark.createDataFrame(
        [(c, n, d, len(r), r, None, None) for c, n, d, r in rows], BRONZE_SCHEMA
    )
    write_bronze(documents, f"{base}/bronze")


SELIC = (11, "selic_diaria", "2026-07-23", [("01/01/2024", "11,75"), ("01/02/2024", "11,25"), ("x", "1")])
IPCA = (433, "ipca_mensal", "2026-07-23", [("01/01/2024", "0,42"), ("01/01/2024", None)])


def test_batch(spark, tmp_path):
    put(spark, tmp_path, SELIC, IPCA)
    metrics = run_batch(spark, config(tmp_path))
    assert (metrics.records_read, metrics.records_discarded) == (5, 2)
    assert (metrics.silver_rows, metrics.monthly_rows, metrics.comparison_rows) == (3, 3, 2)
    expected = discard_metric(normalise(read_bronze(spark, bronze_glob(f"{tmp_path}/bronze")))).first()
    assert (metrics.records_read, metrics.records_discarded) == (expected.lidos, expected.descartados)
    assert read_table(spark, f"{tmp_path}/silver", schema=SILVER_SCHEMA).count() == 3
    wide = read_table(spark, f"{tmp_path}/comparativo").orderBy("mes")
    assert wide.columns == ["ano", "mes", "ipca_mensal", "selic_diaria"]
    assert wide.collect() == [(2024, 1, 0.42, 11.75), (2024, 2, None, 11.25)]
    assert {f.name: f.dataType.simpleString() for f in read_table(spark, f"{tmp_path}/mensal").schema} == {
        "serie_codigo": "int",
        "serie_nome": "string",
        "ano": "int",
        "mes": "int",
        "valor_medio": "double",
        "valor_min": "double",
        "valor_max": "double",
        "qtd_observacoes": "bigint",
        "variacao_percentual_mensal": "double",
    }


def test_failed_check_replaces_silver_and_keeps_gold(spark, tmp_path):
    put(spark, tmp_path, SELIC)
    run_batch(spark, config(tmp_path))
    put(spark, tmp_path, (11, "selic_diaria", "2026-07-24", [("01/01/2024", "350")]))
    with pytest.raises(DataQualityError):
        run_batch(spark, config(tmp_path))
    silver = read_table(spark, f"{tmp_path}/silver", schema=SILVER_SCHEMA)
    assert max(r.valor for r in silver.collect()) == 350.0
    assert max(r.valor_max for r in read_table(spark, f"{tmp_path}/mensal").collect()) == 11.75
    run_batch(spark, config(tmp_path, skip_quality_check=True))
    assert max(r.valor_max for r in read_table(spark, f"{tmp_path}/mensal").collect()) == 350.0


def test_new_series_adds_a_column(spark, tmp_path):
    put(spark, tmp_path, SELIC)
    run_batch(spark, config(tmp_path))
    put(spark, tmp_path, IPCA)
    run_batch(spark, config(tmp_path))
    assert read_table(spark, f"{tmp_path}/comparativo").columns == [
        "ano",
        "mes",
        "ipca_mensal",
        "selic_diaria",
    ]
    names = ["selic_diaria", "ipca_mensal", "nova"]
    run_batch(spark, config(tmp_path, series_names=names))
    assert read_table(spark, f"{tmp_path}/comparativo").columns == ["ano", "mes", *sorted(names)]


def test_ingestion_to_gold(spark, tmp_path):
    def body(day, value):
        return json.dumps([{"data": day, "valor": value}])

    landed = spark.createDataFrame(
        [
            (11, "x", dt.date(2015, 1, 1), None, 0, 200, body("05/01/2015", "11,75")),
            (11, "x", dt.date(2016, 1, 2), None, 0, 200, body("04/02/2016", "14,25")),
            (1, "x", dt.date(2015, 1, 1), None, 0, 200, body("05/01/2015", "2,6")),
            (1, "x", dt.date(2016, 1, 2), None, 0, 502, "bad gateway"),
        ],
        PAGE_SCHEMA,
    )
    catalog = catalog_from_rows(
        spark,
        [
            {"codigo": 11, "nome": "selic_diaria", "data_inicial": "01/01/2015", "data_final": "01/06/2016"},
            {"codigo": 1, "nome": "cambio_usd_venda", "data_inicial": "01/01/2015", "data_final": "01/06/2016"},
        ],
    )
    failures, metrics = run_ingestion(
        catalog, landed, f"{tmp_path}/bronze", dt.date(2026, 7, 23), folder=f"{tmp_path}/work"
    )
    assert (metrics.failed_series, metrics.unplanned_pages) == (1, 0)
    assert list((tmp_path / "work").iterdir()) == []
    assert failures.first() == (1, "cambio_usd_venda", "http_status")
    assert [p.name for p in (tmp_path / "bronze").glob("serie=*")] == ["serie=11"]
    assert run_batch(spark, config(tmp_path)).monthly_rows == 2


def test_silver_without_directories(spark, tmp_path):
    put(spark, tmp_path, SELIC, IPCA)
    assert run_batch(spark, config(tmp_path, silver_partition_by=())).silver_rows == 3
    assert not list((tmp_path / "silver").glob("dados/*/serie_codigo=*"))
    assert read_table(spark, f"{tmp_path}/silver", schema=SILVER_SCHEMA).count() == 3


def test_broken_documents_are_counted(spark, tmp_path):
    put(spark, tmp_path, SELIC)
    folder = tmp_path / "bronze" / "serie=11" / "data_ingestao=2026-07-24"
    folder.mkdir(parents=True)
    good = {"codigo": 11, "nome": "selic_diaria", "data_ingestao": "2026-07-24", "registros": None}
    (folder / "part-0").write_text(json.dumps(good) + '\n{"codigo": 11, "registros": [\n')
    metrics = run_batch(spark, config(tmp_path))
    assert (metrics.records_read, metrics.records_discarded, metrics.corrupt_documents) == (3, 1, 1)
    (folder / "part-1").write_text(json.dumps(good, indent=2))
    assert run_batch(spark, config(tmp_path)).corrupt_documents > 1


def test_names_must_cover_all_series(spark, tmp_path):
    put(spark, tmp_path, SELIC, IPCA)
    with pytest.raises(Exception, match="without a column in the comparison: ipca_mensal"):
        run_batch(spark, config(tmp_path, series_names=["selic_diaria"]))


def test_report_outlives_the_next_run(spark, tmp_path):
    put(spark, tmp_path, (11, "selic_diaria", "2026-07-24", [("01/01/2024", "350")]))
    with pytest.raises(DataQualityError) as caught:
        run_batch(spark, config(tmp_path))
    put(spark, tmp_path, (11, "selic_diaria", "2026-07-24", [("01/01/2024", "11")]))
    run_batch(spark, config(tmp_path))
    assert caught.value.count == 1
    assert caught.value.report(spark).first().escopo == "selic_diaria"


def test_landing_table_with_other_columns(spark, tmp_path):
    landed = spark.createDataFrame(
        [(11, dt.date(2015, 1, 1), 200, '[{"data":"05/01/2015","valor":"1"}]', "http://x")],
        "codigo int, janela_inicio date, status int, body string, url string",
    )
    catalog = catalog_from_rows(
        spark,
        [{"codigo": 11, "nome": "s", "data_inicial": "01/01/2015", "data_final": "01/02/2015"}],
    )
    failures, _ = run_ingestion(catalog, landed, f"{tmp_path}/bronze")
    assert failures.isEmpty()
    assert read_bronze(spark, bronze_glob(f"{tmp_path}/bronze")).first().nome == "s"
