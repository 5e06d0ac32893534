import datetime as dt
import json

import pytest
from pyspark.sql import Observation

from lakeseries.operators.silver import bronze_to_silver
from lakeseries.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from lakeseries.sources import (
    TableNotFoundError,
    bronze_glob,
    catalog_from_rows,
    corrupt_documents,
    read_bronze,
    read_catalog,
    read_table,
    work_path,
    write_bronze,
    write_table,
)

SILVER = [
    (11, "a", dt.date(2024, 1, 1), 1.0),
    (11, "a", dt.date(2024, 1, 2), 2.0),
    (433, "b", dt.date(2024, 1, 1), 3.0),
]


def documents(spark, *rows):
    return spark.createDataFrame(
        [(c, n, d, len(r), r, None, None) for c, n, d, r in rows], BRONZE_SCHEMA
    )


def test_bronze_layout_and_payload(spark, tmp_path):
    write_bronze(
        documents(spark, (11, "selic_diaria", "2026-07-23", [("01/01/2024", "11,75")])),
        str(tmp_path),
    )
    (file,) = (tmp_path / "serie=11" / "data_ingestao=2026-07-23").glob("part-*")
    assert json.loads(file.read_text(encoding="utf-8")) == {
        "codigo": 11,
        "nome": "selic_diaria",
        "data_ingestao": "2026-07-23",
        "quantidade_registros": 1,
        "registros": [{"data": "01/01/2024", "valor": "11,75"}],
    }


def test_bronze_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path)
    write_bronze(documents(spark, (1, "ação", "2026-07-22", [("01/01/2024", "1")])), path)
    write_bronze(
        documents(
            spark,
            (1, "ação", "2026-07-23", [("01/01/2024", "2")]),
            (2, "b", "2026-07-23", [("01/01/2024", None)]),
        ),
        path,
    )
    write_bronze(documents(spark, (1, "ação", "2026-07-23", [("01/01/2024", "3")])), path)
    stored = read_bronze(spark, bronze_glob(path))
    assert stored.columns == BRONZE_SCHEMA.fieldNames()
    rows = sorted((r.codigo, r.nome, r.data_ingestao, r.registros[0].valor) for r in stored.collect())
    assert rows == [
        (1, "ação", "2026-07-22", "1"),
        (1, "ação", "2026-07-23", "3"),
        (2, "b", "2026-07-23", None),
    ]


def test_pretty_printed_documents(spark, tmp_path):
    folder = tmp_path / "serie=11" / "data_ingestao=2026-07-23"
    folder.mkdir(parents=True)
    payload = {
        "codigo": 11,
        "nome": "s",
        "data_ingestao": "2026-07-23",
        "quantidade_registros": 1,
        "registros": [{"data": "01/01/2024", "valor": "11,75"}],
        "extra": True,
    }
    (folder / "raw.json").write_text(json.dumps(payload, indent=2), encoding="utf-8")
    glob = f"{tmp_path}/serie=*/data_ingestao=*/raw.json"
    table = bronze_to_silver(read_bronze(spark, glob, multi_line=True))
    assert [r.valor for r in table.collect()] == [11.75]
    assert corrupt_documents(spark, glob, multi_line=True).count() == 0


def test_corrupt_documents(spark, tmp_path):
    good = {"codigo": 1, "nome": "s", "data_ingestao": "2026-07-23", "registros": []}
    (tmp_path / "part-0").write_text(json.dumps(good) + "\n{broken\n", encoding="utf-8")
    glob = f"{tmp_path}/part-*"
    assert [r.texto for r in corrupt_documents(spark, glob).collect()] == ["{broken"]
    assert bronze_to_silver(read_bronze(spark, glob)).count() == 0


def test_silver_is_partitioned_and_keeps_column_order(spark, tmp_path):
    path = str(tmp_path / "silver")
    frame = spark.createDataFrame(SILVER, SILVER_SCHEMA)
    written = Observation()
    write_table(frame, path, partition_by=["serie_codigo"], sort_by=["serie_codigo", "data"], count_into=written)
    assert written.get["linhas"] == 3
    assert {p.name for p in (tmp_path / "silver").glob("dados/*/serie_codigo=*")} == {
        "serie_codigo=11",
        "serie_codigo=433",
    }
    stored = read_table(spark, path, schema=SILVER_SCHEMA)
    assert stored.columns == SILVER_SCHEMA.fieldNames()
    assert sorted(stored.collect()) == SILVER
    plan = stored.filter("serie_codigo = 11")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(serie_codigo" in plan


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "wide")
    write_table(spark.createDataFrame([(2024, 1.0)], "ano int, a double"), path)
    write_table(spark.createDataFrame([(2024, 1.0, 2.0)], "ano int, a double, b double"), path)
    assert read_table(spark, path).collect() == [(2024, 1.0, 2.0)]


def test_only_the_last_two_versions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        version = write_table(spark.range(n), path)
        assert read_table(spark, path).count() == n
    (tmp_path / "t" / "dados" / "v5-dead").mkdir()
    opened = read_table(spark, path)
    write_table(spark.range(9), path)
    kept = {p.name for p in (tmp_path / "t" / "dados").iterdir()}
    assert len(kept) == 2 and version.rsplit("/", 1)[1] in kept
    assert opened.count() == 4


def test_a_crash_before_the_log_entry_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    with monkeypatch.context() as patch:
        patch.setattr("lakeseries.sources.tables._LOG", "numero no_type")
        patch.setattr("lakeseries.sources.tables._versions", lambda *_: [(1, "x")])
        with pytest.raises(Exception):
            write_table(spark.range(7), path)
    assert len(list((tmp_path / "t" / "dados").iterdir())) == 2
    assert read_table(spark, path).count() == 3
    write_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_table(spark.createDataFrame(SILVER, SILVER_SCHEMA), path, fmt, partition_by=["serie_codigo"])
    assert sorted(read_table(spark, path, fmt, SILVER_SCHEMA).collect()) == SILVER
    with pytest.raises(ValueError):
        write_table(spark.range(1), path, "csv")


def test_a_plan_may_replace_the_table_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(read_table(spark, path).filter("id > 0"), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 2]


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_table(spark.range(3).selectExpr("id div (id - id) AS id"), path)
    assert read_table(spark, path).count() == 3


def test_missing_table(spark, tmp_path):
    with pytest.raises(TableNotFoundError, match="run_batch"):
        read_table(spark, str(tmp_path / "nothing"))


def test_catalog_from_rows_and_file(spark, tmp_path):
    rows = [{"codigo": 11, "nome": "selic_diaria", "data_inicial": "01/01/2015"}]
    file = tmp_path / "series.json"
    file.write_text(json.dumps(rows[0]))
    expected = [(11, "selic_diaria", "01/01/2015", None)]
    assert catalog_from_rows(spark, rows).collect() == expected
    assert read_catalog(spark, str(file)).collect() == expected


def test_work_path_is_in_the_session_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_path(spark, "x"), work_path(spark, "x")
    assert first.startswith(base) and first != second


def test_work_path_needs_a_folder(spark, tmp_path):
    class Unset:
        class conf:
            @staticmethod
            def get(_, default):
                return default

    assert work_path(spark, "x", str(tmp_path)).startswith(str(tmp_path))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_path(Unset, "x")
