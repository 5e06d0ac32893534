"""Additions in any order, and a stream of pages, against a full rebuild."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

import lakeseries.plans.incremental as incremental
from lakeseries.operators.gold import comparison, monthly
from lakeseries.operators.pages import assemble_documents, validate_pages
from lakeseries.operators.quality import DataQualityError
from lakeseries.operators.silver import bronze_to_silver
from lakeseries.plans.incremental import (
    IncrementalConfig,
    merge_documents,
    read_comparison,
    read_monthly,
    read_silver,
)
from lakeseries.schemas import BRONZE_SCHEMA
from lakeseries.streaming import landing
from lakeseries.streaming.landing import StreamConfig, close_all, read_failures, read_late, run_available

WIDE = (-1e9, 1e9)


def _document(rng, code, day):
    records = []
    for _ in range(rng.randrange(1, 5)):
        date = dt.date(2023, 1, 1) + dt.timedelta(rng.randrange(0, 120, 7))
        value = rng.choice([f"{rng.randrange(100)},5", f"{rng.randrange(9)}", "n/d", "0"])
        records.append((date.strftime("%d/%m/%Y"), value))
    name = f"serie_{code}" if rng.random() < 0.9 else f"outra_{code}"
    return (code, name, day, len(records), records, None, rng.randrange(100))


def _rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted((tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()), key=repr)


def _same_as_rebuild(spark, base, bronze):
    silver = bronze_to_silver(bronze)
    assert _rows(read_silver(spark, base)) == _rows(silver)
    months = monthly(silver, ordered=False)
    assert _rows(read_monthly(spark, base)) == _rows(months)
    assert _rows(read_comparison(spark, base)) == _rows(comparison(months, ordered=False))


def test_additions_in_any_order_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(3)
    config = IncrementalConfig(str(tmp_path / "t"), ranges={}, default_range=WIDE)
    added = []
    for day in ("2024-05-03", "2024-05-01", "2024-05-02"):
        documents = [_document(rng, code, day) for code in (1, 1, 2, 3)]
        added += documents
        merge_documents(spark.createDataFrame(documents, BRONZE_SCHEMA), config)
        _same_as_rebuild(spark, config.base, spark.createDataFrame(added, BRONZE_SCHEMA))
    # The same documents once more.
    again = merge_documents(spark.createDataFrame(added, BRONZE_SCHEMA), config)
    _same_as_rebuild(spark, config.base, spark.createDataFrame(added, BRONZE_SCHEMA))
    assert again.silver_months > 0
    assert os.listdir(f"{config.base}/pendentes") == []


def _one(spark, code, date, value, day="2024-05-01"):
    row = (code, f"serie_{code}", day, 1, [(date, value)], None, 0)
    return spark.createDataFrame([row], BRONZE_SCHEMA)


def _files(base, table):
    return {
        os.path.join(d, f) for d, _, names in os.walk(f"{base}/{table}") for f in names if f.endswith(".parquet")
    }


def test_only_changed_months_are_replaced(spark, tmp_path):
    config = IncrementalConfig(str(tmp_path / "t"), ranges={}, default_range=WIDE)
    for month in (1, 2, 3, 5, 8):
        merge_documents(_one(spark, 1, f"05/{month:02}/2024", "10"), config)
    before = {t: _files(config.base, t) for t in ("silver", "mensal", "comparativo")}
    found = merge_documents(_one(spark, 1, "06/03/2024", "20"), config)
    assert (found.silver_months, found.monthly_months, found.comparison_months) == (1, 2, 1)
    gone = {t: {f.split("mes=")[1][0] for f in before[t] - _files(config.base, t)} for t in before}
    # The next month that exists is May; its percent change moves.
    assert gone == {"silver": {"3"}, "mensal": {"3", "5"}, "comparativo": {"3"}}


def test_other_months_are_not_read(spark, tmp_path, capsys):
    config = IncrementalConfig(str(tmp_path / "t"), ranges={}, default_range=WIDE)
    for month in (1, 2, 3):
        merge_documents(_one(spark, 1, f"05/{month:02}/2024", "10"), config)
    part = incremental._read(spark, f"{config.base}/silver", incremental._STATE)
    part.where(incremental._within([(2024, 2)])).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert "DataFilters: []" in plan


@pytest.mark.parametrize("place", ["silver", "mensal", "chaves"])
def test_a_run_that_dies_is_made_up_for(spark, tmp_path, monkeypatch, place):
    """It dies with its rows complete and the old partitions already deleted."""
    config = IncrementalConfig(str(tmp_path / "t"), ranges={}, default_range=WIDE)
    rng = random.Random(5)
    first = [_document(rng, code, "2024-05-01") for code in (1, 2, 3)]
    second = [_document(rng, code, "2024-05-02") for code in (1, 2)]
    third = [_document(rng, 4, "2024-05-03")]
    merge_documents(spark.createDataFrame(first, BRONZE_SCHEMA), config)
    put = incremental._put

    def dies(session, staged, path):
        if path.endswith(f"/{place}") or place == "chaves":
            months = incremental._months(session.read.parquet(staged))
            for year, month in months if place != "chaves" else []:
                incremental.remove(session, f"{path}/ano={year}/mes={month}")
            raise RuntimeError("lost")
        put(session, staged, path)

    monkeypatch.setattr(incremental, "_put", dies)
    with pytest.raises(RuntimeError):
        merge_documents(spark.createDataFrame(second, BRONZE_SCHEMA), config)
    monkeypatch.setattr(incremental, "_put", put)
    merge_documents(spark.createDataFrame(third, BRONZE_SCHEMA), config)
    _same_as_rebuild(spark, config.base, spark.createDataFrame(first + second + third, BRONZE_SCHEMA))
    assert os.listdir(f"{config.base}/pendentes") == []


def test_bad_months_stay_pending(spark, tmp_path):
    config = IncrementalConfig(str(tmp_path / "t"), ranges={}, default_range=(0, 100))
    good = _one(spark, 1, "05/01/2024", "10")
    merge_documents(good, config)
    bad, other = _one(spark, 1, "06/01/2024", "900"), _one(spark, 2, "05/02/2024", "7")
    with pytest.raises(DataQualityError):
        merge_documents(bad, config)
    assert read_silver(spark, config.base).count() == 2
    assert [r.valor_medio for r in read_monthly(spark, config.base).collect()] == [10.0]
    with pytest.raises(DataQualityError):
        merge_documents(other, config)
    mended = _one(spark, 1, "06/01/2024", "90", "2024-05-09")
    merge_documents(mended, config)
    _same_as_rebuild(spark, config.base, good.union(bad).union(other).union(mended))


def test_empty_additions(spark, tmp_path):
    config = IncrementalConfig(str(tmp_path / "t"))
    found = merge_documents(spark.createDataFrame([], BRONZE_SCHEMA), config)
    assert (found.silver_months, found.monthly_months) == (0, 0)
    assert read_silver(spark, config.base).count() == 0
    assert read_comparison(spark, config.base).columns == ["ano", "mes"]


# Streaming


def _page(code, window, number, day, value, status=200, received=0):
    body = f'[{{"data":"{window:02}/01/2024","valor":"{value}"}}]'
    moment = dt.datetime(2024, 5, 1) + dt.timedelta(seconds=received)
    start = dt.date(2024, 1, window)
    return (code, f"serie_{code}", start, start, number, status, body, day, moment)


def _drop(spark, config, pages):
    frame = spark.createDataFrame(pages, landing.STREAM_SCHEMA)
    frame.coalesce(1).write.mode("append").json(config.landing)
    time.sleep(0.01)


def _expected(spark, pages):
    frame = spark.createDataFrame(pages, landing.STREAM_SCHEMA)
    return assemble_documents(validate_pages(frame.drop("recebido")), F.col("data_ingestao"))


DROPS = [
    [_page(1, 1, 0, "2024-05-01", 5), _page(2, 1, 0, "2024-05-01", 6, 503), _page(2, 2, 0, "2024-05-01", 7)],
    [_page(1, 2, 0, "2024-05-01", 8), _page(1, 1, 0, "2024-05-02", 9), _page(3, 3, 0, "2024-05-02", 1)],
    [_page(3, 3, 0, "2024-05-03", 2), _page(1, 5, 1, "2024-05-03", 3)],
]


@pytest.fixture
def stream(spark, tmp_path):
    tables = IncrementalConfig(str(tmp_path / "t"), ranges={}, default_range=WIDE)
    base = str(tmp_path / "t")
    os.makedirs(tmp_path / "landing")
    return StreamConfig(str(tmp_path / "landing"), base, str(tmp_path / "c"), 1, tables)


def test_three_drops_equal_the_batch(spark, stream):
    for pages in DROPS:
        _drop(spark, stream, pages)
        run_available(spark, stream)
    assert close_all(spark, stream) == ["2024-05-03"] and close_all(spark, stream) == ["2024-05-03"]
    _same_as_rebuild(spark, stream.base, _expected(spark, sum(DROPS, [])))
    failed = [(r.codigo, r.data_ingestao, r.erro) for r in read_failures(spark, stream.base).collect()]
    assert failed == [(2, "2024-05-01", "http_status")]
    assert read_late(spark, stream.base).count() == 0


def test_late_pages_go_aside_and_refetched_pages_count(spark, stream):
    _drop(spark, stream, [*DROPS[0], _page(2, 1, 0, "2024-05-01", 60, received=9)])
    run_available(spark, stream)
    _drop(spark, stream, DROPS[2])
    run_available(spark, stream)
    _drop(spark, stream, [_page(9, 9, 0, "2024-05-01", 4)])
    run_available(spark, stream)
    close_all(spark, stream)
    late = read_late(spark, stream.base).collect()
    assert [(r.codigo, r.data_ingestao) for r in late] == [(9, "2024-05-01")]
    pages = [DROPS[0][0], DROPS[0][2], _page(2, 1, 0, "2024-05-01", 60), *DROPS[2]]
    _same_as_rebuild(spark, stream.base, _expected(spark, pages))


@pytest.mark.parametrize("place", ["merge_documents", "_write"])
def test_a_restart_loses_and_doubles_nothing(spark, stream, monkeypatch, place):
    """The second batch dies after merging, or before it says what it has closed."""
    _drop(spark, stream, DROPS[0])
    run_available(spark, stream)
    _drop(spark, stream, DROPS[1])
    real = getattr(landing, place)

    def dies(*given):
        if place == "_write" and not given[1].endswith("fechadas"):
            return real(*given)
        if place == "merge_documents":
            real(*given)
        raise RuntimeError("lost")

    monkeypatch.setattr(landing, place, dies)
    with pytest.raises(Exception, match="lost"):
        run_available(spark, stream)
    monkeypatch.setattr(landing, place, real)
    _drop(spark, stream, DROPS[2])
    run_available(spark, stream)
    close_all(spark, stream)
    _same_as_rebuild(spark, stream.base, _expected(spark, sum(DROPS, [])))
    assert read_late(spark, stream.base).count() == 0
    assert read_failures(spark, stream.base).count() == 1


def test_the_pages_of_one_run_land_from_several_tasks(spark, stream):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    closed = spark.createDataFrame([("2024-04-30",)], "data_ingestao string")
    landing._write(closed, f"{stream.base}/{landing.CLOSED}", 0)
    pages = [_page(code, 1 + code % 28, 0, "2024-05-01", code) for code in range(64)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = spark.sparkContext.parallelize(pages, 8)
        landing.land(spark.createDataFrame(dealt, landing.STREAM_SCHEMA), 2, stream)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    landed = os.walk(f"{stream.base}/{landing.LANDED}")
    assert sum(name.endswith(".parquet") for _, _, names in landed for name in names) == 8
