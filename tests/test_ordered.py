"""Order within long series against plain loops, with series cut in several pieces."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeseries.operators import frames
from lakeseries.operators.asof import asof_join
from lakeseries.operators.ordered import PIECE, in_pieces, positions, prefix_sums
from lakeseries.operators.pages import series_positions

DAY = dt.date(2020, 1, 1)
SCHEMA = "serie_codigo int, data date, valor double"


@pytest.fixture(autouse=True)
def many_pieces(spark):
    """Small tables lie in four pieces too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _rows(seed, n=400, nulls=True):
    """One series holds most rows; days repeat, and some keys, days and values are null."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        code = rng.choice([1, 1, 1, 1, 2, 3, None if nulls else 4])
        day = None if nulls and rng.random() < 0.05 else DAY + dt.timedelta(rng.randrange(200))
        rows.append((code, day, None if rng.random() < 0.1 else float(rng.randrange(1000))))
    return rows


def _ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof_join(spark, strict, tolerance):
    left, right = _rows(1), _rows(2, 120)
    right += [(2, DAY + dt.timedelta(50), 7.0)] * 3
    want = []
    for code, day, value in left:
        known = [
            (d, v is not None, v or 0.0, v)
            for c, d, v in right
            if None not in (code, day, c, d) and c == code and (d < day or d == day and not strict)
        ]
        best = max(known, default=None)
        if best and tolerance is not None and (day - best[0]).days > tolerance:
            best = None
        want.append((code, day, value, best and best[0], best and best[3]))
    found = asof_join(
        spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA),
        strict=strict, tolerance_days=tolerance,
    )
    assert found.columns == ["serie_codigo", "data", "valor", "data_ref", "valor_ref"]
    assert _ordered(found.collect()) == _ordered(want)


def test_asof_join_of_empty_tables_and_clashing_names(spark):
    rows, none = spark.createDataFrame(_rows(3), SCHEMA), spark.createDataFrame([], SCHEMA)
    assert asof_join(none, rows).count() == 0
    assert asof_join(rows, none).where("data_ref is not null").count() == 0
    assert asof_join(rows, none).count() == rows.count()
    with pytest.raises(ValueError):
        asof_join(rows.withColumn("valor_REF", F.lit(1)), rows)


def test_a_long_series_lies_in_several_pieces(spark):
    """One key with nine tenths of all rows, at distinct times and at a single one."""
    rows = [(1, DAY + dt.timedelta(i), 1.0) for i in range(900)]
    rows += [(c, DAY, 1.0) for c in range(2, 102)]
    placed = in_pieces(spark.createDataFrame(rows, SCHEMA), ["serie_codigo"], ["data"])
    sizes = [r["count"] for r in placed.where("serie_codigo = 1").groupBy(PIECE).count().collect()]
    assert len(sizes) >= 3 and max(sizes) <= 450
    same_day = spark.createDataFrame([(1, DAY, float(i)) for i in range(1000)], SCHEMA)
    sizes = [r["count"] for r in in_pieces(same_day, ["serie_codigo"], ["data"]).groupBy(PIECE).count().collect()]
    assert len(sizes) >= 3


def test_no_window_over_a_whole_long_series(spark, capsys):
    rows = spark.createDataFrame(_rows(4), SCHEMA)
    for found in (frames.trailing_rows(rows, 5), frames.trailing_days(rows, 5)):
        found.explain()
        plan = capsys.readouterr().out
        assert "hashpartitioning(serie_codigo#" not in plan or "_lugar" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_positions(spark):
    rows = [(code, day, value or 0.0, i) for i, (code, day, value) in enumerate(_rows(5))]
    frame = spark.createDataFrame(rows, SCHEMA + ", i int")
    got = positions(frame, ["serie_codigo"], ["data", "i"]).collect()
    want, seen = {}, {}
    for code, day, _, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or DAY, r[3])):
        want[i] = seen.get(code, 0)
        seen[code] = want[i] + 1
    assert {r.i: r.posicao for r in got} == want


def test_prefix_sums(spark):
    rows = [(*r, i) for i, r in enumerate(_rows(6))]
    frame = spark.createDataFrame(rows, SCHEMA + ", i int")
    got = prefix_sums(frame, ["serie_codigo"], ["data", "i"], "valor", "antes").collect()
    want, seen = {}, {}
    for code, day, value, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or DAY, r[3])):
        want[i] = seen.get(code, 0.0)
        seen[code] = want[i] + (value or 0.0)
    assert {r.i: r.antes for r in got} == want


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_trailing_rows(spark, n, monkeypatch):
    monkeypatch.setattr(frames, "BLOCK", 10)
    rows = [(*r, i) for i, r in enumerate(_rows(7))]
    frame = spark.createDataFrame(rows, SCHEMA + ", i int")
    got = {r.i: (r.soma, r.media, r.minimo, r.maximo, r.quantidade)
           for r in frames.trailing_rows(frame, n, order=["data", "i"]).collect()}
    want, seen = {}, {}
    for code, day, value, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or DAY, r[3])):
        last = seen.setdefault(code, [])
        last.append(value)
        v = [x for x in last[-n:] if x is not None]
        want[i] = (sum(v), sum(v) / len(v), min(v), max(v), len(v)) if v else (None,) * 4 + (0,)
    assert got == want


@pytest.mark.parametrize("days", [1, 3, 30])
def test_trailing_days(spark, days):
    rows = _rows(8)
    found = frames.trailing_days(spark.createDataFrame(rows, SCHEMA), days).collect()
    want = {}
    for code, day in {(c, d) for c, d, _ in rows if d is not None}:
        v = [x for c, d, x in rows if c == code and d and x is not None and 0 <= (day - d).days < days]
        want[code, day] = (sum(v), len(v), min(v), max(v)) if v else (None, 0, None, None)
    assert {(r.serie_codigo, r.data): (r.soma, r.quantidade, r.minimo, r.maximo) for r in found} == want
    assert len(found) == len(want)


def test_running_totals(spark):
    rows = _rows(9)
    found = frames.running_totals(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in found:
        v = [x for c, d, x in rows if c == r.serie_codigo and d and d <= r.data and x is not None]
        assert (r.acumulado, r.quantidade) == (sum(v), len(v))
    assert len(found) == len({(c, d) for c, d, _ in rows if d})


def test_accumulated_months(spark):
    months = [(1, 2020, m, float(m)) for m in (1, 2, 5, 12)] + [(1, 2021, 1, 1.0), (2, 2020, 1, 9.0)]
    frame = spark.createDataFrame(months, "serie_codigo int, ano int, mes int, valor_medio double")
    got = {(r.serie_codigo, r.ano, r.mes): (r.acumulado, r.meses) for r in frames.accumulated_months(frame).collect()}
    assert got[1, 2020, 12] == (20.0, 4) and got[1, 2021, 1] == (20.0, 4)
    assert got[1, 2020, 5] == (8.0, 3) and got[2, 2020, 1] == (9.0, 1)


def test_frames_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    for found in (frames.trailing_rows(none, 3), frames.trailing_days(none, 3), frames.running_totals(none)):
        assert found.count() == 0
    with pytest.raises(ValueError):
        frames.trailing_rows(none, 0)
    with pytest.raises(ValueError):
        frames.trailing_days(none, 0)


def test_series_positions(spark):
    """Pages joined in window order: two pages of one series give one list."""
    rng = random.Random(10)
    schema = (
        "codigo int, nome string, data_ingestao string, quantidade_registros int, "
        "registros array<struct<data:string,valor:string>>, janela_inicio string, pagina long"
    )
    pages = []
    for code in (1, 1, 1, 2, None):
        for window in range(20):
            for number in range(2):
                n = rng.randrange(4)
                page = [(f"{code}-{window}-{number}-{i}", "1") for i in range(n)]
                pages.append((code, f"s{code}", f"d{len(pages) // 40}", n, page, f"2020-{window:02}", number))
    rng.shuffle(pages)
    found = series_positions(spark.createDataFrame(pages, schema)).collect()
    whole = {}
    for r in sorted(pages, key=lambda r: (r[5], r[6])):
        whole.setdefault(r[:3], []).extend(x[0] for x in r[4])
    assert len(found) == len(pages)
    for r in found:
        key = (r.codigo, r.nome, r.data_ingestao)
        start = r.posicao_inicial
        assert whole[key][start : start + r.quantidade_registros] == [x.data for x in r.registros]
        assert r.total_serie == len(whole[key])
