"""Differences of two snapshots against plain dictionaries."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.errors import PySparkException

from lakeseries.operators.snapshots import (
    changed_blocks,
    read_snapshot,
    snapshot_changes,
    write_snapshot,
)
from lakeseries.schemas import SILVER_SCHEMA

DAY = dt.date(2020, 1, 1)


def _state(seed, n=150):
    rng = random.Random(seed)
    state = {}
    for _ in range(n):
        day = None if rng.random() < 0.02 else DAY + dt.timedelta(rng.randrange(120))
        code = rng.choice([1, 1, 1, 2, None])
        state[code, day] = (f"s{code}", None if rng.random() < 0.1 else float(rng.randrange(4)))
    return state


def _table(spark, state):
    rows = [(code, name, day, value) for (code, day), (name, value) in state.items()]
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def _plain(before, after):
    out = []
    for key in before.keys() | after.keys():
        old, new = before.get(key), after.get(key)
        if old != new:
            kind = "inserido" if old is None else "removido" if new is None else "alterado"
            out.append((*key, kind, *(old or (None, None)), *(new or (None, None))))
    return sorted(out, key=repr)


def _changes(spark, before, after):
    found = snapshot_changes(spark, before, after, SILVER_SCHEMA)
    return sorted(
        ((r.serie_codigo, r.data, r.mudanca, r.serie_nome_antes, r.valor_antes, r.serie_nome_depois,
          r.valor_depois) for r in found.collect()),
        key=repr,
    )


@pytest.mark.parametrize("slices", [1, 3])
def test_changes(spark, tmp_path, slices):
    states = [_state(1), _state(2), {}]
    folders = [write_snapshot(_table(spark, s), str(tmp_path), slices=slices) for s in states]
    for one in range(3):
        for two in range(3):
            assert _changes(spark, folders[one], folders[two]) == _plain(states[one], states[two])
    assert read_snapshot(spark, folders[0], SILVER_SCHEMA).count() == len(states[0])


def test_equal_blocks_are_not_read(spark, tmp_path):
    before = _state(3)
    after = dict(before)
    after[1, dt.date(2020, 2, 10)] = ("s1", 99.0)
    after[9, dt.date(2021, 1, 1)] = ("s9", 1.0)
    folders = [write_snapshot(_table(spark, s), str(tmp_path)) for s in (before, after)]
    blocks = {r["_bloco"] for r in changed_blocks(spark, *folders).collect()}
    assert blocks == {2020 * 12 + 2, 2021 * 12 + 1}
    # A file that is opened fails the job.
    for folder in folders:
        for file in pathlib.Path(folder, "linhas").glob("_bloco=*/*.parquet"):
            if int(file.parent.name.split("=")[1]) not in blocks:
                file.write_bytes(b"broken")
                file.with_name(f".{file.name}.crc").write_bytes(b"")
    assert _changes(spark, *folders) == _plain(before, after)


def test_same_rows_written_twice_are_equal(spark, tmp_path):
    table = _table(spark, _state(4))
    folders = [write_snapshot(table.repartition(n), str(tmp_path)) for n in (1, 7)]
    assert changed_blocks(spark, *folders).count() == 0
    assert _changes(spark, *folders) == []


def test_a_row_more_is_a_change_and_a_repeated_key_an_error(spark, tmp_path):
    table = _table(spark, {(1, DAY): ("s1", 1.0)})
    folders = [write_snapshot(t, str(tmp_path)) for t in (table, table.unionByName(table))]
    assert changed_blocks(spark, *folders).count() == 1
    with pytest.raises(PySparkException, match="several rows"):
        _changes(spark, *folders)


def test_a_value_that_moves_between_columns_is_a_change(spark, tmp_path):
    schema = "serie_codigo int, data date, a double, b double"
    rows = [[(1, DAY, 5.0, None)], [(1, DAY, None, 5.0)]]
    folders = [write_snapshot(spark.createDataFrame(r, schema), str(tmp_path)) for r in rows]
    found = snapshot_changes(spark, *folders, spark.createDataFrame(rows[0], schema).schema)
    assert [r["mudanca"] for r in found.collect()] == ["alterado"]


def test_rows_fold_before_the_shuffle(spark, tmp_path):
    folders = [write_snapshot(_table(spark, _state(s)), str(tmp_path)) for s in (5, 6)]
    found = snapshot_changes(spark, *folders, SILVER_SCHEMA)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bloco" in plan and "FullOuter" not in plan
    assert "partial_first" in plan
