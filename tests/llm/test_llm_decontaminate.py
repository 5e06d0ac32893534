import itertools
import random

import pytest

from lakeseries.llm import shingled
from lakeseries.llm.decontaminate import benchmark_overlaps, without_overlaps

ITEM = [f"item{i}" for i in range(16)]


@pytest.fixture
def benchmark(spark):
    rows = [(1, " ".join(ITEM)), (1, " ".join(ITEM)), (2, "too short to be evidence"), (3, None),
            (None, " ".join(f"other{i}" for i in range(13)))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_every_pattern_of_three_substitutions_is_found(make_docs, benchmark):
    texts, wanted = [], {}
    for k in (0, 3, 4):
        for gone in itertools.combinations(range(13), k):
            words = [f"x{i}" if i in gone else w for i, w in enumerate(ITEM[:13])]
            text = f"Before, the: {', '.join(words).title()}. After"
            if k < 4 or gone[0] % 5 == 0:
                wanted[len(texts)] = 13 - k if k < 4 else None
                texts.append(text)
    found = {r.doc: r.matched for r in benchmark_overlaps(make_docs(texts), benchmark).collect()}
    assert found == {i: m for i, m in wanted.items() if m}


def test_blocks_of_seeds_change_nothing(make_docs, benchmark, monkeypatch):
    docs = make_docs(["a " + " ".join(ITEM), "nothing", " ".join(ITEM[3:]) + " b"])
    whole = sorted(map(tuple, benchmark_overlaps(docs, benchmark).collect()))
    assert [(r[0], r[2], r[3]) for r in whole] == [(0, 1, 13), (2, 1, 13)]
    monkeypatch.setattr(shingled, "ROWS_AT_ONCE", 9)
    assert sorted(map(tuple, benchmark_overlaps(docs, benchmark).collect())) == whole


def test_blocks_are_bounded_where_items_share_a_seed(spark, make_docs, monkeypatch):
    monkeypatch.setattr(shingled, "ROWS_AT_ONCE", 100)
    few = spark.range(1_000).selectExpr("id as item", "7L as seed")
    many = spark.createDataFrame([(1, 7), (2, 8)], "doc long, seed long")
    sizes = []
    monkeypatch.setattr(shingled.F, "broadcast", lambda block: sizes.append(block.count()) or block)
    found = shingled.meet(many, few, "seed").collect()
    assert sorted((r.doc, r.item) for r in found) == [(1, i) for i in range(1_000)]
    assert len(sizes) == 10 and sum(sizes) == 1_000 and max(sizes) < 200


def test_items_without_an_id_are_found(make_docs, benchmark):
    leak = "a " + " ".join(f"other{i}" for i in range(13)) + " b"
    docs = make_docs([(1, leak), (None, leak), (2, "clean")])
    found = benchmark_overlaps(docs, benchmark).collect()
    assert sorted(((r.doc, r.item_id, r.matched) for r in found), key=repr) == [
        (1, None, 13), (None, None, 13),
    ]
    assert [r.doc_id for r in without_overlaps(docs, benchmark).collect()] == [2]


def test_clean_rows_stay_as_they_are(make_docs, benchmark, odd_texts):
    leak = " ".join(ITEM)
    rows = [*enumerate(odd_texts), (50, leak), (50, "clean"), (50, leak), (None, leak), (None, "clean")]
    docs = make_docs(rows, "doc int, variant int, hashed int, lies int")
    kept = without_overlaps(docs, benchmark)
    assert kept.columns == docs.columns
    expected = [*enumerate(odd_texts), (50, "clean"), (None, "clean")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_tables(make_docs, benchmark):
    assert without_overlaps(make_docs([]), benchmark).count() == 0
    assert without_overlaps(make_docs(["a"]), benchmark.limit(0)).count() == 1


def test_no_python_in_the_plan(make_docs, benchmark):
    plan = benchmark_overlaps(make_docs(["a"]), benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_items_are_compared_whole(spark, make_docs):
    items = [(1, "alpha beta gamma delta epsilon zeta"), (2, "Alpha beta gamma delta epsilon"), (3, "yes"),
             (4, "no way"), (5, " ".join(ITEM[:12])), (6, "..."), (None, "one two three four five")]
    few = spark.createDataFrame(items, "item_id long, text string")
    texts = ["so alpha, beta gamma delta epsilon zeta it is", "alpha beta gamma delta epsilon", "YES!",
             "yes and no way", "no way", " ".join(["x", *ITEM]), " ".join([*ITEM[:6], "x", *ITEM[7:]]),
             "alpha beta gamma delta x epsilon zeta", "One two three four five six", "", None]
    found = benchmark_overlaps(make_docs(texts), few).collect()
    assert sorted(((r.doc, r.item_id, r.matched) for r in found), key=repr) == sorted(
        [(0, 1, 6), (0, 2, 5), (1, 2, 5), (2, 3, 1), (4, 4, 2), (5, 5, 12), (8, None, 5)], key=repr
    )
    kept = without_overlaps(make_docs(texts), few).collect()
    assert sorted(r.doc_id for r in kept) == [3, 6, 7, 9, 10]


def test_short_items_equal_sql(spark, make_docs):
    import duckdb
    import pyarrow as pa

    from lakeseries.llm.oracles import ORACLES

    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(18))) for _ in range(150)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(1 + i % 16))) for i in range(48)]
    few = spark.createDataFrame(items, "item_id long, text string")
    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": list(range(150)), "text": texts}))
    connection.register("benchmark", pa.table({"item_id": [i for i, _ in items], "text": [x for _, x in items]}))
    want = connection.execute(ORACLES["op4_spaced_seeds"]).fetchall()
    found = benchmark_overlaps(make_docs(texts), few).collect()
    assert sorted((r.doc, r.item_id, r.matched) for r in found) == sorted(want)
    assert len({i % 16 for _, i, _ in want}) > 10
