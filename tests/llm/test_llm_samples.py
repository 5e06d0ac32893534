from pyspark.sql import functions as F

from lakeseries.llm.samples import draw_texts


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_short_texts_come_first_by_their_draw(spark):
    rows = table(spark, [f"text {i}" for i in range(300)] + ["x" * 101] * 5)
    drawn = draw_texts(rows, 40, 100)
    every = rows.where("doc_id < 300").select(F.xxhash64("doc_id", "text").alias("d"), "text").collect()
    assert [(r.draw, r.text) for r in drawn] == sorted((r.d, r.text) for r in every)[:40]
    again = draw_texts(rows.repartition(7, "text"), 40, 100)
    assert again == drawn


def test_the_shortest_of_long_texts_fill_up(spark):
    rows = table(spark, ["a", None, "x" * 300, "x" * 200, "x" * 260, "x" * 900])
    assert [len(r.text) for r in draw_texts(rows, 4, 100)][2:] == [200]  # 400 characters at most
    assert sorted(len(r.text) for r in draw_texts(rows, 6, 1_000)) == [0, 1, 200, 260, 300, 900]
    assert [len(r.text) for r in draw_texts(rows.where("doc_id = 5"), 3, 100)] == [900]
    assert draw_texts(rows.limit(0), 3, 100) == []


def test_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "same")] * 50 + [(i, "own") for i in range(9)], "doc_id long, text string")
    assert len(draw_texts(rows, 59, 10)) == 59
    assert len(draw_texts(rows, 20, 10)) == 20
