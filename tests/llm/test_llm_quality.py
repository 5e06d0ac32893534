import numpy as np

from lakeseries.llm import quality
from lakeseries.llm.quality import Model, fit, rate


def graded(spark, n=90):
    kinds = ["a plain sentence of words", "SOME SHOUTING %%% words", "|||| $$$$ #### ****"]
    rows = [(i, f"{kinds[i % 3]} {kinds[i % 3]} w{i}", 2 - i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, grade int")


def test_grades_are_ordered(spark):
    rated = graded(spark)
    model = fit(rated)
    assert (np.diff(model.thresholds) > 0).all()
    rows = rate(rated, model).collect()
    for r in rows:
        assert len(r.tails) == 2 and 1 >= r.tails[0] >= r.tails[1] >= 0
        assert abs(r.expected_grade - sum(r.tails)) < 1e-12
        assert round(r.expected_grade) == r.grade


def test_missing_grades_and_no_ratings(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts, "tails int, Expected_Grade int, grade int")
    none = fit(graded(spark).where("grade > 5"))
    assert all(r.tails == [] and r.expected_grade == 0 for r in rate(docs, none).collect())
    only = fit(graded(spark).where("grade = 2"))
    assert all(r.expected_grade > 1.99 for r in rate(docs, only).collect())
    gap = fit(graded(spark).where("grade <> 1"))
    for r in rate(docs, gap).collect():
        assert abs(r.tails[0] - r.tails[1]) < 1e-12
    assert rate(make_docs([]), gap).count() == 0
    assert len(rate(docs, fit(graded(spark))).collect()) == len(odd_texts)


def test_empty_texts_have_no_weight(make_docs):
    model = Model(np.ones(1 << 16), np.array([0.0]))
    rows = rate(make_docs([None, "", " \n"]), model).collect()
    assert [r.tails for r in rows] == [[0.5]] * 3


def test_held_out_accuracy(spark):
    from lakeseries.llm.queries import op9_ordinal_quality

    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op9_ordinal_quality(spark, folder).collect()
    assert len(rows) == 10_000
    held = [(labels[r.doc_id], r.keep) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([bool(q) == k for q, k in held]) > 0.98
    assert np.mean([k for q, k in held if q]) > 0.99


def test_grades_on_long_texts_only(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_CHARS", 40)
    rows = [(r.doc_id, r.text * (1 + 4 * (r.grade == 1)), r.grade) for r in graded(spark).collect()]
    rated = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    found = rate(rated, fit(rated)).collect()
    assert np.mean([round(r.expected_grade) == r.grade for r in found]) > 0.9


def test_expected_grades_of_held_out_rows(spark):
    """Both thresholds order grades on rows that the model has not seen."""
    from lakeseries.llm.queries import op9_ordinal_quality

    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null").collect()
    grade = {r.doc_id: 0 if not r.quality else 1 if r.toxic else 2 for r in rows}
    found = [(grade[r.doc_id], r.expected_grade) for r in op9_ordinal_quality(spark, folder).collect()
             if r.held_out and r.doc_id in grade]
    mean = [np.mean([e for g, e in found if g == k]) for k in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]
    assert mean[0] < 0.3 and mean[2] > 1.6
