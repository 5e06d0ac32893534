import itertools
import zlib

import numpy as np

from lakeseries.llm import toxicity
from lakeseries.llm.toxicity import Model, _Chains, fit, score, train_and_score, training_row


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    sizes = np.array([4, 1, 6, 0, 3])
    odds = np.exp(rng.normal(size=sizes.sum()))
    model = Model(None, 0.0, -0.4, rng.normal(size=(2, 2)), None)
    chains = _Chains(sizes)
    got = np.empty(len(odds))
    got[chains.token] = chains.run(odds, model)[2]
    at = 0
    for n in sizes:
        mine = odds[at : at + n]
        weight, toxic = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=int(n)):
            w = np.prod([o if s else 1 for o, s in zip(mine, states, strict=True)])
            if n:
                w *= np.exp(model.start) if states[0] else 1
            w *= np.exp(sum(model.transition[a][b] for a, b in itertools.pairwise(states)))
            weight += w
            toxic += w * np.array(states)
        assert np.allclose(got[at : at + n], toxic / weight if n else [])
        at += n


def test_held_out_accuracy(spark):
    from lakeseries.llm.queries import op1_toxicity_crf

    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op1_toxicity_crf(spark, folder).collect()
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p for t, p in held if t) >= 0.8 * sum(t for t, _ in held)
    assert sum(p for t, p in held if not t) <= 0.005 * len(held)


def toy(spark, n=60):
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        words = [f"w{(i * 7 + j) % 23}" for j in range(12)]
        if toxic:
            words[5] = "nasty" + "xyz"[i % 3]
            words[6] = "NASTYq,"
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_spans_are_offsets_of_the_text(spark):
    model = fit(toy(spark))
    text = "é w1 w2 — nastyww NASTYqq! w3"
    docs = spark.createDataFrame([(1, text, None), (2, "w1 w2 w3", None)], "doc_id long, text string, score int")
    rows = {r.doc_id: r for r in score(docs, model).collect()}
    assert [text[s.begin : s.end] for s in rows[1].spans] == ["nastyww NASTYqq"]
    assert rows[1].score >= 0.7 > rows[2].score
    assert rows[2].spans == []


def test_labels_of_held_out_rows_do_not_matter(spark, make_docs):
    rows = toy(spark)
    docs = rows.select("doc_id", "text")
    flipped = rows.withColumn("toxic", training_row().cast("int") * rows["toxic"])
    a = {r.doc_id: r.score for r in train_and_score(docs, docs, rows.select("doc_id", "toxic")).collect()}
    b = {r.doc_id: r.score for r in train_and_score(docs, docs, flipped.select("doc_id", "toxic")).collect()}
    assert a == b


def test_odd_texts_and_no_labels(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts, "spans int, `x.y` int, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = train_and_score(docs, docs, none).collect()
    assert len(rows) == len(odd_texts)
    assert all(r.score < 0.7 and r.spans == [] for r in rows)
    only = spark.createDataFrame([(i, None, 1) for i in range(9)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")
    assert all(r.score > 0.7 for r in train_and_score(docs, docs, only).collect())
    model = fit(toy(spark))
    assert all(r.score < 0.7 for r in score(docs, model).collect())
    assert score(make_docs([]), model).count() == 0


def test_long_and_short_texts_side_by_side(spark, monkeypatch):
    model = fit(toy(spark))
    texts = ["w1 " * 500 + "nastyx", "nastyx", "", "w2 nastyz w3"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: round(r.score, 9) for r in score(docs, model).collect()}
    assert all(whole[i] == whole[i + 4] == whole[i + 8] for i in range(4))
    assert toxicity.CHAIN_BYTES > 0


def test_labels_on_long_texts_only(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 80)
    for long_label in (0, 1):
        rows = [
            (r.doc_id, r.text + " w1 w2 w3" * (20 if r.toxic == long_label else 0), r.toxic)
            for r in toy(spark).collect()
        ]
        train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        scores = {r.doc_id: r.score for r in score(train, fit(train)).collect()}
        assert all((scores[i] >= 0.5) == bool(t) for i, _, t in rows)


def test_document_scores_against_a_plain_computation(spark):
    model = fit(toy(spark))
    rows = toy(spark).collect()
    got = {r.doc_id: r.score for r in score(toy(spark), model).collect()}
    for r in rows:
        first, hashed = toxicity._hashed([r.text])
        odds = toxicity._odds((hashed % np.uint64(toxicity.SIZE)).astype(np.int64), model)
        n = len(odds)
        # Forward and backward sums over states, token by token.
        forward, backward = np.zeros((n, 2)), np.ones((n, 2))
        a = np.exp(model.transition)
        forward[0] = 1, odds[0] * np.exp(model.start)
        for t in range(1, n):
            forward[t] = forward[t - 1] @ a * (1, odds[t])
            forward[t] /= forward[t].sum()
        for t in range(n - 2, -1, -1):
            backward[t] = a @ (backward[t + 1] * (1, odds[t + 1]))
            backward[t] /= backward[t].sum()
        both = forward * backward
        marginal = both[:, 1] / both.sum(axis=1)
        clear = marginal[marginal >= toxicity.CLEAR].sum()
        x = np.array([1, marginal.max(), np.log1p(clear), np.sqrt(clear / n)])
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-(x @ model.document)))) < 1e-9


def test_telling_features_have_no_cap(spark):
    rows = [(i, " ".join(f"q{i % 5}x{j}" for j in range(400)) if i % 2 else f"w{i} w", i % 2) for i in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    _, hashed = toxicity._hashed([rows[1][1], rows[0][1]])
    among = np.unique(hashed[:, : toxicity._TELLING].view(np.int64))
    found = toxicity.telling_features(train, among)
    names = hashed[:400, 0].view(np.int64)
    assert np.isin(names, found).all() and not np.isin(hashed[400:, 0].view(np.int64), found).any()
