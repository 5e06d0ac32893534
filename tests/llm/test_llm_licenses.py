import collections
import random

import regex

from lakeseries.llm.licenses import (
    BANDS,
    LONG,
    TEMPLATES,
    _bands,
    _windows,
    license_notices,
    templates,
)
from lakeseries.llm.shingled import hashes, words


def shingles(text):
    w = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_force(rows):
    out = {}
    for name, text in rows:
        have = shingles(text)
        for license_, notice in TEMPLATES:
            parts = shingles(notice)
            share = len(have & parts) / len(parts)
            if share >= 0.8:
                out[name, license_] = max(share, out.get((name, license_), 0))
    return out


def test_every_notice_at_every_place(spark, make_docs):
    texts = []
    for _, notice in TEMPLATES:
        for shift in range(9):
            head = " ".join(f"head{i}" for i in range(shift))
            texts.append(f"{head}\n{notice.upper() if shift % 2 else notice}\ntail of the text follows here now")
    words = TEMPLATES[2][1].split()
    texts.append(" ".join(words[:20] + ["changed"] + words[21:]))
    texts.append(" ".join(words[:20]))
    rows = list(enumerate(texts))
    found = license_notices(make_docs(rows), templates(spark)).collect()
    assert {(r.doc, r.license): r.containment for r in found} == brute_force(rows)
    assert collections.Counter(r.doc for r in found)[len(texts) - 1] == 0


def test_five_words_among_any_neighbours(spark, make_docs):
    rng = random.Random(11)
    notices = ["Released under the BSD License.", "Released under the MIT License."]
    texts = []
    for i in range(4_000):
        head, tail = ([f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (4 + i % 4, 8))
        texts.append(" ".join([*head, notices[i // 4 % 2], *tail]))
    found = license_notices(make_docs(texts), templates(spark)).collect()
    assert {(r.doc, r.license): r.containment for r in found} == brute_force(enumerate(texts))
    assert len(found) == len(texts)


def test_edited_copies_of_long_notices(spark, make_docs):
    rng = random.Random(12)
    texts = []
    for _, notice in TEMPLATES:
        whole = notice.split()
        if len(shingles(notice)) < LONG:
            continue
        for shift in range(24):
            part = list(whole)
            for _ in range(rng.randrange(1 + len(part) // 25)):
                at = rng.randrange(len(part))
                part[at : at + rng.randrange(2)] = ["edited"] * rng.randrange(2)
            cut = rng.randrange(1 + len(part) // 8)
            part = part[cut:] if shift % 2 else part[: len(part) - cut]
            texts.append(" ".join([f"h{i}" for i in range(shift % 5)] + part + ["the", "end"]))
    found = license_notices(make_docs(texts), templates(spark)).collect()
    want = brute_force(enumerate(texts))
    assert {(r.doc, r.license): r.containment for r in found} == want
    assert len(texts) // 2 < len(want)


def test_bands_are_min_wise(spark):
    rows = []
    for i in range(2_000):
        common = [f"w{i}x{j}" for j in range(7)]
        rows += [(i, 0, " ".join([f"a{i}", *common])), (i, 1, " ".join([*common, f"b{i}"]))]
    table = spark.createDataFrame(rows, "pair int, side int, text string")
    table = table.withColumn("hashed", hashes(words("text")))
    keys = {}
    for r in _bands(_windows(table, ["pair", "side"], 4), ["pair", "side"]).collect():
        keys.setdefault((r.pair, r.side), set()).add(r.key)
    met = [len(keys[i, 0] & keys[i, 1]) for i in range(2_000)]
    assert abs(sum(met) / len(met) / BANDS - 0.36) < 0.02  # likeness 3/5, two orders a band
    assert abs(sum(m > 0 for m in met) / len(met) - (1 - 0.64**BANDS)) < 0.02


def test_odd_texts(spark, make_docs, odd_texts):
    mit = "Released under the MIT License."
    rows = [*enumerate(odd_texts), (40, mit), (40, mit), (None, mit), (41, mit.replace(" ", "　"))]
    docs = make_docs(rows, "license string, variant int, template int")
    found = license_notices(docs, templates(spark)).collect()
    assert sorted((str(r.doc), r.license) for r in found) == [("40", "MIT"), ("41", "MIT"), ("None", "MIT")]


def test_empty_tables(spark, make_docs):
    assert license_notices(make_docs([]), templates(spark)).count() == 0
    assert license_notices(make_docs(["a b c d e"]), templates(spark).limit(0)).count() == 0


def test_no_python_in_the_plan(spark, make_docs):
    notices = spark.createDataFrame([(0, "X", "a b c d e f")], "template int, license string, text string")
    plan = license_notices(make_docs(["a"]), notices)._jdf.queryExecution().toString()
    assert "mapInArrow" not in plan and "PythonUDF" not in plan
