import collections
import random

import numpy as np
import pytest

from lakeseries.llm import minhash
from lakeseries.llm.components import components
from lakeseries.llm.minhash import dart_signatures, near_duplicates


def brute_force(rows):
    bags = []
    for _, text in rows:
        w = (text or "").lower().split()
        n = max(1, len(w) - 4) if w else 0
        bags.append(collections.Counter(tuple(w[i : i + 5]) for i in range(n)))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common, whole = (bags[a] & bags[b]).total(), (bags[a] | bags[b]).total()
            if common and common >= 0.8 * whole:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for i, (name, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), name), name)
    return {name: low[find(i)] for i, (name, _) in enumerate(rows)}


def test_near_copies(make_docs):
    rng = random.Random(4)
    rows = []
    for _ in range(12):
        base = [rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(120)]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            rows.append((1000 - len(rows), " ".join(copy)))
    rows += [(1, "short text"), (2, "Short  TEXT"), (3, "other text"), (4, "a a a a a a a"), (5, "a a a a a a")]
    found = near_duplicates(make_docs(rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == brute_force(rows)
    sizes = collections.Counter(r.class_id for r in found)
    assert all(r.class_size == sizes[r.class_id] for r in found)


@pytest.mark.parametrize("items", [500_000, 700])
def test_a_chain_is_one_class(make_docs, monkeypatch, items):
    monkeypatch.setattr(minhash, "BLOCK_ITEMS", items)
    words = [f"w{i}" for i in range(200)]
    rows = [(i * 7 % 31, " ".join(words[4 * i : 4 * i + 100])) for i in range(24)]
    found = near_duplicates(make_docs(rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == brute_force(rows)


def test_odd_texts(make_docs, odd_texts):
    rows = [(10 + i, t) for i, t in enumerate(odd_texts)] + [(None, "one"), (13, "one")]
    found = near_duplicates(make_docs(rows, "node int, id string, class_id int")).collect()
    assert len(found) == len(rows)
    classes = {(r.doc_id, r.class_id) for r in found}
    assert {(10, 10), (11, 11), (12, 12), (13, 13), (14, 13), (15, 15), (16, 15), (None, None)} <= classes
    assert {r.class_size for r in found if r.class_id == 13} == {3}


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0


def test_darts_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 63, 130).astype(np.uint64)
    elements = np.concatenate([pool[:100], pool[30:130]])  # 70 of 130 in common
    darts = dart_signatures(elements, np.array([0, 100, 200]), 4_000)
    assert abs((darts[0] == darts[1]).mean() - 70 / 130) < 0.03


def test_darts_do_not_depend_on_other_texts():
    pool = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    alone = dart_signatures(pool[:3], np.array([0, 3]), 64)
    mixed = dart_signatures(np.concatenate([pool[5:], pool[:3]]), np.array([0, 54, 54, 57]), 64)
    assert (alone[0] == mixed[2]).all()


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
