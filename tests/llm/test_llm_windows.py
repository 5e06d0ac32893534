import collections
import random
import re

import numpy as np
import pyarrow as pa

from lakeseries.llm.vectors import exact_classes
from lakeseries.llm.windows import _kept_words, repeated_windows


def brute_force(texts, window):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    counts = collections.Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    out = []
    for w in split:
        stay = [True] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                stay[i : i + window] = [False] * window
        kept = [x for x, s in zip(w, stay, strict=True) if s]
        out.append((len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return out


def check(docs, texts, window, gram):
    rows = repeated_windows(docs, window=window, gram=gram).collect()
    found = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in rows)
    assert found == sorted((i, *x) for i, x in enumerate(brute_force(texts, window)))


def test_random_texts(make_docs):
    rng = random.Random(1)
    gaps = [" ", "\n", "\t ", "\x0b", "  "]
    parts = [" ".join(rng.choice("abcde") for _ in range(9)) for _ in range(6)]
    texts = []
    for _ in range(60):
        words = [rng.choice([*parts, *"abcdefghij"]) for _ in range(rng.randint(0, 30))]
        texts.append("".join(w + rng.choice(gaps) for w in words))
    check(make_docs(texts), texts, 6, 2)


def test_odd_texts(make_docs, odd_texts):
    check(make_docs(odd_texts), odd_texts, 35, 3)


def test_separators_are_the_six_bytes_only(make_docs):
    texts = ["a\x1cb c d e\x85f"]
    check(make_docs(texts), texts, 2, 1)


def test_repeated_rows_repeat_each_other(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = repeated_windows(make_docs([(7, text), (7, text), (None, text + " tail")])).collect()
    assert [(r.n_removed, r.kept_text) for r in rows if r.doc_id == 7] == [(40, "")] * 2
    assert [(r.n_removed, r.kept_text) for r in rows if r.doc_id is None] == [(40, "tail")]


def test_same_id_with_other_texts(make_docs):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = repeated_windows(make_docs([(1, a), (1, b), (2, "pre " + a)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 40), (2, 40)]


def test_empty_table_and_clashing_columns(make_docs):
    docs = make_docs([], "n_words int, _row int, bucket string")
    assert repeated_windows(docs).count() == 0
    docs = make_docs(["a b c"], "N_Words int, _id int, _gone string, `a.b` int")
    row = repeated_windows(docs).collect()[0]
    assert (row.n_words, row["_id"], row["a.b"], row.kept_text) == (3, None, None, "a b c")


def test_collisions_of_hashes_join_nothing():
    text = np.frombuffer(b"abcabdabcx", np.uint8)
    starts, lengths = np.array([0, 3, 6, 9]), np.array([3, 3, 3, 1])
    classes = exact_classes(text, starts, lengths, np.zeros(4, np.uint64))
    assert classes[0] == classes[2]
    assert len(set(classes.tolist())) == 3


def test_kept_words_come_in_slices():
    rows = pa.array([{"text": "a b c " * 50_000}] * 8)
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    gone = pa.array([[{"lo": 0, "hi": 2}], None] * 4, kind)
    batch = pa.RecordBatch.from_arrays([rows, gone], ["_row", "_gone"])
    out = list(_kept_words("text")(iter([batch])))
    assert len(out) > 1 and max(len(b) for b in out) <= 3
    assert [n for b in out for n in b.column("n_removed").to_pylist()] == [2, 0] * 4
    assert {n for b in out for n in b.column("n_words").to_pylist()} == {150_000}
