import hashlib
import sys
import random

import public_tokenizers
import pytest
import tiktoken

from lakeseries.llm.bpe import _Ids, decode, encode, merge, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def random_texts():
    rng = random.Random(6)
    alphabet = "abcdefg hij'st\n\t\x1c\x85 　é東💥0123²٣!?#<|endoftext|>'re'll"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    return [*texts, "a" * 5_000, "ab" * 3_000, " " * 2_000, "<|endoftext|>"]


def test_as_the_public_library(make_docs, public, odd_texts):
    texts = random_texts() + odd_texts
    docs = make_docs(texts, "ids string, decoded int, _row int").drop("_row")
    rows = decode(encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        plain = texts[r.doc_id] or ""
        assert list(r.ids) == public.encode_ordinary(plain)
        assert bytes(r.decoded) == plain.encode()


def test_empty_table(make_docs):
    assert decode(encode(make_docs([]), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_ties_take_the_leftmost_pair():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aab": 3}
    assert merge(b"aaab", ranks) == [2, 0, 1]
    assert merge(b"aab", {k: v for k, v in ranks.items() if k != b"aab"}) == [2, 1]


def test_known_matches_change_nothing(ranks, monkeypatch):
    monkeypatch.setattr("lakeseries.llm.bpe._CACHED", 3)
    ids = _Ids(ranks)
    pieces = [f" word{i % 7}" for i in range(40)]
    assert [ids[p] for p in pieces] == [tuple(merge(p.encode(), ranks)) for p in pieces]
    assert len(ids) <= 3


def test_query_digests(spark, public):
    from lakeseries.llm.queries import op2_byte_bpe

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op2_byte_bpe(spark, folder).collect():
        ids = public.encode_ordinary(texts[r.doc_id])
        joined = " ".join(map(str, ids)).encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(joined).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_known_matches_stay_small():
    ids = _Ids({bytes([i]): i for i in range(256)})
    for i in range(500_000):
        ids[f"{i:06}"]
    known = [*ids.items(), *ids._old.items()]
    assert sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in known) < 50_000_000
