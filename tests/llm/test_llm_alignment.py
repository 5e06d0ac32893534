"""Aligned tokens against a plain computation with both libraries."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

import lakeseries.llm.alignment as alignment
from lakeseries.llm.alignment import _Pair, align, byte_alphabet, parts, with_scores

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    a = tokenizers.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def _plain(models, text):
    """Groups and links of one text."""
    a, b = models
    if not text:
        return [], []
    byte = byte_alphabet()
    whole = (" " + text).encode()
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids]
    b_ids = b.encode(text)
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:5], 16)])
        if b.is_byte(i)
        else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], []

    groups, links, left, right, i, j = [], [], [], [], 0, 0
    a_at = b_at = 0
    while i < len(a_ids):
        left.append(a_ids[i])
        a_at += len(a_bytes[i])
        i += 1
        while b_at < a_at:
            right.append(b_ids[j])
            b_at += len(b_bytes[j])
            j += 1
        if a_at == b_at:
            groups.append((left, right))
            links.append((left[-1], right[-1]))
            left, right = [], []
    return groups, links


def _brute(models, texts):
    each = [_plain(models, t) for t in texts]
    counts = Counter(link for _, links in each for link in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for groups, links in each:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(counts[link] == most[link[1]] for link in links),
                sum(counts[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return out


TEXTS = [
    "The quick brown fox", "The quick brown fox", "a", " ", "\n\n x\t", "  two  spaces ", "it's we'll",
    "<s> </s> <unk> <|endoftext|> <0x41>", "naïve über Straße", "東京 日本語テキスト", "ﬁ ² ①", "👩‍👩‍👧 🇧🇷", "a\x00b",
    "▁under", "é", " nbsp", "Привет мир, как дела", "x" * 3000, None, "", None,
]


def _rows(frame):
    aligned = align(frame, A_PATH, B_PATH)
    found = with_scores(aligned.withColumn("n_links", F.size("links")))
    return [
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
         hashlib.sha256(r.groups.encode()).hexdigest())
        for r in found.collect()
    ]


@pytest.mark.parametrize("lookup", [0, 1 << 40])
def test_equals_plain_computation(spark, make_docs, models, odd_texts, lookup, monkeypatch):
    monkeypatch.setattr(alignment, "LOOKUP", lookup)
    texts = TEXTS + odd_texts[:6]
    want = [(i, *row) for i, row in enumerate(_brute(models, texts))]
    frame = make_docs(texts, extra="links string, n_best string, groups long, _name string")
    assert sorted(_rows(frame)) == want


def test_shared_and_missing_ids(spark, make_docs, models):
    rows = [(1, "one two"), (1, "one two"), (1, "three"), (None, "one"), (None, None)]
    want = sorted(((i, *r) for (i, _), r in zip(rows, _brute(models, [t for _, t in rows]))), key=repr)
    assert sorted(_rows(make_docs(rows)), key=repr) == want


def test_one_pair_in_most_links(spark, make_docs, models, monkeypatch):
    monkeypatch.setattr(alignment, "LOOKUP", 0)
    monkeypatch.setattr(alignment, "_PARTIAL", 2)
    texts = ["the the the the " * 50 + f"word{i}" for i in range(60)]
    assert sorted(_rows(make_docs(texts))) == [(i, *r) for i, r in enumerate(_brute(models, texts))]


def test_empty_table(spark, make_docs):
    assert _rows(make_docs([])) == []


def test_both_encoders_of_a_agree(models):
    """Every character, beside letters, digits and blanks; and long runs."""
    pair = _Pair(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read())
    assert pair._ranked is not None
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{c}b {c} 1{c}{c}\n" for c in chars[i : i + 500]) for i in range(0, len(chars), 500)]
    texts += [" " * 200_000 + "x", "\n " * 100_000, "a" * 100_000, " 東京" * 20_000]
    for text in texts:
        assert pair._encode_a(text) == models[0].encode(text, add_special_tokens=False).ids


def test_parts_of_long_texts_are_encoded_alone(models, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 7)
    rng = random.Random(4)
    a, b = models
    bits = ["it's", " ", "  ", "\n", "don't", "ü", "Привет", "x1", "2", "don't a", "東京", ".", "we'll", " end", "ﬁn", "é b"]
    pair = _Pair(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read())
    n = 0
    for _ in range(300):
        text = " " + "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(40))
        cut = parts(text)
        assert "".join(cut) == text
        n += len(cut)
        left, right = pair.encode(cut)
        assert sum(left, []) == a.encode(text, add_special_tokens=False).ids
        assert sum(right, []) == b.encode(text[1:])
    assert n > 2000
