"""Different texts that share an id stay apart, also where short hashes of them are equal."""

import collections

import pytest
import xxhash

import lakeseries.llm.superkmers as superkmers
from lakeseries.llm.suffixes import without_repeats
from lakeseries.llm.windows import repeated_windows


@pytest.fixture(scope="module")
def colliding():
    """Two texts of 40 words whose hashes end in the same 32 bits."""
    seen = {}
    for i in range(1_000_000):
        text = " ".join(f"w{i}x{j}" for j in range(40))
        short = xxhash.xxh64_intdigest(text.encode(), 42) & 0xFFFFFFFF
        if short in seen:
            return seen[short], text
        seen[short] = text
    raise AssertionError("no collision found")


@pytest.mark.parametrize("shared", [None, 7])
def test_only_the_repeated_text_is_removed(make_docs, colliding, shared):
    copied, unique = colliding
    docs = make_docs([(shared, copied), (shared, unique), (1, copied), (2, "other words")])
    words = {(r.doc_id, r.kept_text): r.n_removed for r in repeated_windows(docs).collect()}
    assert words == {(shared, ""): 40, (shared, unique): 0, (1, ""): 40, (2, "other words"): 0}
    found = [(r.doc_id, bytes(r.kept_bytes)) for r in without_repeats(docs).collect()]
    assert collections.Counter(found) == collections.Counter(
        [(shared, b""), (shared, unique.encode()), (1, copied.encode()), (2, b"other words")]
    )


def test_short_names_where_they_do(make_docs, colliding):
    def key(pairs):
        rows = make_docs(pairs).selectExpr("struct(doc_id, text) as _row")
        keyed, _ = superkmers.with_key(rows, "_row.doc_id", "_row.text")
        return {r._variant for r in keyed.collect()}

    copied, unique = colliding
    assert max(key([(1, copied), (2, unique), (2, None), (3, ""), (3, "")])) < 1 << 32
    wide = key([(1, copied), (1, unique)])
    assert len(wide) == 2 and any(not 0 <= x < 1 << 32 for x in wide)
