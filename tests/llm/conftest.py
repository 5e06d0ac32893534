import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from texts, or from (id, text) pairs; all other columns null."""

    def make(texts, extra=""):
        rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        n = len(extra.split(",")) if extra else 0
        schema = SCHEMA + (", " + extra if extra else "")
        return spark.createDataFrame([(*r, None, None, None) + (None,) * n for r in rows], schema)

    return make


@pytest.fixture
def odd_texts():
    """Nulls, empty and blank texts, repeats, one word, and a long text."""
    rng = random.Random(3)
    words = ["uno", "dos", "über", "naïve", "x", "東京", "end."]
    long = " ".join(rng.choice(words) for _ in range(20_000))
    return [None, "", " \t\n", "one", "one", long, long, "ü" * 5_000, None]
