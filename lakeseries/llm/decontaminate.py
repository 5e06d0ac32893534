"""Passages of a benchmark in documents, found by spaced seeds.

A seed is the hash of the words at the marked places of a mask; unmarked places
are ignored, so a substituted word there does no harm. Seeds of documents and of
benchmark items are joined. A hit fixes how the item lies on the document; the
words of both are then compared there, and a window of the item with enough
equal words is a finding.

The three masks are chosen so that every window of 13 words with at most three
substitutions, wherever they are, holds a whole seed: no such passage is missed.

Items shorter than a window have too few words for substitutions. Their seed is the
whole item, compared exactly; items of fewer than ``WHOLE`` words, which any text may
hold, count only as the whole of a document.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeseries.llm.shingled import hashes, keyed, meet, words

WINDOW = 13
SUBSTITUTIONS = 3
MASKS = ("110111", "111011", "1101000011")
WHOLE = 5


def _places(masks: tuple[str, ...]) -> int:
    return max(map(len, masks))


def _seeds(rows: DataFrame, masks: tuple[str, ...], keep: list[str]) -> DataFrame:
    """``at`` (first word) and ``seed`` of every mask at every place of ``hashed``."""
    span = _places(masks)
    size = F.size("hashed")
    shifted = F.arrays_zip(
        F.sequence(F.lit(0), size - 1).alias("at"),
        *[
            (F.slice("hashed", i + 1, F.greatest(size, F.lit(1)))).alias(f"w{i}")
            for i in range(span)
        ],
    )
    places = rows.where(size > 0).select(*keep, F.inline(shifted))
    marked = [[F.col(f"w{i}") for i, x in enumerate(mask) if x == "1"] for mask in masks]
    seeds = [
        F.when(cols[-1].isNotNull(), F.xxhash64(F.lit(number), *cols))
        for number, cols in enumerate(marked)
    ]
    found = places.select(*keep, "at", F.explode(F.array(*seeds)).alias("seed"))
    return found.where("seed is not null")


def _whole_seed(lengths: list[int]) -> Column:
    """The seed that ``_seeds`` gives an item of one of ``lengths`` for the mask of all its words."""
    return F.coalesce(
        *[
            F.when(F.size("hashed") == n, F.xxhash64(F.lit(i), *[F.get("hashed", F.lit(j)) for j in range(n)]))
            for i, n in enumerate(lengths)
        ]
    )


def _short_hits(hashed: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc``, ``variant``, ``item``, ``shift`` of items of fewer words than a window."""
    inside = [n for n in lengths if n >= WHOLE]
    alone = F.xxhash64(F.lit(-1), "hashed")
    of = ["doc", "variant"]
    parts = []
    if inside:
        seeds = items.where(F.size("hashed") >= WHOLE).select("item", _whole_seed(inside).alias("seed"))
        doc_seeds = _seeds(hashed, tuple("1" * n for n in inside), of)
        parts.append(meet(doc_seeds, seeds, "seed").select(*of, "item", F.col("at").alias("shift")))
    if len(inside) < len(lengths):
        seeds = items.where(F.size("hashed") < WHOLE).select("item", alone.alias("seed"))
        texts = hashed.where(F.size("hashed").between(1, WHOLE - 1)).select(*of, alone.alias("seed"))
        parts.append(meet(texts, seeds, "seed").select(*of, "item", F.lit(0).alias("shift")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _best_window(equal: Column, window: int) -> Column:
    """The most equal words in any ``window`` neighbours of an array of flags."""
    starts = F.sequence(F.lit(1), F.size(equal) - window + 1)
    return F.array_max(
        F.transform(starts, lambda s: F.size(F.filter(F.slice(equal, s, window), lambda x: x)))
    )


def benchmark_overlaps(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id",
    window: int = WINDOW, substitutions: int = SUBSTITUTIONS, masks: tuple[str, ...] = MASKS,
) -> DataFrame:
    """``doc``, ``variant``, ``item_id``, ``matched``: every item found in every document.

    ``matched`` is the greatest number of equal words in ``window`` consecutive
    words of the item, over all ways the item lies on the document without gaps;
    pairs with ``window - substitutions`` or more are findings. ``variant`` is a
    hash of the text, which tells rows with the same id apart. Words are
    lower-cased runs of letters and digits.

    Shorter items match with all their words, those of fewer than ``WHOLE`` words only
    where they are all words of the document; items without words find nothing.
    Null and empty texts have no words; long texts are searched whole. Other columns,
    whatever their names, are not read. Repeated rows of documents or of the benchmark
    give one finding. Null ids are kept.

    The seeds of the benchmark are broadcast in blocks of bounded size, each of
    which is one pass over the documents.
    """
    items = benchmark.select(F.col("item_id"), words(F.col("text")).alias("item_words"))
    items = items.where(F.size("item_words") > 0).distinct()
    # A key of its own for every item, also those without an id.
    own = F.xxhash64(F.col("item_id").isNull(), "item_id", "item_words")
    items = items.withColumn("item", own)
    size = F.size("item_words")
    item_hashes = items.withColumn("hashed", hashes(F.col("item_words")))
    lengths = items.where(size < window).select(size.alias("n")).distinct().collect()
    item_seeds = _seeds(item_hashes.where(size >= window), masks, ["item"])
    item_seeds = item_seeds.select("item", F.col("at").alias("item_at"), "seed").distinct()
    rows = keyed(docs, text, id_column)
    hashed = rows.withColumn("hashed", hashes(words("text"))).select("doc", "variant", "hashed")
    doc_seeds = _seeds(hashed, masks, ["doc", "variant"])
    hits = meet(doc_seeds, item_seeds, "seed").select(
        "doc", "variant", "item", (F.col("at") - F.col("item_at")).alias("shift")
    )
    if lengths:
        short = _short_hits(hashed, item_hashes.where(size < window), sorted(r["n"] for r in lengths))
        hits = hits.unionByName(short)
    # Ways to lie, per document; then the words of both sides come together.
    lies = hits.distinct().groupBy("doc", "variant").agg(
        F.collect_set(F.struct("item", "shift")).alias("lies")
    )
    # Repeated rows come together again in the last aggregate.
    texts = rows.withColumnRenamed("doc", "_doc")
    met = lies.join(texts, "variant").where(F.col("doc").eqNullSafe(F.col("_doc")))
    met = met.select("doc", "variant", words("text").alias("doc_words"), "lies")
    shift = F.col("shift")
    covered = F.transform(
        F.col("item_words"),
        lambda w, i: F.coalesce(
            (shift + i >= 0) & (F.get("doc_words", shift + i) == w), F.lit(False)
        ),
    )
    pairs = met.select("doc", "variant", "doc_words", F.inline("lies")).join(items, "item")
    equal = F.size(F.filter(covered, lambda x: x))
    alone = (size >= WHOLE) | (F.size("doc_words") == size)
    matched = F.when(size >= window, _best_window(covered, window)).when(alone, equal).otherwise(0)
    needed = F.when(size >= window, window - substitutions).otherwise(size)
    return (
        pairs.select("doc", "variant", "item_id", matched.alias("matched"), needed.alias("needed"))
        .where("matched >= needed")
        .groupBy("doc", "variant", "item_id")
        .agg(F.max("matched").alias("matched"))
    )


def without_overlaps(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, unchanged."""
    found = benchmark_overlaps(docs, benchmark, text, id_column).select("doc", "variant").distinct()
    variant = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    same = (found["variant"] == variant) & found["doc"].eqNullSafe(docs[id_column])
    return docs.join(found, same, "left_anti")
