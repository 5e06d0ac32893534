"""Near-duplicate classes by DartMinHash over weighted word shingles.

A text is the multiset of its five-word shingles. The weight of a shingle spans
a region that is cut into unit cells of weight and rank; hashing gives every
cell a Poisson number of darts, each with a rank and a coordinate. A text keeps
the earliest dart of each coordinate. Only ranks below a threshold are thrown,
so that a text takes about ``k log k`` darts at any length; a text that leaves a
coordinate empty throws on to twice the rank. Two texts agree in a coordinate
with the probability of their weighted Jaccard similarity.

Bands of coordinates are joined. In each bucket, members are compared with a
hub, not with each other; members that are of another class after that are
compared inside the bucket's task, which returns links between classes only. No
pair of candidates is left out, and none but links and hub pairs is written.
Every link is checked on the shingles themselves.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.llm.components import components
from lakeseries.llm.stores import stored
from lakeseries.llm.vectors import (
    PrefixHash,
    column_bytes,
    mix,
    ragged,
    release,
    slices,
    word_bounds,
)

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 6
BLOCK_ITEMS = 500_000

_TEXTS = 128
_LAYER = np.uint64(0xD6E8FEB86659FD93)
_CELL = np.uint64(0xA0761D6478BD642F)
_DART = np.uint64(0xE7037ED1A0B428DB)
_PLACE = np.uint64(0x8EBC6AF09C88C6E3)
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])


def _uniform(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(11)) * 2.0**-53


def shingles(buffer: np.ndarray, offsets: np.ndarray, words: int = SHINGLE):
    """Hashes of the word shingles of every text, and where each text's begin.

    A text of fewer words is one shingle. The n-th occurrence of a shingle in a
    text has its own hash, so multisets are sets of these hashes.
    """
    starts, ends, first = word_bounds(buffer, offsets)
    values = mix(PrefixHash(buffer).of(starts, ends - starts))
    count = np.diff(first)
    n = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(n)])
    at = ragged(first[:-1], n)
    text = np.repeat(np.arange(len(n)), n)
    hashes = mix(PrefixHash(values).of(at, np.minimum(words, count)[text]))
    order = np.lexsort((hashes, text))
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    place = np.arange(len(hashes))
    layer = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(hashes + layer.astype(np.uint64) * _LAYER), bounds


def dart_signatures(elements: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates for every text that has elements."""
    n_texts = len(bounds) - 1
    weight = np.diff(bounds)
    ranks = np.full((n_texts, k), np.inf)
    darts = np.zeros((n_texts, k), np.uint64)
    todo = np.flatnonzero(weight)
    reach = (k * math.log(k) + 2 * k) / np.maximum(weight, 1)
    while len(todo):
        size = weight[todo]
        element = elements[ragged(bounds[todo], size)]
        cells = np.ceil(reach[todo]).astype(np.int64)
        per = np.repeat(cells, size)
        cell = ragged(np.zeros(len(per), np.int64), per)
        owner = np.repeat(np.repeat(todo, size), per)
        seed = mix(np.repeat(element, per) + cell.astype(np.uint64) * _CELL)
        number = np.searchsorted(_POISSON, _uniform(mix(seed + _DART)), "right")
        index = ragged(np.zeros(len(number), np.int64), number)
        dart = mix(np.repeat(seed, number) + (index + 1).astype(np.uint64) * _DART)
        rank = np.repeat(cell, number) + _uniform(dart)
        owner = np.repeat(owner, number)
        near = rank <= reach[owner]
        dart, rank, owner = dart[near], rank[near], owner[near]
        at = owner * k + (mix(dart ^ _PLACE) % np.uint64(k)).astype(np.int64)
        np.minimum.at(ranks.reshape(-1), at, rank)
        best = rank == ranks.reshape(-1)[at]
        darts.reshape(-1)[at[best]] = dart[best]
        todo = todo[np.isinf(ranks[todo]).any(axis=1)]
        reach[todo] *= 2
    return darts


def _sketch(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everything, offsets = column_bytes(batch.column(1))
            for first, last in slices(offsets, texts=_TEXTS):
                lo = offsets[first]
                elements, bounds = shingles(
                    everything[lo : offsets[last]], offsets[first : last + 1] - lo, words
                )
                darts = dart_signatures(elements, bounds, bands * rows)
                n = last - first
                keys = np.zeros((n, bands), np.uint64)
                for row in range(rows):
                    keys = mix(keys + darts[:, row::rows] + np.uint64(row + 1))
                keys = mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * _CELL).view(np.int64)
                has = np.diff(bounds) > 0
                ends = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                              pa.array(keys[has].reshape(-1)))],
                    ["node", "keys"],
                )
            release()

    return run


def _elements(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everything, offsets = column_bytes(batch.column(1))
            for first, last in slices(offsets):
                lo = offsets[first]
                elements, bounds = shingles(
                    everything[lo : offsets[last]], offsets[first : last + 1] - lo, words
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()),
                                              pa.array(elements.view(np.int64)))],
                    ["node", "elements"],
                )
            release()

    return run


def _order(node: str) -> Column:
    """A random order of nodes that is the same in every bucket."""
    return F.struct(F.xxhash64(node), F.col(node))


def _checked(pairs: DataFrame, elements: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose weighted Jaccard similarity is at least ``similarity``."""
    a = elements.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    b = elements.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    whole = F.size("of_a") + F.size("of_b") - common
    return pairs.join(a, "a").join(b, "b").where(common >= whole * similarity).select("a", "b")


def _spanning(similarity: float):
    """Links between members of different classes of a bucket, one per pair of classes."""

    def run(key: tuple[pa.Scalar, ...], members: pa.Table) -> pa.Table:
        node = members.column("node").to_numpy()
        own = members.column("own").to_numpy()
        across = key[1] != key[2]  # two blocks: pairs inside one are met elsewhere
        lists = members.column("elements").combine_chunks()
        first = np.asarray(lists.offsets, np.int64)
        item = lists.values.to_numpy()
        size = np.diff(first)
        _, root = np.unique(members.column("root").to_numpy(), return_inverse=True)
        # Who has each element, by element.
        order = np.argsort(item, kind="stable")
        new = np.ones(len(item), bool)
        new[1:] = np.diff(item[order]) != 0
        number = np.empty(len(item), np.int32)
        number[order] = np.cumsum(new, dtype=np.int32) - 1
        owner = np.repeat(np.arange(len(node), dtype=np.int32), size)[order]
        begin = np.append(np.flatnonzero(new), len(item))
        del order, new, item
        parent = np.arange(root.max() + 1)
        links = []
        for u in np.flatnonzero(root != np.bincount(root).argmax()):
            mine = number[first[u] : first[u + 1]]
            common = np.bincount(
                owner[ragged(begin[mine], begin[mine + 1] - begin[mine])], minlength=len(node)
            )
            near = np.flatnonzero(common >= similarity * (size[u] + size - common))
            if across:
                near = near[own[near] != own[u]]
            for v in near[parent[root[near]] != parent[root[u]]]:
                here, there = parent[root[u]], parent[root[v]]
                if here != there:
                    parent[parent == there] = here
                    links.append((node[u], node[v]))
        pairs = np.array(links, np.int64).reshape(-1, 2)
        release()
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _links(buckets: DataFrame, elements: DataFrame, similarity: float) -> DataFrame:
    """Links that connect all candidates of a bucket that are similar enough.

    Every bucket first gets a hub, which meets all other members. That settles
    buckets of two, and joins most of a group of near copies. Buckets of more
    members that are not of one class then go to a task, each member with its
    shingles; a bucket of over ``BLOCK_ITEMS`` shingles goes in pairs of blocks.
    Only links between classes come out.
    """
    stats = buckets.groupBy("bucket").agg(
        F.min(_order("node")).alias("hub"), F.count("*").alias("n")
    )
    stats = stored(stats.select("bucket", F.col("hub.node").alias("hub"), "n"), "stats")
    pairs = buckets.join(stats, "bucket").where("hub <> node").select(
        F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")
    )
    links = stored(_checked(pairs.distinct(), elements, similarity), "links")
    members = buckets.join(stats.where("n > 2").select("bucket"), "bucket")
    members = members.join(components(links), "node", "left").join(
        elements.select("node", "items"), "node"
    )
    members = members.select("bucket", "node", "items", F.coalesce("root", "node").alias("root"))
    members = stored(members, "members")
    open_ = members.groupBy("bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.sum("items").alias("all")
    )
    open_ = open_.where("low < high").select("bucket", "all")
    blocks = F.ceil(F.col("all") / BLOCK_ITEMS).cast("int")
    placed = members.join(open_, "bucket").select(
        "bucket", "node", "root", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    placed = placed.select(
        "bucket", "node", "root", "own",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    )
    more = placed.join(elements.drop("items"), "node").groupBy("bucket", "i", "j").applyInArrow(
        _spanning(similarity), "a long, b long"
    )
    return links.unionByName(more)


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                    words: int = SHINGLE, similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per text: the id, ``class_id`` (least id of its class) and ``class_size``.

    Texts are lower-cased and split at white space. A class is a connected
    component of links of weighted Jaccard similarity ``similarity`` or more;
    equal word sequences always share a class. With 32 bands of 6 coordinates a
    pair of similarity 0.8 is missed with a probability of 0.00006.

    A text without words (null, empty, blank) is alone in its class. Rows with
    the same id and the same words are one class; rows of one id with other words
    are texts of their own. A null id is kept, in no class (``class_id`` null,
    size 1).
    """
    found = near_classes(docs, text, id_column, words, similarity, bands, rows)
    return found.select(F.col("id").alias(id_column), "class_id", "class_size")


def near_classes(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                 words: int = SHINGLE, similarity: float = SIMILARITY,
                 bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``near_duplicates`` with ``id``, ``variant`` and ``first``.

    ``variant`` is a hash of the text, which tells rows with the same id apart;
    ``first`` says that the row has the least id, and then variant, of its class.
    """
    rows_in = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.lower(F.col(f"`{text}`")).alias("text"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("variant"),
    )
    words_of = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    rows_in = rows_in.withColumn("content", F.sha2(words_of, 256))
    content = stored(
        rows_in.select("id", "variant", "content", (words_of == "").alias("blank")), "contents"
    )
    node = content.where("id is not null and not blank").groupBy("content").agg(
        F.min("id").alias("id")
    )
    # The least id names a text, unless other words have that id as well.
    alone = F.count("*").over(Window.partitionBy("id")) == 1
    node = node.withColumn("node", F.when(alone, F.col("id")).otherwise(F.xxhash64("content")))
    node = stored(node, "nodes")
    texts = rows_in.join(node, ["id", "content"]).select("node", "text")
    sketches = texts.mapInArrow(_sketch(words, bands, rows), "node long, keys array<long>")
    keyed = stored(sketches.select("node", F.explode("keys").alias("bucket")).distinct(), "keys")
    several = keyed.groupBy("bucket").count().where("count > 1").select("bucket")
    buckets = stored(keyed.join(several, "bucket"), "buckets")
    wanted = node.join(buckets.select("node").distinct(), "node", "left_semi")
    elements = stored(
        rows_in.join(wanted, ["id", "content"])
        .select("node", "text")
        .mapInArrow(_elements(words), "node long, elements array<long>")
        .withColumn("items", F.size("elements"))
        .dropDuplicates(["node"]),
        "elements",
    )
    classes = components(_links(buckets, elements, similarity))
    known = node.join(classes, "node", "left").select(
        "content", F.concat(F.lit("root "), F.coalesce("root", "node").cast("string")).alias("root")
    )
    labelled = content.join(known.withColumn("blank", F.lit(False)), ["content", "blank"], "left")
    own = F.concat(F.lit("blank "), F.col("id").cast("string"))
    labelled = labelled.select(
        "id", "variant", F.when(F.col("id").isNotNull(), F.coalesce("root", own)).alias("class")
    )
    sizes = labelled.where("class is not null").groupBy("class").agg(
        F.count("*").alias("class_size"), F.min(F.struct("id", "variant")).alias("least")
    )
    return labelled.join(sizes, "class", "left").select(
        "id", "variant", F.col("least.id").alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("least") == F.struct("id", "variant"), F.lit(True)).alias("first"),
    )
