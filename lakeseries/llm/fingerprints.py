"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. On each level, runs of one symbol fold into one;
deterministic coin tossing then turns each symbol, with its left neighbour, into
a label: twice the index of the lowest bit in which the two differ, plus that
bit. After a few rounds labels are below six, and local maxima of labels begin
phrases of two to a dozen symbols. A phrase is named by a hash of its symbols and
is a symbol of the next level. Where a phrase begins depends on a few neighbours
alone, so equal substrings have the same phrases inside, at any offset.

The fingerprint has, for two levels, 16 bits of the least phrase name of each of a
number of bins. Names are compared in full, so bins of unrelated texts agree by
chance once in 65,535 times at any length of the texts. The likeness of two
fingerprints is the share of bins that agree.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.llm.stores import stored
from lakeseries.llm.vectors import PrefixHash, mix, slices

LEVELS = (2, 3)
BINS = 64
EMPTY = 0xFFFF
_NO_NAME = np.uint64(0xFFFFFFFFFFFFFFFF)
PART_BYTES = 8_000_000
MIN_PARTS = 16

_LOWEST = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)
_ROUNDS = {np.dtype(np.uint8): 3, np.dtype(np.uint64): 4}


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below six; neighbours in a text differ if their symbols do.

    ``first`` holds the places where texts begin.
    """
    labels = symbols
    for _ in range(_ROUNDS[symbols.dtype]):
        differ = labels.copy()
        differ[1:] ^= labels[:-1]
        differ[first] = 1  # a first symbol is told apart by its own lowest bit
        if labels.dtype == np.uint8:
            lowest = _LOWEST[differ]
            labels = 2 * lowest + ((labels >> lowest) & 1)
        else:
            one = np.uint64(1)
            lowest = np.bitwise_count((differ & (~differ + one)) - one)
            bit = (labels >> lowest.astype(np.uint64)) & one
            labels = 2 * lowest + bit.astype(np.uint8)
    return labels


def phrases(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all texts, and where each text's phrases begin."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.uint64), np.zeros_like(bounds)
    starts = bounds[:-1][np.diff(bounds) > 0]
    new = np.ones(n, bool)
    new[1:] = symbols[1:] != symbols[:-1]
    new[starts] = True
    heads = np.flatnonzero(new)
    run = np.diff(heads, append=n)
    symbols = symbols[heads]
    first = np.searchsorted(heads, starts)
    labels = _labels(symbols, first)
    up = np.ones(len(labels), bool)
    up[1:] = labels[1:] > labels[:-1]
    down = np.ones(len(labels), bool)
    down[:-1] = labels[:-1] > labels[1:]
    down[first[1:] - 1] = True
    down[-1] = False
    begin = up & down
    begin[first[1:] - 1] = False  # the last symbol of a text begins no phrase
    begin[first] = True
    at = np.flatnonzero(begin)
    size = np.diff(at, append=len(labels))
    names = symbols.astype(np.uint64) + np.uint64(1)
    names *= np.uint64(0x2545F4914F6CDD1D)
    names += run.astype(np.uint64)
    named = mix(PrefixHash(mix(names)).of(at, size) + size.astype(np.uint64))
    return named, np.searchsorted(at, np.searchsorted(heads, bounds))


def fingerprints(buffer: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``len(LEVELS) * BINS`` numbers below 65,536 for every text."""
    n_texts = len(bounds) - 1
    least = np.full(n_texts * len(LEVELS) * BINS, _NO_NAME, np.uint64)
    names = buffer
    for level in range(1, max(LEVELS) + 1):
        names, bounds = phrases(names, bounds)
        if level in LEVELS:
            text = np.repeat(np.arange(n_texts), np.diff(bounds))
            column = LEVELS.index(level) * BINS + (names % np.uint64(BINS)).astype(np.int64)
            np.minimum.at(least, text * (len(LEVELS) * BINS) + column, names)
    short = (mix(least) % np.uint64(EMPTY)).astype(np.uint16)
    short[least == _NO_NAME] = EMPTY
    return short.reshape(n_texts, len(LEVELS) * BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of bins that agree among those that either text fills; 1 if none."""
    filled = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=1)
    return np.where(filled > 0, equal / np.maximum(filled, 1), 1.0)


def _of_texts(texts: list[str]) -> np.ndarray:
    data = [x.encode() for x in texts]
    offsets = np.cumsum([0] + [len(x) for x in data])
    parts = [np.zeros((0, len(LEVELS) * BINS), np.uint16)]
    for first, last in slices(offsets):
        buffer = np.frombuffer(b"".join(data[first:last]), np.uint8)
        parts.append(fingerprints(buffer, offsets[first : last + 1] - offsets[first]))
    return np.concatenate(parts)


def _edited(text: str, after: str) -> str:
    n = len(text) // 3
    return text[: len(text) - n] + after[:n]


def _raw(rows: np.ndarray) -> list[bytes]:
    return [x.astype(">u2").tobytes() for x in rows]


def _hex(rows: np.ndarray) -> list[str]:
    return [x.hex() for x in _raw(rows)]


# Rows of a range of ids: a text with the one after it, the range's first and last text.
PAIR, FIRST, LAST = 0, 1, 2

_RANGE = pa.schema(
    [("id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()),
     ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()),
     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()),
     ("near_next", pa.float64()), ("part", pa.int32()), ("kind", pa.int32()),
     ("text", pa.string())]
)
_RANGE_COLUMNS = (
    "id long, n_chars long, edited string, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double, part int, kind int, "
    "text string"
)
_RESULT = _RANGE.names[:8]
_BYTES = ("edited_sha256", "fingerprint", "edited_fingerprint")  # hexadecimal when returned


def _pairs(
    ids: list, texts: list[str], after: list[str], own: np.ndarray, following: np.ndarray,
    with_edited: bool,
) -> pa.RecordBatch:
    edited = [_edited(x, y) for x, y in zip(texts, after, strict=True)]
    changed = _of_texts(edited)
    n = len(ids)
    columns = [
        ids, [len(x) for x in texts], edited if with_edited else [None] * n,
        [hashlib.sha256(x.encode()).digest() for x in edited], _raw(own), _raw(changed),
        likeness(own, changed), likeness(own, following), [TaskContext.get().partitionId()] * n,
        [PAIR] * n, [None] * n,
    ]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _RANGE, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_RANGE)


def _border(kind: int, name: int | None, text: str, own: np.ndarray) -> pa.RecordBatch:
    row = dict.fromkeys(_RANGE.names)
    row |= {"id": name, "fingerprint": _raw(own)[0], "part": TaskContext.get().partitionId(),
            "kind": kind, "text": text}
    return pa.RecordBatch.from_pylist([row], schema=_RANGE)


def _compare(with_edited: bool):
    """Each text of a sorted range with the one after it, and the range's two borders."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                ids = part.column("id").to_pylist()
                texts = [x or "" for x in part.column("text").to_pylist()]
                own = _of_texts(texts)
                if held is None:
                    yield _border(FIRST, ids[0], texts[0], own[:1])
                else:
                    ids, texts = [held[0], *ids], [held[1], *texts]
                    own = np.concatenate([held[2], own])
                held = ids[-1], texts[-1], own[-1:]
                if len(ids) > 1:
                    yield _pairs(ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:], with_edited)
        if held is not None:
            yield _border(LAST, *held)

    return compare


def _compare_borders(with_edited: bool):
    """Last texts of ranges with the first ones of the next range."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                own, following = (
                    np.frombuffer(row[c], ">u2").astype(np.uint16)[None, :]
                    for c in ("fingerprint", "next_fingerprint")
                )
                yield _pairs([row["id"]], [row["text"]], [row["next_text"]], own, following, with_edited)

    return compare


def _fingerprint_column(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x or "" for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(_hex(_of_texts(texts)), pa.string())], ["id", "fingerprint"]
        )


def fingerprint_texts(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The id and the ``fingerprint`` (hexadecimal) of every text; null counts as empty."""
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(_fingerprint_column, "id long, fingerprint string")
    return found.withColumnRenamed("id", id_column)


def with_next(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", edited_texts: bool = True
) -> DataFrame:
    """Texts against an edited form and against the next text, in descending order of ids.

    Per row: the id, ``n_chars``, ``edited`` (the last third of the code points
    replaced by the first as many of the next text, rounded down) and its
    ``edited_sha256``, both fingerprints, and the likeness to the edited and to the
    next text. After the last text comes the first. A single text is its own next.
    Without ``edited_texts``, ``edited`` is null and only its digest is stored.

    Null texts count as empty. Null ids come last. Other columns, whatever their
    names, are not read and not returned. Long texts are parsed whole. Rows with the
    same id are ordered by a hash of their texts; rows equal in both come in any order.

    Texts are sorted in ranges of ids over the cluster, each moved once; repeated
    rows of one id may lie in several ranges. The result is stored in the shared folder
    with the first and last text of each range, and these meet in a join
    of one row per range. Nothing is collected but the size of the table.
    """
    keyed = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")
    ).withColumns(
        {"k": F.coalesce("id", F.lit(-(1 << 63))),
         "v": F.xxhash64(F.coalesce("text", F.lit(""))),
         "n": F.monotonically_increasing_id()}
    )
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0]
    n_parts = max(MIN_PARTS, -(-(size or 0) // PART_BYTES))
    order = [F.desc("k"), F.desc("v"), "n"]
    dealt = keyed.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    compared = dealt.select("id", "text").mapInArrow(_compare(edited_texts), _RANGE_COLUMNS)
    ranges = stored(compared, "ranges")
    first = ranges.where(F.col("kind") == FIRST)
    last = ranges.where(F.col("kind") == LAST).select("part", "id", "text", "fingerprint")
    # One number per range that has texts; after the last comes the first.
    following = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = Window.partitionBy(F.lit(0))
    after = first.select(
        "part", F.coalesce(F.lead("part").over(following), F.min("part").over(whole)).alias("next_part")
    )
    heads = first.select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    met = last.join(after, "part").join(heads, "next_part")
    borders = met.select("id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(
        _compare_borders(edited_texts), _RANGE_COLUMNS
    )
    inside = ranges.where(F.col("kind") == PAIR).select(*_RESULT)
    found = inside.unionByName(borders.select(*_RESULT))
    shown = found.withColumns({c: F.lower(F.hex(c)) for c in _BYTES})
    return shown.withColumnRenamed("id", id_column)
