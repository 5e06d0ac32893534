"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

A text is split by a pattern. A match that is no token itself is merged with a
segment tree over its byte positions: a leaf holds the rank of the pair that
starts there, an inner node the leftmost minimum below it. A merge takes the
root, joins two neighbours of a linked list and updates the three leaves that
change, each in logarithmic time, so long matches cost n log n.
"""

import base64
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from lakeseries.llm.rows import as_rows, with_fields
from lakeseries.llm.vectors import column_bytes, gathered, release, slices

_CACHED = 200_000  # matches in a generation of those a worker remembers; it only saves time
_CACHED_CHARS = 64
_IDS = 250_000  # ids decoded at once, those of one text at least
_LONG = 1_000_000  # texts whose matches are taken one by one


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    bits = max(1, (n - 2).bit_length())
    size = 1 << bits
    mask = size - 1
    never = 1 << 62
    get = ranks.get
    part = [piece[i : i + 1] for i in range(n)]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    tree = [never] * (2 * size)
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << bits | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    while tree[1] < never:
        i = tree[1] & mask
        j = after[i]
        joined = part[i] = part[i] + part[j]
        part[j] = None
        k = after[i] = after[j]
        changes = [(j, never)] if j < n - 1 else []
        if k < n:
            before[k] = i
            rank = get(joined + part[k])
            changes.append((i, never if rank is None else rank << bits | i))
        else:
            changes.append((i, never))
        h = before[i]
        if h >= 0:
            rank = get(part[h] + joined)
            changes.append((h, never if rank is None else rank << bits | h))
        for leaf, value in changes:
            at = size + leaf
            tree[at] = value
            at >>= 1
            while at:
                a, b = tree[2 * at], tree[2 * at + 1]
                least = a if a < b else b
                if tree[at] == least:
                    break
                tree[at] = least
                at >>= 1
    return [ranks[x] for x in part if x is not None]


class _Ids(dict):
    """Ids of matches, worked out when first asked for and kept as packed integers.

    Two generations: when the young one is full it becomes the old one, so
    matches in use stay known and memory stays bounded.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self._ranks = ranks
        self._old: dict[str, bytes] = {}

    def __getitem__(self, piece: str) -> tuple[int, ...]:
        return tuple(self.of([piece]).tolist())

    def of(self, pieces: Iterable[str]) -> np.ndarray:
        """Ids of the matches, one after the other."""
        return np.frombuffer(b"".join(map(super().__getitem__, pieces)), np.int32)

    def __missing__(self, piece: str) -> bytes:
        ids = self._old.get(piece)
        if ids is None:
            ids = array("i", merge(piece.encode(), self._ranks)).tobytes()
        if len(piece) <= _CACHED_CHARS:
            if len(self) >= _CACHED:
                self._old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


_workers: dict[tuple, tuple] = {}


def _encoder(path: str, pattern: str, ranks) -> tuple:
    key = (path, pattern)
    if key not in _workers:
        # White space as Unicode defines it; \s of this module takes more.
        plain = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        _workers[key] = regex.compile(plain), _Ids(ranks.value)
    return _workers[key]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``ids``, the token ids of the whole text.

    ``path`` names a rank file that the driver can read; executors get its
    content. Null and empty texts have no ids. No special tokens: their strings
    are ordinary text. A column named ``ids`` is replaced.
    """
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(path))  # one entry per vocabulary item
    rows = as_rows(docs, [text], ["ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, ids_of = _encoder(path, pattern, ranks)
        for batch in batches:
            own = batch.column("_row")
            texts = own.field(text)
            for first, last in slices(column_bytes(texts)[1]):
                out, ends = [], [0]
                for value in texts.slice(first, last - first):
                    plain = value.as_py() or ""
                    if len(plain) < _LONG:
                        pieces = split.findall(plain)
                    else:
                        pieces = (m.group() for m in split.finditer(plain))
                    out.append(ids_of.of(pieces))
                    ends.append(ends[-1] + len(out[-1]))
                ids = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(out), pa.int32())
                )
                yield pa.RecordBatch.from_arrays([own.slice(first, last - first), ids], ["_row", "ids"])
            release()

    return rows.mapInArrow(run, with_fields(rows, "ids array<int>")).select("_row.*", "ids")


def decode(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The columns of ``tokens`` and ``decoded``, the bytes that the ids stand for.

    Null ids are taken as none. A column named ``decoded`` is replaced.
    """
    spark: SparkSession = tokens.sparkSession
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    vocabulary = spark.sparkContext.broadcast(table)
    rows = as_rows(tokens, [ids], ["decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = vocabulary.value
        buffer = np.frombuffer(b"".join(items), np.uint8)
        length = np.array([len(x) for x in items], np.int64)
        start = np.cumsum(length) - length
        for batch in batches:
            lists = batch.column("_row").field(ids)
            if lists.null_count:
                lists = lists.fill_null([])
            bounds = lists.offsets.to_numpy().astype(np.int64)
            for a, b in slices(bounds, _IDS):
                one = lists.values[bounds[a] : bounds[b]].to_numpy()
                size = length[one]
                plain = gathered(buffer, start[one], size)
                ends = np.concatenate([[0], np.cumsum(size)])[bounds[a : b + 1] - bounds[a]]
                decoded = pa.Array.from_buffers(
                    pa.large_binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(plain)]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(a, b - a), decoded.cast(pa.binary())],
                    ["_row", "decoded"],
                )
            release()

    return rows.mapInArrow(run, with_fields(rows, "decoded binary")).select("_row.*", "decoded")
