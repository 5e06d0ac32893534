"""Consecutive windows that share a minimiser, as packed strings per bucket.

A window is a fixed number of consecutive symbols (bytes or words) of one text.
Its minimiser is the m-gram with the least hash in it, so windows with equal
symbols have equal minimisers at equal places. A super-k-mer is a maximal run of
windows with one minimiser. It travels as one string to the bucket of that
minimiser, where all occurrences of its windows meet.

Before the shuffle, equal strings of a slice of texts fold into one, so that a
string which a third of all texts hold travels once per slice, not per text.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeseries.llm.vectors import exact_classes, gathered, mix, release, sliding_minimum, string_hashes

BUCKET_BYTES = 2_000_000
MIN_BUCKETS = 256
PACK_BYTES = 8_000_000  # strings that are dealt to buckets at once
MAX_ID = (1 << 63) - 1

_BLOCK = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_CODEC = pa.Codec("zstd", 3)


@dataclass
class Strings:
    """Strings with their occurrences that are still to be decided.

    ``text_id``/``text_variant`` name the texts; ``doc`` of an occurrence is an
    index into them. ``weight`` counts occurrences, two at most. ``gone_*`` are
    ranges that are already known to repeat.
    """

    text: np.ndarray  # uint8
    length: np.ndarray  # bytes of each string
    anchor: np.ndarray  # hash of its minimiser; it does not travel
    offset: np.ndarray  # place of its minimiser, in symbols
    weight: np.ndarray
    text_id: np.ndarray
    text_variant: np.ndarray
    of: np.ndarray  # string of each occurrence
    doc: np.ndarray
    place: np.ndarray  # first symbol of each occurrence in its text
    symbols: np.ndarray  # length of each string in symbols
    gone_doc: np.ndarray
    gone_from: np.ndarray
    gone_to: np.ndarray


_TYPES = {
    "text": np.uint8, "length": np.uint32, "anchor": np.uint64, "offset": np.uint32,
    "weight": np.uint8, "text_id": np.int64, "text_variant": np.uint32, "of": np.uint32,
    "doc": np.uint32, "place": np.uint32, "symbols": np.uint32, "gone_doc": np.uint32,
    "gone_from": np.uint32, "gone_to": np.uint32,
}


def _packed_type(name: str, values: np.ndarray) -> type:
    wide = name == "text_variant" and len(values) and (values.min() < 0 or values.max() >> 32)
    return np.int64 if wide else _TYPES[name]


def pack(strings: Strings) -> bytes:
    """All arrays in one string; the length of one in a wide type is written as negative."""
    values = [(f.name, np.asarray(getattr(strings, f.name))) for f in fields(Strings)]
    kinds = [_packed_type(name, x) for name, x in values]
    parts = [np.asarray(x, kind) for (_, x), kind in zip(values, kinds, strict=True)]
    sizes = [len(x) if kind is _TYPES[n] else -len(x) for (n, _), x, kind in zip(values, parts, kinds)]
    head = np.array(sizes, np.int64).tobytes()
    plain = head + b"".join(x.tobytes() for x in parts)
    return len(plain).to_bytes(8, "little") + _CODEC.compress(plain, asbytes=True)


def unpack(packed: bytes) -> Strings:
    plain = _CODEC.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)
    names = [f.name for f in fields(Strings)]
    at = 8 * len(names)
    out = {}
    for name, n in zip(names, np.frombuffer(plain[:at], np.int64).tolist(), strict=True):
        kind = np.dtype(_TYPES[name] if n >= 0 else np.int64)
        out[name] = np.frombuffer(plain, kind, abs(n), at)
        at += abs(n) * kind.itemsize
    return Strings(**out)


def joined(parts: list[Strings]) -> Strings:
    """All strings of several packs; indices are moved on, narrow types widened."""
    n_strings = np.cumsum([0] + [len(p.length) for p in parts])
    n_docs = np.cumsum([0] + [len(p.text_id) for p in parts])
    out = {}
    for f in fields(Strings):
        shift = {"of": n_strings, "doc": n_docs, "gone_doc": n_docs}.get(f.name)
        kind = _TYPES[f.name] if f.name in ("text", "anchor", "weight") else np.int64
        columns = [np.asarray(getattr(p, f.name), kind) for p in parts]
        if shift is not None:
            columns = [x + n for x, n in zip(columns, shift[:-1], strict=True)]
        out[f.name] = np.concatenate(columns)
    return Strings(**out)


def runs(
    grams: np.ndarray, bounds: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of every super-k-mer, and the place of its minimiser.

    ``bounds`` are the first symbols of the texts, with the end as last entry.
    The leftmost of equal minimisers counts.
    """
    total = int(bounds[-1])
    n = total - window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    width = window - gram + 1
    least = np.empty(n, np.int64)
    for first in range(0, n, _BLOCK):
        last = min(n, first + _BLOCK)
        part = grams[first : last + width - 1] & ~_PLACE
        part |= np.arange(len(part), dtype=np.uint64)
        least[first:last] = (sliding_minimum(part, width) & _PLACE).astype(np.int64)
        least[first:last] += first
    edges = np.zeros(n + 1, np.int64)
    sizes = np.diff(bounds)
    has = sizes >= window
    np.add.at(edges, bounds[:-1][has], 1)
    np.add.at(edges, bounds[:-1][has] + sizes[has] - window + 1, -1)
    whole = np.flatnonzero(np.cumsum(edges[:-1]) > 0)  # windows that lie in one text
    least = least[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (least[1:] != least[:-1]) | (whole[1:] != whole[:-1] + 1)
    head = np.flatnonzero(new)
    last = whole[np.append(head[1:], len(whole))[: len(head)] - 1]
    return whole[head], last, least[head]


def collapse(strings: Strings, hashes: np.ndarray, by_order: bool) -> Strings:
    """Fold equal strings into one and decide what follows from equality alone.

    ``by_order``: only occurrences of the smallest text id stay open, all others
    are gone. Otherwise all occurrences of a string that is there twice are gone.
    """
    starts = np.concatenate([[0], np.cumsum(strings.length)])[:-1]
    classes = exact_classes(strings.text, starts, strings.length, hashes)
    kept, number = np.unique(classes, return_inverse=True)
    weight = np.minimum(np.bincount(number, strings.weight, len(kept)), 2).astype(np.uint8)
    of = number[strings.of]
    if by_order:
        ids = strings.text_id[strings.doc]
        least = np.full(len(kept), MAX_ID)
        np.minimum.at(least, of, ids)
        gone = ids > least[of]
    else:
        gone = weight[of] > 1
    ends = strings.place + strings.symbols[strings.of]
    text, length = strings.text, strings.length
    if len(kept) < len(length):
        keep = np.zeros(len(length), bool)
        keep[kept] = True
        text = text[np.repeat(keep, length)]
    return Strings(
        text=text, length=length[kept],
        anchor=strings.anchor[kept] if len(strings.anchor) else strings.anchor,
        offset=strings.offset[kept],
        weight=weight, text_id=strings.text_id, text_variant=strings.text_variant,
        of=of[~gone], doc=strings.doc[~gone], place=strings.place[~gone],
        symbols=strings.symbols[kept],
        gone_doc=np.concatenate([strings.gone_doc, strings.doc[gone]]),
        gone_from=np.concatenate([strings.gone_from, strings.place[gone]]),
        gone_to=np.concatenate([strings.gone_to, ends[gone]]),
    )


def chosen(strings: Strings, keep: np.ndarray) -> Strings:
    """The strings ``keep`` and their open occurrences; nothing that is decided."""
    number = np.cumsum(keep) - 1
    here = keep[strings.of]
    return Strings(
        text=strings.text[np.repeat(keep, strings.length)], length=strings.length[keep],
        anchor=strings.anchor[keep] if len(strings.anchor) else strings.anchor,
        offset=strings.offset[keep], weight=strings.weight[keep], text_id=strings.text_id,
        text_variant=strings.text_variant, of=number[strings.of[here]], doc=strings.doc[here],
        place=strings.place[here], symbols=strings.symbols[keep], gone_doc=strings.gone_doc[:0],
        gone_from=strings.gone_from[:0], gone_to=strings.gone_to[:0],
    )


def dealt(strings: Strings, n_buckets: int) -> Iterator[tuple[int, bytes]]:
    """A pack for every bucket that has strings, and one for what is already decided."""
    bucket = (mix(strings.anchor) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.cumsum(strings.length) - strings.length
    length = strings.length[order]
    text = gathered(strings.text, starts[order], length)
    ends = np.cumsum(length)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    of = number[strings.of]
    by_string = np.argsort(of, kind="stable")
    of = of[by_string]
    doc, place = strings.doc[by_string], strings.place[by_string]
    none = np.zeros(0, np.int64)
    heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for first, last in zip(heads, np.append(heads[1:], len(order))[: len(heads)], strict=True):
        chosen = order[first:last]
        lo, hi = np.searchsorted(of, [first, last])
        docs, own = np.unique(doc[lo:hi], return_inverse=True)
        part = Strings(
            text=text[ends[first] - length[first] : ends[last - 1]], length=length[first:last],
            anchor=none, offset=strings.offset[chosen],
            weight=strings.weight[chosen], text_id=strings.text_id[docs],
            text_variant=strings.text_variant[docs], of=of[lo:hi] - first, doc=own,
            place=place[lo:hi], symbols=strings.symbols[chosen],
            gone_doc=none, gone_from=none, gone_to=none,
        )
        yield int(bucket[chosen[0]]), pack(part)
    if len(strings.gone_doc):
        docs, own = np.unique(strings.gone_doc, return_inverse=True)
        decided = Strings(
            text=none, length=none, anchor=none, offset=none, weight=none,
            text_id=strings.text_id[docs], text_variant=strings.text_variant[docs], of=none,
            doc=none, place=none, symbols=none, gone_doc=own, gone_from=strings.gone_from,
            gone_to=strings.gone_to,
        )
        at = mix(strings.text_id[docs[:1]].astype(np.uint64))[0] % np.uint64(n_buckets)
        yield int(at), pack(decided)


def _named(rows: DataFrame, id_column: str, text: str, bits: int, salt: int) -> DataFrame:
    name = F.xxhash64(text) if salt == 0 else F.xxhash64(F.lit(salt), text)
    return rows.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(MAX_ID)).alias("_id"),
        (name.bitwiseAND(F.lit(0xFFFFFFFF)) if bits == 32 else name).alias("_variant"),
        "_row",
        F.col(text).alias("_text"),
    )


def with_key(rows: DataFrame, id_column: str, text: str) -> tuple[DataFrame, int]:
    """Rows with ``_text`` and their names ``_id`` and ``_variant``, and a number of buckets.

    A null id is the greatest. ``_variant`` tells different texts of one id
    apart: 32 bits of a hash where they do for the given rows, all 64 where very
    many rows share an id, and of another hash where even these are equal. One
    pass over the rows counts that, by two further hashes of every text, and adds
    up the size of the input, of which buckets have a bounded share.
    """
    for bits, salt in ((32, 0), (64, 0), (64, 1), (64, 2), (64, 3)):
        keyed = _named(rows, id_column, text, bits, salt)
        whole = F.struct(F.xxhash64("_text"), F.xxhash64(F.lit("whole"), "_text"))
        names = keyed.groupBy("_id", "_variant").agg(
            (F.min(whole) != F.max(whole)).alias("mixed"),
            F.sum(F.octet_length("_text")).alias("size"),
        )
        mixed, size = names.agg(F.max("mixed"), F.sum("size")).first()
        if not mixed:
            return keyed, max(MIN_BUCKETS, -(-(size or 0) // BUCKET_BYTES))
    raise ValueError("texts that share an id cannot be told apart")


def _packs(held: list[Strings], n_buckets: int) -> pa.RecordBatch:
    """Packs of the strings of several slices, equal ones folded once more; empties ``held``."""
    strings = held[0] if len(held) == 1 else joined(held)
    several = len(held) > 1
    held.clear()
    if several:
        starts = np.cumsum(strings.length) - strings.length
        hashes = string_hashes(strings.text, starts, strings.length)
        strings = collapse(strings, hashes, by_order=False)
    rows = list(dealt(strings, n_buckets))
    return pa.RecordBatch.from_pydict(
        {"bucket": pa.array([r[0] for r in rows], pa.int32()),
         "packed": pa.array([r[1] for r in rows], pa.binary())}
    )


def gone_ranges(
    keyed: DataFrame,
    n_buckets: int,
    cut: Callable[[pa.RecordBatch], Iterator[Strings]],
    settle: Callable[[Strings], tuple[np.ndarray, np.ndarray, np.ndarray]],
) -> DataFrame:
    """Ranges of symbols that repeat, as a list per text (``_id``, ``_variant``, ``_gone``).

    ``cut`` turns a batch of (id, variant, text) into strings that are collapsed,
    not by order;
    ``settle`` gives document, first and end of the ranges in a bucket.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Strings] = []
        for batch in batches:
            for strings in cut(batch):
                held.append(strings)
                if sum(len(x.text) for x in held) >= PACK_BYTES:
                    del strings
                    yield _packs(held, n_buckets)
                    release()
            release()
        if held:
            yield _packs(held, n_buckets)
            release()

    packed = keyed.select("_id", "_variant", "_text").mapInArrow(spread, "bucket int, packed binary")
    return settled(packed, settle).groupBy("_id", "_variant").agg(
        F.collect_list(F.struct("lo", "hi")).alias("_gone")
    )


def settled(
    packed: DataFrame,
    settle: Callable[[Strings], tuple[np.ndarray, np.ndarray, np.ndarray]],
    split: Callable[[Strings], Iterator[Strings]] = lambda strings: iter([strings]),
) -> DataFrame:
    """Ranges (``_id``, ``_variant``, ``lo``, ``hi``) that ``settle`` finds in every bucket.

    ``split`` cuts a bucket into parts that have nothing to do with each other.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = joined([unpack(x) for b in batches for x in b.column("packed").to_pylist()])
        for strings in split(whole):
            doc, first, end = settle(strings)
            yield pa.RecordBatch.from_pydict(
                {"_id": pa.array(strings.text_id[doc]), "_variant": pa.array(strings.text_variant[doc]),
                 "lo": pa.array(first, pa.int64()), "hi": pa.array(end, pa.int64())}
            )
            release()

    return packed.groupBy("bucket").applyInArrow(
        gather, "_id long, _variant long, lo long, hi long"
    )


def with_gone(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """Texts with their list of ranges, null where nothing repeats."""
    return keyed.join(found, ["_id", "_variant"], "left").select("_row", "_gone")


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges as maximal runs; those that touch or overlap become one."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    first = np.flatnonzero(new)
    return lo[first], hi[np.append(first[1:], len(lo)) - 1]


def with_runs(
    strings: Strings, occurrence: np.ndarray, lo: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, begin and end of windows in a row as one range, and of what went before.

    ``occurrence`` and ``lo`` (first symbol of the window) are sorted.
    """
    new = np.ones(len(lo), bool)
    new[1:] = (occurrence[1:] != occurrence[:-1]) | (lo[1:] != lo[:-1] + 1)
    head = np.flatnonzero(new)
    end = lo[np.append(head[1:], len(lo))[: len(head)] - 1] + window
    return (
        np.concatenate([strings.gone_doc, strings.doc[occurrence[head]]]),
        np.concatenate([strings.gone_from, lo[head]]),
        np.concatenate([strings.gone_to, end]),
    )
