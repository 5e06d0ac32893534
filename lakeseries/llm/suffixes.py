"""Byte-level deduplication over sorted suffixes.

Windows of bytes meet in the bucket of their minimiser (``superkmers``). First,
only the minimisers of every slice of texts travel, as five bytes each; strings
whose minimiser no other text has stay behind. In the bucket of the others,
the suffixes that start at windows with the same minimiser at the same place are
sorted by a mergesort. Suffixes are compared through prefix polynomial hashes: a
binary search finds their common extension in logarithmic time, and the bytes
after it decide. Neighbours that agree over a whole window are then compared
byte by byte, so that a collision of hashes removes nothing.

Slices and buckets both grow with the square root of the input, so that packs,
one for each bucket of a slice, are in proportion to it. Where very many strings
share a minimiser, they are cut once more, by minimisers nearly as long as a
window, and their pieces meet in the buckets of these.
"""

import math
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeseries.llm import superkmers
from lakeseries.llm.rows import as_rows, with_fields
from lakeseries.llm.superkmers import Strings
from lakeseries.llm.vectors import (
    PrefixHash,
    column_bytes,
    equal_strings,
    gathered,
    mix,
    ragged,
    release,
    slices,
    string_hashes,
)

WINDOW = 50
GRAM = 20
PACK_BYTES = 8_192  # of text that a pack stands for
PART_BYTES = 2_000_000  # of a slice that is cut at once
MANY = 16  # strings of a slice that share a minimiser and are counted
SPREAD = 20_000  # strings of all slices, so counted, that are cut once more
SHORTER = 4  # bytes by which the minimisers of that cut are shorter than a window

_NAME = np.uint64(40)
_DOC = 33  # bits of a place in a text, and one more


def common_extension(
    prefix: PrefixHash, left: np.ndarray, right: np.ndarray, length: int
) -> np.ndarray:
    """Length of the common prefix of two suffixes, ``length`` at most."""
    common = np.zeros(len(left), np.int64)
    step = 1 << (int(length).bit_length() - 1)
    while step:
        size = np.minimum(step, length - common)
        equal = prefix.of(left + common, size) == prefix.of(right + common, size)
        common += np.where(equal, size, 0)
        step >>= 1
    return common


def sort_suffixes(
    text: np.ndarray, prefix: PrefixHash, at: np.ndarray, bounds: np.ndarray, length: int
) -> np.ndarray:
    """Order of the suffixes ``at`` by their first ``length`` bytes, group by group.

    ``bounds`` are the first elements of the groups, with the end as last entry.
    The members of a group are compared with its first one: what all of them have
    in common is skipped, and a stable mergesort by the eight bytes that follow
    leaves smaller groups, of those that agree in these too. Equal suffixes keep
    their order.
    """
    order = np.arange(len(at))
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray(len(text) + 1, ">u8", padded.data, strides=(1,))
    sizes = np.diff(bounds)
    many = sizes > 1
    head, sizes = bounds[:-1][many], sizes[many]
    while len(head):
        slot = ragged(head, sizes)
        first = np.cumsum(sizes) - sizes
        own = at[order[slot]]
        common = common_extension(prefix, np.repeat(own[first], sizes), own, length)
        skipped = np.minimum.reduceat(common, first)
        rest = length - skipped
        open_ = rest > 0
        if not open_.all():
            kept = np.repeat(open_, sizes)
            slot, own = slot[kept], own[kept]
            head, sizes, skipped, rest = (x[open_] for x in (head, sizes, skipped, rest))
            if not len(head):
                break
        cut = (8 * np.maximum(8 - rest, 0)).astype(np.uint64)  # bits behind the last byte
        word = words[own + np.repeat(skipped, sizes)].astype(np.uint64)
        word >>= np.repeat(cut, sizes)
        group = np.repeat(np.arange(len(head)), sizes)
        moved = np.lexsort((word, group))
        order[slot] = order[slot[moved]]
        word = word[moved]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
        first = np.flatnonzero(new)
        sizes = np.diff(first, append=len(word))
        many = sizes > 1
        head, sizes = slot[first[many]], sizes[many]
    return order


def _cut(text: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """First byte, length, place of the minimiser and minimiser of every super-k-mer."""
    parts = []
    for lo, hi in slices(bounds, PART_BYTES):
        begin = bounds[lo]
        grams = PrefixHash(text[begin : bounds[hi]]).grams(gram)
        first, last, least = superkmers.runs(grams, bounds[lo : hi + 1] - begin, window, gram)
        parts.append((first + begin, last + window - first, least - first, grams[least]))
    return (np.concatenate(x) for x in zip(*parts, strict=True))


def _super_kmers(texts: pa.ChunkedArray, window: int, gram: int):
    """Bytes and bounds of the texts; first window, length, minimiser, text of each string."""
    text, offsets = column_bytes(texts)
    bounds = offsets - offsets[0]
    text = text[offsets[0] : offsets[-1]]
    first, size, offset, anchor = _cut(text, bounds, window, gram)
    doc = np.searchsorted(bounds, first, "right") - 1
    return text, bounds, first, size, offset, anchor, doc


def _named(anchor: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of every minimiser, and in the last 40 bits its name there."""
    spread = mix(anchor)
    return (spread % np.uint64(n_buckets)) << _NAME | spread >> np.uint64(24)


def _distinct(named: np.ndarray):
    """Distinct names in order with their buckets, and the number of each one given."""
    known, number = np.unique(named, return_inverse=True)
    return known, (known >> _NAME).astype(np.int64), number


def _counted(
    number: np.ndarray, text: np.ndarray, first: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that ``MANY`` different strings have, and how many each one has."""
    rows = np.flatnonzero(np.bincount(number)[number] >= MANY) if len(number) else number
    size = size[rows]
    hashes = string_hashes(gathered(text, first[rows], size), np.cumsum(size) - size, size)
    order = np.lexsort((hashes, number[rows]))
    own, hashes = number[rows][order], hashes[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (hashes[1:] != hashes[:-1])
    many, counts = np.unique(own[new], return_counts=True)
    return many[counts >= MANY], counts[counts >= MANY]


def _minimisers(field: str, window: int, gram: int, n_buckets: int):
    """The minimisers of a slice of texts, five bytes each, and whether two texts share them.

    Those of many strings are counted: their places in the pack and the numbers of strings.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        texts = table.column("_row").combine_chunks().field(field)
        text, _, first, size, _, anchor, doc = _super_kmers(texts, window, gram)
        named, bucket, number = _distinct(_named(anchor, n_buckets))
        ids = table.column("_id").to_numpy()[doc]
        low = np.full(len(named), superkmers.MAX_ID)
        high = np.full(len(named), -superkmers.MAX_ID - 1)
        np.minimum.at(low, number, ids)
        np.maximum.at(high, number, ids)
        several = low < high
        many, counts = _counted(number, text, first, size)
        heads = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(heads[1:], len(bucket))[: len(heads)]
        from_many = np.searchsorted(many, heads)
        packs, counted = [], []
        for i, (lo, hi) in enumerate(zip(heads, ends, strict=True)):
            five = named[lo:hi].view(np.uint8).reshape(-1, 8)[:, :5]
            packs.append(np.packbits(several[lo:hi]).tobytes() + five.tobytes())
            mine = slice(from_many[i], np.searchsorted(many, hi))
            counted.append(np.stack([many[mine] - lo, counts[mine]]).astype(np.uint32).tobytes())
        return pa.table(
            {"bucket": pa.array(bucket[heads], pa.int32()),
             "slice": pa.array(np.full(len(heads), key[0].as_py()), pa.int32()),
             "packed": pa.array(packs, pa.binary()), "counted": pa.array(counted, pa.binary())}
        )

    return run


def _unpacked(pack: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Names and flags of a pack of ``n`` names: ``n`` bits and five bytes each."""
    n = len(pack) * 8 // 41
    flags = -(-n // 8)
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :5] = np.frombuffer(pack, np.uint8, 5 * n, flags).reshape(-1, 5)
    several = np.unpackbits(np.frombuffer(pack, np.uint8, flags), count=n).astype(bool)
    return raw.view(np.uint64).reshape(-1), several


def _shared(spread: int):
    """Which minimisers of a bucket two texts or two slices have, as bits for every slice.

    ``many`` are the places of those that ``spread`` strings have, as counted by slices.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices_, packs, counted, bucket = [], [], [], None
        for batch in batches:
            bucket = batch.column("bucket")[0]
            slices_ += batch.column("slice").to_pylist()
            packs += [_unpacked(x) for x in batch.column("packed").to_pylist()]
            counted += [
                np.frombuffer(x, np.uint32).reshape(2, -1) for x in batch.column("counted").to_pylist()
            ]
        names = np.concatenate([x[0] for x in packs])
        known, number = np.unique(names, return_inverse=True)
        wanted = np.bincount(number, minlength=len(known)) > 1
        wanted[number[np.concatenate([x[1] for x in packs])]] = True
        ends = np.cumsum([len(x[0]) for x in packs])
        starts = ends - [len(x[0]) for x in packs]
        place = np.concatenate([x[0] + at for x, at in zip(counted, starts, strict=True)])
        strings = np.bincount(
            number[place.astype(np.int64)], np.concatenate([x[1] for x in counted]), len(known)
        )
        many = strings >= spread
        out = {"slice": [], "bits": [], "many": []}
        for slice_, lo, hi in zip(slices_, starts, ends, strict=True):
            bits = wanted[number[lo:hi]]
            if bits.any():
                out["slice"].append(slice_)
                out["bits"].append(np.packbits(bits).tobytes())
                out["many"].append(np.flatnonzero(many[number[lo:hi]]).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["slice"], pa.int32()),
             pa.array([bucket.as_py()] * len(out["bits"]), pa.int32()),
             pa.array(out["bits"], pa.binary()), pa.array(out["many"], pa.binary())],
            ["slice", "bucket", "bits", "many"],
        )

    return run


def _cut_again(strings: Strings, many: np.ndarray, window: int, gram: int) -> Strings:
    """The strings ``many`` in pieces, each with the hash of its own, longer minimiser.

    A piece has few bytes besides that, so there are not many different pieces
    with one. Its ``offset`` remains the place of the minimiser of the string.
    """
    few = replace(
        superkmers.chosen(strings, ~many),
        gone_doc=strings.gone_doc, gone_from=strings.gone_from, gone_to=strings.gone_to,
    )
    strings = superkmers.chosen(strings, many)
    bounds = np.concatenate([[0], np.cumsum(strings.length)])
    first, size, _, anchor = _cut(strings.text, bounds, window, max(gram, window - SHORTER))
    owner = np.searchsorted(bounds, first, "right") - 1
    place = first - bounds[owner]
    n_pieces = np.bincount(owner, minlength=len(strings.length))
    per = n_pieces[strings.of]
    of = ragged((np.cumsum(n_pieces) - n_pieces)[strings.of], per)
    text = gathered(strings.text, first, size)
    pieces = replace(
        strings, text=text, length=size, anchor=anchor, offset=strings.offset[owner] - place,
        weight=np.ones(len(size), np.uint8), of=of, doc=strings.doc.repeat(per),
        place=strings.place.repeat(per) + place[of], symbols=size,
    )
    hashes = string_hashes(text, np.cumsum(size) - size, size)
    return superkmers.joined([few, superkmers.collapse(pieces, hashes, by_order=True)])


def _merged_gone(strings: Strings) -> Strings:
    """Ranges that are already known to repeat, as maximal runs."""
    base = strings.gone_doc.astype(np.int64) << _DOC
    lo, hi = base + strings.gone_from, base + strings.gone_to
    if len(lo):
        lo, hi = superkmers.merged(lo, hi)
    doc = lo >> _DOC
    return replace(
        strings, gone_doc=doc, gone_from=lo - (doc << _DOC), gone_to=hi - (doc << _DOC)
    )


def _strings(field: str, window: int, gram: int, n_buckets: int):
    """Packs of the strings of a slice whose minimiser is shared."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, marks: pa.Table) -> pa.Table:
        out = {"bucket": [], "packed": []}
        if table.num_rows and marks.num_rows:
            texts = table.column("_row").combine_chunks().field(field)
            text, bounds, first, size, offset, anchor, doc = _super_kmers(texts, window, gram)
            named, bucket, number = _distinct(_named(anchor, n_buckets))
            wanted = np.zeros(len(named), bool)
            many = np.zeros(len(named), bool)
            at = marks.column("bucket").to_numpy()
            los, his = np.searchsorted(bucket, at), np.searchsorted(bucket, at, "right")
            for lo, hi, bits, places in zip(
                los, his, marks.column("bits").to_pylist(), marks.column("many").to_pylist(), strict=True
            ):
                bits = np.frombuffer(bits, np.uint8)
                wanted[lo:hi] = np.unpackbits(bits, count=hi - lo).astype(bool)
                many[lo + np.frombuffer(places, np.uint32).astype(np.int64)] = True
            keep = np.flatnonzero(wanted[number])
            first, size, offset, anchor, doc = (x[keep] for x in (first, size, offset, anchor, doc))
            n = np.arange(len(keep))
            own = gathered(text, first, size)
            hashes = string_hashes(own, np.cumsum(size) - size, size)
            strings = Strings(
                text=own, length=size, anchor=anchor, offset=offset,
                weight=np.ones(len(n), np.uint8), text_id=table.column("_id").to_numpy(),
                text_variant=table.column("_variant").to_numpy(), of=n, doc=doc,
                place=first - bounds[doc], symbols=size,
                gone_doc=n[:0], gone_from=n[:0], gone_to=n[:0],
            )
            strings = superkmers.collapse(strings, hashes, by_order=True)
            here = many[np.searchsorted(named, _named(strings.anchor, n_buckets))]
            if here.any():
                strings = _cut_again(strings, here, window, gram)
            for at, packed in superkmers.dealt(_merged_gone(strings), n_buckets):
                out["bucket"].append(at)
                out["packed"].append(packed)
            release()
        return pa.table(
            {"bucket": pa.array(out["bucket"], pa.int32()),
             "packed": pa.array(out["packed"], pa.binary())}
        )

    return run


def _parts(gram: int, n_buckets: int, n_parts: int):
    """The strings of a bucket in parts by their minimiser; the first has what is decided."""

    def split(strings: Strings) -> Iterator[Strings]:
        if n_parts == 1:
            yield strings
            return
        starts = np.cumsum(strings.length) - strings.length
        anchor = string_hashes(strings.text, starts + strings.offset, np.full(len(starts), gram))
        part = mix(anchor) // np.uint64(n_buckets) % np.uint64(n_parts)
        for i in range(n_parts):
            chosen = superkmers.chosen(strings, part == i)
            yield chosen if i else replace(
                chosen,
                gone_doc=strings.gone_doc, gone_from=strings.gone_from, gone_to=strings.gone_to,
            )

    return split


def _settle(window: int, gram: int):
    def settle(strings: Strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        text = strings.text
        starts = np.cumsum(strings.length) - strings.length
        hashes = string_hashes(text, starts, strings.length)
        strings = superkmers.collapse(strings, hashes, by_order=True)
        text = strings.text
        starts = np.cumsum(strings.length) - strings.length
        least = np.zeros(len(starts), np.int64)
        least[strings.of] = strings.text_id[strings.doc]

        # Only strings that share their minimiser with a string of another text count.
        anchor = string_hashes(text, starts + strings.offset, np.full(len(starts), gram))
        order = np.argsort(anchor, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = np.diff(anchor[order]) != 0
        head = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        if len(order):
            low = np.minimum.reduceat(least[order], head)
            high = np.maximum.reduceat(least[order], head)
            several = (low < high)[number]
            shared, shared_number = order[several], number[several]
        else:
            shared = shared_number = order

        size = strings.length[shared]
        text = gathered(text, starts[shared], size)
        own = np.repeat(np.arange(len(shared)), size - window + 1)
        place = ragged(np.zeros(len(shared), np.int64), size - window + 1)
        owner = shared[own]
        key = shared_number[own] * window + strings.offset[owner] - place
        by_key = np.argsort(key, kind="stable")
        bounds = np.flatnonzero(np.diff(key[by_key], prepend=-1, append=-1))
        own, owner, place = own[by_key], owner[by_key], place[by_key]
        at = (np.cumsum(size) - size)[own] + place
        ranked = sort_suffixes(text, PrefixHash(text), at, bounds, window)
        owner, place, at = owner[ranked], place[ranked], at[ranked]

        same = np.zeros(len(at), bool)
        pair = np.arange(1, len(at))
        pair = pair[np.diff(key[by_key]) == 0]
        same[pair] = equal_strings(text, at[pair - 1], at[pair], np.full(len(pair), window))
        heads = np.flatnonzero(~same)
        ids = least[owner]
        gone = np.zeros(len(ids), bool)
        if len(heads):
            gone = ids > np.minimum.reduceat(ids, heads)[np.cumsum(~same) - 1]
        owner, place = owner[gone], place[gone]
        in_order = np.lexsort((place, owner))
        owner, place = owner[in_order], place[in_order]
        lo = np.searchsorted(owner, strings.of)
        hits = np.searchsorted(owner, strings.of, "right") - lo
        flat = ragged(lo, hits)
        occurrence = np.repeat(np.arange(len(hits)), hits)
        return superkmers.with_runs(
            strings, occurrence, strings.place[occurrence] + place[flat], window
        )

    return settle


def _kept_bytes(field: str):
    """The texts of a slice without the ranges that go."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, ranges: pa.Table) -> pa.Table:
        ids, variants = ranges.column("_id").to_numpy(), ranges.column("_variant").to_numpy()
        lo, hi = ranges.column("lo").to_numpy(), ranges.column("hi").to_numpy()
        order = np.lexsort((variants, ids))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(ids[order]) != 0) | (np.diff(variants[order]) != 0)
        heads = np.flatnonzero(new)
        of_text = {
            (int(ids[order[a]]), int(variants[order[a]])): order[a:b]
            for a, b in zip(heads, np.append(heads[1:], len(order))[: len(heads)], strict=True)
        }
        rows = table.column("_row").combine_chunks()
        counts, kept = [], []
        keys = zip(table.column("_id").to_pylist(), table.column("_variant").to_pylist(), strict=True)
        for value, text_key in zip(rows.field(field), keys, strict=True):
            text = whole = (value.as_py() or "").encode()
            spans = 0
            if (mine := of_text.get(text_key)) is not None:
                start, end = superkmers.merged(lo[mine], hi[mine])
                spans = len(start)
                cuts = zip([0, *end.tolist()], [*start.tolist(), len(text)], strict=True)
                text = b"".join(text[a:b] for a, b in cuts)
            counts.append((len(whole), len(whole) - len(text), spans))
            kept.append(text)
        numbers = np.array(counts, np.int64).reshape(-1, 3)
        return pa.table(
            {"_row": rows, "n_bytes": numbers[:, 0], "n_removed": numbers[:, 1],
             "n_spans": numbers[:, 2], "kept_bytes": pa.array(kept, pa.binary())}
        )

    return run


def bucket_count(n_parts: int) -> int:
    """Buckets, and slices of texts, for an input of so many parts of ``superkmers.BUCKET_BYTES``."""
    n = math.isqrt(n_parts * superkmers.BUCKET_BYTES // PACK_BYTES)
    return min(n_parts, max(superkmers.MIN_BUCKETS, n))


def without_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                    window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The columns of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_bytes``.

    Texts are taken as UTF-8 bytes. Each byte goes that lies in a string of
    ``window`` bytes that also starts in a text with a smaller id, judged on the
    input. ``n_spans`` counts maximal removed runs. What stays is binary, since
    a run may begin or end within a character.

    Null and empty texts are empty, texts shorter than a window lose nothing.
    A null id counts as the greatest. Rows with the same id never remove from
    each other. Columns named like the new ones are replaced.
    """
    new = ["n_bytes", "n_removed", "n_spans", "kept_bytes"]
    rows = as_rows(docs, [id_column, text], new)
    keyed, n_parts = superkmers.with_key(rows, f"_row.`{id_column}`", f"_row.`{text}`")
    n_buckets = bucket_count(n_parts)
    slice_of = F.pmod(F.xxhash64("_id", "_variant"), F.lit(n_buckets)).cast("int")
    # One exchange of the texts serves all three steps that read them.
    dealt = keyed.select(slice_of.alias("slice"), "_id", "_variant", "_row")
    names = dealt.groupBy("slice").applyInArrow(
        _minimisers(text, window, gram, n_buckets),
        "bucket int, slice int, packed binary, counted binary",
    )
    marks = names.groupBy("bucket").applyInArrow(
        _shared(SPREAD), "slice int, bucket int, bits binary, many binary"
    )
    packs = dealt.groupBy("slice").cogroup(marks.groupBy("slice")).applyInArrow(
        _strings(text, window, gram, n_buckets), "bucket int, packed binary"
    )
    split = _parts(gram, n_buckets, -(-n_parts // n_buckets))
    ranges = superkmers.settled(packs, _settle(window, gram), split)
    ranges = ranges.select(slice_of.alias("slice"), "_id", "_variant", "lo", "hi")
    out = dealt.groupBy("slice").cogroup(ranges.groupBy("slice")).applyInArrow(
        _kept_bytes(text),
        with_fields(rows, "n_bytes long, n_removed long, n_spans long, kept_bytes binary"),
    )
    return out.select("_row.*", *new)
