"""Vector helpers over batches of texts, used inside tasks.

Texts of a batch lie one after the other in a byte buffer. Hashes of substrings
come from prefix sums ``sum(value[i] * BASE**i)`` modulo 2**64: the difference
of two sums, divided by ``BASE**start``, depends on the substring alone.
"""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1_000_000

_ONE = np.uint64(1)
_tables: dict[str, np.ndarray] = {}


try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018
except (OSError, AttributeError):  # another C library
    _LIBC = None


def release() -> None:
    """Give freed memory back, so that workers of several stages stay small."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; every bit depends on every other."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _powers(name: str, base: int, n: int) -> np.ndarray:
    table = _tables.get(name)
    if table is None or len(table) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        table = np.full(size, base, np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        if size <= 1 << 22:  # tables of huge texts are not kept
            _tables[name] = table
    return table[:n]


class PrefixHash:
    """Hashes of substrings of a sequence of numbers."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._inverse = _powers("inverse", pow(BASE, -1, 1 << 64), n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        terms = values.astype(np.uint64)
        terms += _ONE
        terms *= _powers("base", BASE, n + 1)[:n]
        np.cumsum(terms, out=self._sums[1:])

    def of(self, starts: np.ndarray, lengths) -> np.ndarray:
        """Hash of each substring; equal substrings have equal hashes."""
        return (self._sums[starts + lengths] - self._sums[starts]) * self._inverse[starts]

    def grams(self, n: int) -> np.ndarray:
        """Mixed hash of the ``n`` values at every position."""
        size = max(0, len(self._sums) - n)
        return mix((self._sums[n : n + size] - self._sums[:size]) * self._inverse[:size])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buffer, offsets


def slices(
    offsets: np.ndarray, limit: int = SLICE_BYTES, texts: int = 1 << 30
) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes and ``texts`` texts, one at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, first + texts, max(first + 1, last))
        yield first, last
        first = last


def run_bounds(
    inside: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of true bytes, and the first run of each text.

    Runs end where texts do. ``offsets`` start at 0. The last array has an entry
    more than texts.
    """
    before = np.empty(len(inside) + 1, bool)
    before[0] = False
    before[1:] = inside
    before[offsets] = False
    after = np.empty(len(inside) + 1, bool)
    after[:-1] = inside
    after[-1] = False
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_bounds(
    buffer: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of words: runs of bytes other than ``\\x20`` and ``\\x09`` to ``\\x0D``."""
    return run_bounds(~((buffer == 32) | ((buffer >= 9) & (buffer <= 13))), offsets)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[: len(values) - (width - size)], values[width - size :])
    return values


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of all ranges, one after the other."""
    total = int(lengths.sum())
    steps = np.ones(total, np.int64)
    full = lengths > 0
    starts, lengths = starts[full], lengths[full]
    if not total:
        return steps
    steps[0] = starts[0]
    heads = np.cumsum(lengths)[:-1]
    steps[heads] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(steps)


_CHUNK = 500_000


def _chunks(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of strings of about ``_CHUNK`` bytes, one string at least."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return slices(bounds, _CHUNK)


def gathered(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The strings at ``starts``, one after the other."""
    out = np.empty(int(lengths.sum()), text.dtype)
    at = 0
    for first, last in _chunks(lengths):
        part = text[ragged(starts[first:last], lengths[first:last])]
        out[at : at + len(part)] = part
        at += len(part)
    return out


def string_hashes(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mixed hash of every string; ``starts`` ascend and strings do not overlap."""
    out = np.empty(len(starts), np.uint64)
    for first, last in _chunks(lengths):
        lo = starts[first]
        prefix = PrefixHash(text[lo : starts[last - 1] + lengths[last - 1]])
        out[first:last] = prefix.of(starts[first:last] - lo, lengths[first:last])
    return mix(out)


def equal_strings(
    buffer: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Whether the byte strings at ``left`` and at ``right`` are the same."""
    out = np.ones(len(left), bool)
    for first, last in _chunks(lengths):
        size = lengths[first:last]
        other = buffer[ragged(left[first:last], size)] != buffer[ragged(right[first:last], size)]
        owner = np.searchsorted(np.cumsum(size), np.flatnonzero(other), "right")
        out[first + owner] = False
    return out


def exact_classes(
    buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray
) -> np.ndarray:
    """Number of the class of equal strings for each string.

    Strings are sorted by hash, and each one is compared with its class, so that
    a collision of hashes never joins two different strings.
    """
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    same = np.flatnonzero(~new)
    member, first = order[same], head[same]
    equal = lengths[member] == lengths[first]
    pair = np.flatnonzero(equal)
    equal[pair] = equal_strings(buffer, starts[member[pair]], starts[first[pair]], lengths[member[pair]])
    classes = np.empty(len(order), np.int64)
    classes[order] = head
    names: dict[bytes, int] = {}
    for i in member[~equal].tolist():  # collisions of hashes
        text = buffer[starts[i] : starts[i] + lengths[i]].tobytes()
        classes[i] = names.setdefault(text, i)
    return classes
