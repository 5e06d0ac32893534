"""Substring deduplication: remove every copy of a repeated window of words.

Super-k-mer partitioning: consecutive windows that share a minimiser travel as
one packed string to the bucket of that minimiser. There, sorting counts the
windows. A count compares the words themselves, never hashes alone.
"""

from collections.abc import Iterator

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
    exact_classes,
    gathered,
    mix,
    ragged,
    release,
    slices,
    string_hashes,
    word_bounds,
)

WINDOW = 35
GRAM = 3

_SPACE = np.uint8(32)


def _spaced(buffer: np.ndarray, offsets: np.ndarray):
    """Texts with one space after each word; start of each word, words of each text."""
    starts, ends, words = word_bounds(buffer, offsets)
    lengths = ends - starts + 1
    heads = np.cumsum(lengths) - lengths
    text = np.full(int(lengths.sum()), _SPACE, np.uint8)
    body = np.ones(len(text), bool)
    body[heads + lengths - 1] = False
    text[body] = buffer[ragged(starts, ends - starts)]
    return text, heads, lengths, words


def _cut(window: int, gram: int):
    def cut(batch: pa.RecordBatch) -> Iterator[Strings]:
        ids = batch.column(0).to_numpy()
        variants = batch.column(1).to_numpy()
        everything, offsets = column_bytes(batch.column(2))
        for first_doc, last_doc in slices(offsets):
            lo = offsets[first_doc]
            text, heads, lengths, words = _spaced(
                everything[lo : offsets[last_doc]], offsets[first_doc : last_doc + 1] - lo
            )
            grams = PrefixHash(string_hashes(text, heads, lengths)).grams(gram)
            first, last, least = superkmers.runs(grams, words, window, gram)
            if not len(first):
                continue
            stop = last + window - 1  # last word
            start = heads[first]
            size = heads[stop] + lengths[stop] - start
            doc = np.searchsorted(words, first, "right") - 1
            n = np.arange(len(first))
            strings = Strings(
                text=gathered(text, start, size), length=size, anchor=grams[least],
                offset=least - first, weight=np.ones(len(n), np.uint8),
                text_id=ids[first_doc:last_doc], text_variant=variants[first_doc:last_doc],
                of=n, doc=doc, place=first - words[doc], symbols=stop + 1 - first,
                gone_doc=n[:0], gone_from=n[:0], gone_to=n[:0],
            )
            hashes = mix(PrefixHash(text).of(start, size))
            yield superkmers.collapse(strings, hashes, by_order=False)

    return cut


def _settle(window: int):
    def settle(strings: Strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count every window of the bucket by sorting."""
        starts = np.cumsum(strings.length) - strings.length
        hashes = string_hashes(strings.text, starts, strings.length)
        strings = superkmers.collapse(strings, hashes, by_order=False)
        text = strings.text
        word_end = np.flatnonzero(text == _SPACE) + 1
        heads = np.concatenate([[0], word_end])[:-1].astype(np.int64)
        lengths = word_end - heads
        words = np.concatenate([[0], np.cumsum(strings.symbols)]).astype(np.int64)
        n_windows = strings.symbols - window + 1
        owner = np.repeat(np.arange(len(n_windows)), n_windows)
        at = ragged(words[:-1], n_windows)
        hashes = mix(PrefixHash(string_hashes(text, heads, lengths)).of(at, window))
        start = heads[at]
        size = heads[at + window - 1] + lengths[at + window - 1] - start
        classes = exact_classes(text, start, size, hashes)
        counts = np.bincount(classes, strings.weight[owner], len(classes) or 1)
        repeated = counts[classes] > 1
        # Open occurrences belong to strings seen once; their repeated windows go.
        first_window = np.cumsum(n_windows) - n_windows
        per = n_windows[strings.of]
        flat = ragged(first_window[strings.of], per)
        hit = repeated[flat]
        occurrence = np.repeat(np.arange(len(strings.of)), per)[hit]
        lo = strings.place[occurrence] + (flat - first_window[strings.of].repeat(per))[hit]
        return superkmers.with_runs(strings, occurrence, lo, window)

    return settle


def _parts(batches: Iterator[pa.RecordBatch], text_field: str) -> Iterator[pa.RecordBatch]:
    """The batches by slices of whole texts."""
    for batch in batches:
        offsets = column_bytes(batch.column("_row").field(text_field))[1]
        for first, last in slices(offsets):
            yield batch.slice(first, last - first)
        release()


def _kept_words(text_field: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, text_field):
            kept, counts, removed = [], [], []
            texts = part.column("_row").field(text_field)
            gone = part.column("_gone")
            ends = gone.offsets.to_numpy()
            lo_all, hi_all = (gone.values.field(x).to_numpy(False) for x in ("lo", "hi"))
            for i, text in enumerate(texts):
                words = (text.as_py() or "").encode().split()
                counts.append(len(words))
                if ends[i + 1] > ends[i]:
                    mine = slice(ends[i], ends[i + 1])
                    lo, hi = superkmers.merged(lo_all[mine], hi_all[mine])
                    stay = np.ones(len(words), bool)
                    stay[ragged(lo, hi - lo)] = False
                    words = [words[i] for i in np.flatnonzero(stay)]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), pa.array(counts, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["_row", "n_words", "n_removed", "_kept"],
            )

    return run


def repeated_windows(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                     window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept_text``.

    Words are runs of other bytes than ``\\x20`` and ``\\x09`` to ``\\x0D``, taken
    unchanged. Each word goes that lies in a window of ``window`` words whose
    sequence also starts anywhere else, in the same text or another. All copies
    go, judged on the input. ``kept_text`` joins what stays by one space.

    Null and empty texts have no words, texts shorter than a window lose none.
    Repeated rows are separate texts and so repeat each other. Null ids are
    allowed. Columns named like the new ones are replaced.
    """
    rows = as_rows(docs, [id_column, text], ["n_words", "n_removed", "kept_text"])
    keyed, n_buckets = superkmers.with_key(rows, f"_row.`{id_column}`", f"_row.`{text}`")
    found = superkmers.gone_ranges(keyed, n_buckets, _cut(window, gram), _settle(window))
    out = superkmers.with_gone(keyed, found).mapInArrow(
        _kept_words(text), with_fields(rows, "n_words long, n_removed long, _kept binary")
    )
    return out.select(
        "_row.*", "n_words", "n_removed", F.col("_kept").cast("string").alias("kept_text")
    )
