"""Tokens of two tokenizers aligned by the byte offsets at which both end one.

Each text is encoded by byte-level BPE (A) and by a piece model (B). The ids
of a batch lie flattened in Arrow, with the index of their document; a running
sum of token bytes, less the bytes before the document, gives the place where
a token ends. A hash join of A and B on (document, end) finds the links; they cut
the tokens into groups. Tasks count their pairs with ``Table.group_by``, and Spark
adds up these partial counts.

The scores of a document need the corpus-wide counts of its pairs. Up to
``LOOKUP`` different pairs are sent to all tasks; more are joined by a
shuffle, of one row per document and different pair. Both give the same result.

Null and empty texts, and texts whose tokens do not give back a space and the
text, have no tokens: zeros and an empty string. Rows that share an id, or have
none, are rows of their own; repeated texts count each time. Equal counts of a B
id are all its best. Long texts are encoded in parts, cut where no token of
either tokenizer can lie across; a task holds the tokens of one text at least.
Columns of any name pass through, but those named like a result are replaced;
there must be one besides the text.
"""

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeseries.llm.rows import as_rows, with_fields
from lakeseries.llm.stores import stored
from lakeseries.llm.vectors import column_bytes, gathered, release, slices

LOOKUP = 2_000_000  # different pairs, 17 bytes each, that are sent to all tasks
SLICE = 500_000  # bytes encoded at once, those of one text at least
PART = 100_000  # characters of a part of a long text, about
_PARTIAL = 500_000  # different pairs that a task counts before it hands them on

_LETTER = "[A-Za-zÀ-ÖØ-öø-ɏΑ-ωЀ-ӿ]"
# Between letters a space starts a token of A, and no piece of B goes on over it.
_CUT = re.compile(f"(?<={_LETTER}) (?={_LETTER})")
_SPACE = "▁"
# What the byte-level pre-tokenizer splits by; it is a fixed value.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLANKS = re.compile(r"\s{1000}")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for characters from 256 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class _Vocabulary:
    """Bytes and decimal text of every id."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.text = pa.array([str(i) for i in range(len(tokens))])


class _Pair:
    """Both tokenizers, as loaded in a worker."""

    def __init__(self, json_text: str, model: bytes):
        import sentencepiece

        self._json_text = json_text
        self._b = sentencepiece.SentencePieceProcessor(model_proto=model)
        file, byte = json.loads(json_text), byte_alphabet()
        entries = dict(file["model"]["vocab"])
        entries.update((t["content"], t["id"]) for t in file["added_tokens"])
        tokens = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            tokens[number] = bytes(byte[c] for c in entry)
        self.a = _Vocabulary(tokens)
        self._ranked = self._by_rank(file, byte)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b = _Vocabulary(
            [
                bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace(_SPACE, " ").encode()
                for i, p in enumerate(pieces)
            ]
        )

    @cached_property
    def _a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        tokenizer = tokenizers.Tokenizer.from_str(self._json_text)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @staticmethod
    def _by_rank(file: dict, byte: dict[str, int]):
        """The same encoder by ranks, a third of the work; None where ids are not in merge order."""
        import tiktoken

        model, split = file["model"], file["pre_tokenizer"] or {}
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        first = len(ids) - len(pairs)
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True)
        plain = plain and not split.get("add_prefix_space") and not file["normalizer"]
        if not plain or any(ids[a + b] != first + i for i, (a, b) in enumerate(pairs)):
            return None
        ranks = {bytes(byte[c] for c in entry): i for entry, i in ids.items()}
        return tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _encode_a(self, text: str) -> list[int]:
        # Very long runs of blanks are too deep for the pattern of the ranked encoder.
        if self._ranked is None or _BLANKS.search(text):
            return self._a.encode(text, add_special_tokens=False).ids
        return self._ranked.encode_ordinary(text)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B; each text starts with the space that B adds itself."""
        a = [self._encode_a(t) for t in texts]
        return a, self._b.encode([t[1:] for t in texts], num_threads=1)


_workers: dict[bytes, _Pair] = {}


def _loaded(files) -> _Pair:
    name, json_text, model = files.value
    if name not in _workers:
        _workers.clear()
        _workers[name] = _Pair(json_text, model)
    return _workers[name]


def parts(text: str) -> list[str]:
    """A text that starts with a space in parts that do so too and are encoded alone."""
    out, start = [], 0
    while len(text) - start > PART:
        cut = _CUT.search(text, start + PART)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def _lists(ids: list[list[int]], owner: list[int], n: int) -> pa.ListArray:
    """Ids of each of ``n`` documents; part ``i`` belongs to document ``owner[i]``."""
    sizes = np.bincount(owner, [len(x) for x in ids], n).astype(np.int64) if ids else np.zeros(n, int)
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum()))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _spells(lists: pa.ListArray, words: _Vocabulary, texts: list[bytes]) -> np.ndarray:
    """Whether the bytes of each document's tokens are its text."""
    ids = lists.flatten().to_numpy()
    bounds = lists.offsets.to_numpy()
    whole = gathered(words.bytes, words.start[ids], words.length[ids]).tobytes()
    ends = np.concatenate([[0], np.cumsum(words.length[ids])])[bounds]
    return np.array([whole[ends[i] : ends[i + 1]] == t for i, t in enumerate(texts)], bool)


def _kept(lists: pa.ListArray, good: np.ndarray) -> pa.ListArray:
    if good.all():
        return lists
    return pc.if_else(pa.array(good), lists, pa.scalar([], lists.type))


def _ended(lists: pa.ListArray, words: _Vocabulary, name: str) -> pa.Table:
    """Every token with the key of its end: the document and the offset in it."""
    ids, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    size = pa.array(words.length).take(ids)
    total = pc.cumulative_sum(size)
    before = np.concatenate([[0], total.to_numpy()])[lists.offsets.to_numpy()[:-1]]
    end = pc.subtract(total, pa.array(before).take(parent))
    key = pc.add(pc.shift_left(parent.cast(pa.int64()), 40), end)
    at = pa.array(np.arange(len(ids), dtype=np.int64))
    return pa.table({"key": key, name: ids, f"{name}_at": at})


def _grouped(words: _Vocabulary, ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """Ids of each group as text; groups end at the given places."""
    bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(bounds, words.text.take(ids)), ",")


def _aligned(pair: _Pair, texts: list[str | None]) -> dict[str, pa.Array]:
    n = len(texts)
    spaced = [" " + t if t else "" for t in texts]
    owner, pieces = [], []
    for i, text in enumerate(spaced):
        for part in parts(text) if text else []:
            owner.append(i)
            pieces.append(part)
    a_ids, b_ids = pair.encode(pieces)
    a, b = _lists(a_ids, owner, n), _lists(b_ids, owner, n)
    raw = [t.encode() for t in spaced]
    good = _spells(a, pair.a, raw) & _spells(b, pair.b, raw)
    a, b = _kept(a, good), _kept(b, good)
    links = _ended(a, pair.a, "a").join(
        _ended(b, pair.b, "b"), keys="key", join_type="inner", use_threads=False
    )
    links = links.sort_by([("key", "ascending"), ("a_at", "ascending"), ("b_at", "ascending")])
    key = links["key"].to_numpy()
    last = np.ones(len(key), bool)  # of the links of one end
    last[:-1] = key[1:] != key[:-1]
    group_of = key[last] >> 40
    groups = pc.binary_join_element_wise(
        _grouped(pair.a, pc.list_flatten(a), links["a_at"].to_numpy()[last] + 1),
        _grouped(pair.b, pc.list_flatten(b), links["b_at"].to_numpy()[last] + 1),
        "|",
    )
    by_doc = np.arange(n + 1)
    group_ends = np.searchsorted(group_of, by_doc)
    link_ends = np.searchsorted(key >> 40, by_doc)
    codes = (links["a"].to_numpy().astype(np.int64) << 32) | links["b"].to_numpy()
    texts_of = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(group_ends.astype(np.int32)), groups), ";"
    )
    return {
        "n_a": pc.list_value_length(a).cast(pa.int64()),
        "n_b": pc.list_value_length(b).cast(pa.int64()),
        "n_groups": pa.array(np.diff(group_ends).astype(np.int64)),
        "groups": texts_of,
        "links": pa.ListArray.from_arrays(pa.array(link_ends.astype(np.int32)), pa.array(codes)),
    }


def _apart(table: DataFrame, column: str, new: list[str]) -> DataFrame:
    """The other columns as one struct ``_row``, and ``column``, which is not carried on."""
    rows = as_rows(table, [column], new)
    return rows.select(F.col("_row").dropFields(f"`{column}`").alias("_row"), f"_row.`{column}`")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, numbers of tokens and groups, ``groups`` and ``links``.

    A group is ``a1,a2|b1``, the ids that lie between two common ends; groups
    are joined by ``;``. A link is ``a * 2 ** 32 + b``. The driver reads
    both files, executors get their content.
    """
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        json_text, model = a_file.read(), b_file.read()
    name = hashlib.sha256(json_text.encode() + b"\0" + model).digest()
    files = docs.sparkSession.sparkContext.broadcast((name, json_text, model))  # two vocabularies
    new = ["n_a", "n_b", "n_groups", "groups", "links"]
    rows = _apart(docs, text, new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _loaded(files)
        for batch in batches:
            own = batch.column("_row")
            texts = batch.column(text)
            for first, last in slices(column_bytes(texts)[1], SLICE):
                found = _aligned(pair, texts.slice(first, last - first).to_pylist())
                release()
                yield pa.RecordBatch.from_arrays(
                    [own.slice(first, last - first), *found.values()], ["_row", *found]
                )

    kind = with_fields(rows, "n_a long, n_b long, n_groups long, groups string, links array<long>")
    return rows.mapInArrow(run, kind).select("_row.*", *new)


def _counted(table: pa.Table, keys: list[str]) -> pa.Table:
    found = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return found.select([*keys, "n_sum"]).rename_columns([*keys, "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, b, n, best``: links of every id pair, and whether its B id has no better one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
        total = kind.empty_table()
        for batch in batches:
            pair = pc.list_flatten(batch.column("links"))
            one = pa.table({"pair": pair, "n": pa.array(np.ones(len(pair), np.int64))}, kind)
            total = _counted(pa.concat_tables([total, _counted(one, ["pair"])]), ["pair"])
            if total.num_rows > _PARTIAL:
                yield from total.to_batches()
                total = kind.empty_table()
        yield from total.to_batches()

    partial = aligned.select("links").mapInArrow(run, "pair long, n long")
    counts = stored(
        partial.groupBy("pair").agg(F.sum("n").alias("n")).select(
            "pair", F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "n"
        ),
        "pair-counts",
    )
    # At most as many rows as B has ids.
    most = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("most")))
    return counts.join(most, "b").select("pair", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _by_lookup(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.select("pair", "n", "best").toArrow()
    pair = table["pair"].to_numpy()
    order = np.argsort(pair)
    columns = (pair[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order])
    shared = aligned.sparkSession.sparkContext.broadcast(columns)  # LOOKUP rows at most
    rows = _apart(aligned, "links", ["n_best", "count_sum"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            own = batch.column("_row")
            lists = batch.column("links")
            ends = lists.offsets.to_numpy()
            at = np.searchsorted(known, lists.values[ends[0] : ends[-1]].to_numpy())
            sums = []
            for amount in (best[at].astype(np.int64), n[at]):
                total = np.concatenate([[0], np.cumsum(amount)])
                sums.append(pa.array(np.diff(total[ends - ends[0]])))
            yield pa.RecordBatch.from_arrays([own, *sums], ["_row", "n_best", "count_sum"])

    kind = with_fields(rows, "n_best long, count_sum long")
    return rows.mapInArrow(run, kind).select("_row.*", "n_best", "count_sum")


def _by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a shuffle; ``aligned`` must be a stored table with its row names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("links")
            pair = pc.list_flatten(lists)
            one = pa.table(
                {
                    "_name": batch.column("_name").take(pc.list_parent_indices(lists)),
                    "pair": pair,
                    "n": pa.array(np.ones(len(pair), np.int64)),
                }
            )
            found = _counted(one, ["_name", "pair"]).rename_columns(["_name", "pair", "times"])
            yield from found.to_batches()

    each = aligned.select("_name", "links").mapInArrow(run, "_name long, pair long, times long")
    scored = each.join(counts, "pair").groupBy("_name").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    none = F.lit(0).cast("long")
    return aligned.drop("links").join(scored, "_name", "left").withColumns(
        {c: F.coalesce(c, none) for c in ("n_best", "count_sum")}
    )


def with_scores(aligned: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum``, by the links of all documents, instead of ``links``.

    ``links`` are those of ``align``. Columns of the new names are replaced.
    """
    named = aligned.drop("n_best", "count_sum", "_name").withColumn(
        "_name", F.monotonically_increasing_id()
    )
    named = stored(named, "aligned")
    counts = stored(pair_counts(named), "pairs")
    score = _by_lookup if counts.count() <= LOOKUP else _by_join
    return score(named, counts).drop("_name")
