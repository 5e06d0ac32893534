"""Toxic spans and document scores by a linear-chain conditional random field.

Labels name toxic documents; the tokens of the training documents are labelled
from them: over all labelled training documents, a word form or word beginning
is telling if a likelihood ratio test ties it to toxic documents, and a token is
toxic if it is in a toxic document and has a telling feature.

The field has two states. Its emissions are hashed weights of a token's form,
beginnings, ending and neighbour, so new forms of a known stem are found; its
transitions tie neighbours. Forward-backward gives each token's marginal. A
document's score is a logistic function of its greatest marginal, of the sum of
clear marginals and of their density, fitted on documents that the field did not
see. Runs of tokens with a marginal of a half or more are the offending offsets.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeseries.llm.rows import as_rows, with_fields
from lakeseries.llm.samples import draw_texts
from lakeseries.llm.stores import stored
from lakeseries.llm.vectors import PrefixHash, column_bytes, mix, release, run_bounds, slices

SIZE = 1 << 18
SAMPLE = 600  # documents of each label and of each of the two samples
SAMPLE_CHARS = 20_000  # longer documents are in the samples only for want of others
EVIDENCE = 20.0
PRECISION = 0.8
ROUNDS = 60
THRESHOLD = 0.7
CLEAR = 0.3  # marginals that count in sums
CHAIN_BYTES = 3_000_000  # texts whose chains run side by side

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_TELLING = 3  # of the features: form and two beginnings


@dataclass(frozen=True)
class Model:
    """Weights of the field and of the document score."""

    emission: np.ndarray
    bias: float
    start: float
    transition: np.ndarray  # log weights, from state, to state
    document: np.ndarray  # intercept, greatest marginal, log of the sum, density

    @property
    def informed(self) -> bool:
        """Whether the field was fitted, to documents of both labels."""
        return bool(self.emission.any())


def training_row(id_column: str = "doc_id") -> Column:
    """Whether the labels of a row may be used: the others judge the model."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 != 1


def tokens(buffer: np.ndarray, bounds: np.ndarray):
    """Start and end of every token, first token of every text, and hashed features."""
    starts, ends, first = run_bounds(_TOKEN[buffer], bounds)
    prefix = PrefixHash(_LOWER[buffer])
    size = ends - starts
    form = prefix.of(starts, size)
    before = np.zeros(len(form), np.uint64)
    before[1:] = form[:-1]
    before[first[:-1][np.diff(first) > 0]] = 0
    tail = np.minimum(size, 4)
    columns = [
        form,
        prefix.of(starts, np.minimum(size, 5)),
        prefix.of(starts, np.minimum(size, 4)),
        prefix.of(ends - tail, tail),
        before,
    ]
    kinds = [mix(x * np.uint64(8) + np.uint64(i + 1)) for i, x in enumerate(columns)]
    return starts, ends, first, np.stack(kinds, axis=1)


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    everything, offsets = column_bytes(column)
    for a, b in slices(offsets):
        yield a, b, everything[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and toxic documents of every telling feature, summed per slice."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(False)
        for a, b, buffer, bounds in _parts(batch.column("text")):
            _, _, first, features = tokens(buffer, bounds)
            doc = np.repeat(np.arange(b - a), np.diff(first))
            feature = features[:, :_TELLING].reshape(-1)
            doc = np.repeat(doc, _TELLING)
            order = np.lexsort((doc, feature))
            feature, doc = feature[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (feature[1:] != feature[:-1]) | (doc[1:] != doc[:-1])
            known, number = np.unique(feature[new], return_inverse=True)
            hits = np.bincount(number, toxic[a:b][doc[new]] == 1, len(known))
            yield pa.RecordBatch.from_arrays(
                [pa.array(known.view(np.int64)), pa.array(np.bincount(number, minlength=len(known))),
                 pa.array(hits.astype(np.int64))],
                ["feature", "n", "hits"],
            )
        release()


def telling_features(train: DataFrame, among: np.ndarray) -> np.ndarray:
    """Those of the features ``among`` that are tied to toxic documents.

    Counts are from all of ``train`` (``text``, ``toxic``). ``among`` are the features of
    a bounded sample; features outside it are dropped before the shuffle.
    """
    total, toxic = train.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic or toxic == total or not len(among):
        return np.zeros(0, np.int64)
    wanted = train.sparkSession.createDataFrame(pa.table({"feature": pa.array(among, pa.int64())}))
    counts = train.mapInArrow(_feature_counts, "feature long, n long, hits long")
    counts = counts.join(F.broadcast(wanted), "feature", "left_semi")
    counts = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    rest, base = F.col("n") - F.col("hits"), toxic / total
    share = F.col("hits") / F.col("n")
    evidence = 2 * (
        F.col("hits") * F.log(share / base)
        + F.when(rest > 0, rest * F.log((1 - share) / (1 - base))).otherwise(0)
    )
    found = counts.where((F.col("hits") > 0) & (share >= PRECISION) & (evidence >= EVIDENCE))
    return np.array([r["feature"] for r in found.select("feature").collect()], np.int64)


class _Chains:
    """Token sequences side by side: step ``t`` holds the ``t``-th tokens of all texts."""

    def __init__(self, sizes: np.ndarray):
        self.rank = np.argsort(-sizes, kind="stable")
        ordered = sizes[self.rank]
        steps = int(ordered[0]) if len(ordered) else 0
        self.width = len(ordered) - np.searchsorted(ordered[::-1], np.arange(steps), "right")
        self.at = np.concatenate([[0], np.cumsum(self.width)])
        first = np.cumsum(sizes) - sizes
        step = np.repeat(np.arange(steps), self.width)
        column = np.arange(self.at[-1]) - self.at[:-1][step] if steps else np.zeros(0, np.int64)
        self.token = first[self.rank][column] + step  # token of every cell
        self.column, self.step = column, step

    def run(self, odds: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By cell: probability of the toxic state so far, backward ratio, marginal."""
        (a00, a01), (a10, a11) = np.exp(model.transition)
        odds = odds[self.token]
        forward, back = np.empty(len(odds)), np.ones(len(odds))
        at, width = self.at, self.width
        p = None
        for t in range(len(width)):
            e = odds[at[t] : at[t + 1]]
            if t:
                p = p[: width[t]]
                e = e * (p * (a11 - a01) + a01) / (p * (a10 - a00) + a00)
            else:
                e = e * np.exp(model.start)
            p = e / (1 + e)
            forward[at[t] : at[t + 1]] = p
        for t in range(len(width) - 2, -1, -1):
            n = width[t + 1]
            e = odds[at[t + 1] : at[t + 2]] * back[at[t + 1] : at[t + 2]]
            back[at[t] : at[t] + n] = (a10 + a11 * e) / (a00 + a01 * e)
        both = forward * back
        return forward, back, both / (both + 1 - forward)


def _odds(features: np.ndarray, model: Model) -> np.ndarray:
    return np.exp(np.clip(model.emission[features].sum(axis=1) + model.bias, -30, 30))


def _fit_field(features: np.ndarray, first: np.ndarray, gold: np.ndarray) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam on the whole sample."""
    chains = _Chains(np.diff(first))
    y = gold[chains.token].astype(float)
    model = Model(np.zeros(SIZE), -2.0, 0.0, np.zeros((2, 2)), np.zeros(4))
    inner = np.flatnonzero(chains.step > 0)
    ahead = chains.at[chains.step[inner] - 1] + chains.column[inner]
    seen = np.array([[np.sum((y[ahead] == i) & (y[inner] == j)) for j in (0, 1)] for i in (0, 1)])
    theta = np.concatenate([model.emission, [model.bias, model.start], model.transition.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        model = Model(theta[:SIZE], theta[SIZE], theta[SIZE + 1], theta[SIZE + 2 :].reshape(2, 2), None)
        odds = _odds(features, model)
        forward, back, marginal = chains.run(odds, model)
        error = np.zeros(len(gold))
        error[chains.token] = marginal - y
        a = np.exp(model.transition)
        p, e = forward[ahead], odds[chains.token[inner]] * back[inner]
        pairs = np.array([[(1 - p) * a[0, 0], (1 - p) * a[0, 1] * e], [p * a[1, 0], p * a[1, 1] * e]])
        pairs /= pairs.sum(axis=(0, 1))
        grad = np.concatenate([
            np.bincount(features.ravel(), np.repeat(error, features.shape[1]), SIZE),
            [error.sum(), error[first[:-1][np.diff(first) > 0]].sum()],
            (pairs.sum(axis=2) - seen).ravel(),
        ]) + 0.02 * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:SIZE], theta[SIZE], theta[SIZE + 1], theta[SIZE + 2 :].reshape(2, 2), np.zeros(4))


def _document_features(first: np.ndarray, marginal: np.ndarray) -> np.ndarray:
    sizes = np.diff(first)
    out = np.zeros((len(sizes), 4))
    out[:, 0] = 1
    has = sizes > 0
    if has.any():
        # Small marginals of many clean tokens must not add up in long texts.
        clear = np.where(marginal >= CLEAR, marginal, 0)
        total = np.add.reduceat(clear, first[:-1][has])
        out[has, 1] = np.maximum.reduceat(marginal, first[:-1][has])
        out[has, 2] = np.log1p(total)
        out[has, 3] = np.sqrt(total / sizes[has])
    return out


def _fit_documents(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small quadratic penalty."""
    theta = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + penalty @ theta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        theta = theta - np.linalg.solve(curve, grad)
    return theta


def _marginals(features: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    chains = _Chains(np.diff(first))
    out = np.empty(len(features))
    out[chains.token] = chains.run(_odds(features, model), model)[2]
    return out


def _hashed(texts: list[str]):
    data = pa.array(texts, pa.string())
    buffer, offsets = column_bytes(data)
    _, _, first, features = tokens(buffer[offsets[0] : offsets[-1]], offsets - offsets[0])
    return first, features


def fit(train: DataFrame) -> Model:
    """Fit to ``train`` (``doc_id``, ``text``, ``toxic``).

    Feature counts cover all of it. The field and the document score are fitted
    on ``SAMPLE`` documents of each label each (``samples.draw_texts``), texts of more than
    ``SAMPLE_CHARS`` characters only where a label has too few others; that bounds
    what the driver holds. Which labels there are is decided by all rows. Repeated
    rows count as often as they are there. Without two labels the model is not
    ``informed``; it scores every document 0 or 1, whichever is known (0 if none is).
    """
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        known = 30.0 if sizes.get(1) else -30.0
        return Model(np.zeros(SIZE), -30.0, 0.0, np.zeros((2, 2)), np.array([known, 0, 0, 0]))
    rows = []
    for label in (0, 1):
        drawn = draw_texts(train.where(F.col("toxic") == label), 2 * SAMPLE, SAMPLE_CHARS)
        # One document alone serves both samples.
        rows += [(r["draw"], label, r["text"]) for r in (drawn if len(drawn) > 1 else 2 * drawn)]
    rows.sort()
    halves = [[r[1:] for r in rows[i::2]] for i in (0, 1)]
    if any(len({label for label, _ in half}) < 2 for half in halves):
        rows.sort(key=lambda r: r[1])
        halves = [[r[1:] for r in rows[i::2]] for i in (0, 1)]
    y = np.array([r[0] for r in halves[0]])
    first, hashed = _hashed([r[1] for r in halves[0]])
    named = hashed[:, :_TELLING].view(np.int64)
    toxic = np.repeat(y == 1, np.diff(first))
    telling = telling_features(train, np.unique(named[toxic]))
    gold = np.isin(named, telling).any(axis=1) & toxic
    model = _fit_field((hashed % np.uint64(SIZE)).astype(np.int64), first, gold)
    y = np.array([r[0] for r in halves[1]], float)
    first, hashed = _hashed([r[1] for r in halves[1]])
    x = _document_features(first, _marginals((hashed % np.uint64(SIZE)).astype(np.int64), first, model))
    n = {label: max(1, (y == label).sum()) for label in (0, 1)}
    scale = len(y) / sum(sizes.values())
    weight = np.where(y == 1, sizes[1] / n[1], sizes[0] / n[0]) * scale
    document = _fit_documents(x, y, weight)
    release()
    return Model(model.emission, model.bias, model.start, model.transition, document)


def _scored(texts: pa.Array, model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    odds, sizes = [np.zeros(0)], [np.zeros(0, np.int64)]
    for _, _, buffer, bounds in _parts(texts):
        _, _, first, features = tokens(buffer, bounds)
        odds.append(_odds((features % np.uint64(SIZE)).astype(np.int64), model))
        sizes.append(np.diff(first))
    odds, sizes = np.concatenate(odds), np.concatenate(sizes)
    chains = _Chains(sizes)
    marginal = np.empty(len(odds))
    marginal[chains.token] = chains.run(odds, model)[2]
    first = np.concatenate([[0], np.cumsum(sizes)])
    x = _document_features(first, marginal) @ model.document
    hits = np.flatnonzero(marginal >= 0.5)
    at = np.searchsorted(hits, first)
    spans = [[] for _ in range(len(sizes))]
    for i in np.flatnonzero(np.diff(at)).tolist():
        spans[i] = _spans(texts[i].as_py(), hits[at[i] : at[i + 1]] - first[i])
    return 1 / (1 + np.exp(-np.clip(x, -30, 30))), spans


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``docs``, ``score`` (0 to 1) and ``spans``.

    ``spans`` are offsets of code points (``begin``, ``end``) of runs of toxic
    tokens. Null and empty texts have no tokens and get the score of no
    evidence. Texts are scored whole at any length; repeated rows come out as often
    as they are there, with equal scores. Columns named like the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = as_rows(docs, [text], ["score", "spans"])
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = column_bytes(batch.column("_row").field(text))
            for a, b in slices(offsets, CHAIN_BYTES):
                part = batch.column("_row").slice(a, b - a)
                scores, spans = _scored(part.field(text), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part, pa.array(scores), pa.array(spans, span)], ["_row", "score", "spans"]
                )
            release()

    kinds = with_fields(rows, "score double, spans array<struct<begin: long, end: long>>")
    return rows.mapInArrow(run, kinds).select("_row.*", "score", "spans")


def _spans(text: str, hits: np.ndarray) -> list[dict]:
    """Code point offsets of runs of the tokens ``hits``."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = run_bounds(_TOKEN[data], np.array([0, len(data)]))
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    new = np.ones(len(hits), bool)
    new[1:] = np.diff(hits) > 1
    heads = np.flatnonzero(new)
    last = hits[np.append(heads[1:], len(hits)) - 1]
    begin, end = before[starts[hits[heads]]], before[ends[last]]
    return [{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have labels, written once since fitting reads them often.

    Labels grow with the documents, so both sides are always shuffled.
    """
    return stored(docs.hint("merge").join(labels, "doc_id"), "labelled")


def trained(labelled: DataFrame, labels: DataFrame) -> Model:
    """A model of the training rows of ``labelled`` (``doc_id``, ``text``)."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    return fit(with_labels(labelled.select("doc_id", "text").where(training_row()), known))


def train_and_score(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """Score ``docs`` by a model of the training rows of ``labelled`` (``doc_id``, ``text``)."""
    return score(docs, trained(labelled, labels))
