"""Ordinal quality by cumulative-link regression on graded ratings.

A text is the mean of its tokens' hashed features: the form of a token, its shape
(letter case, digits, signs), its ending, and whether it repeats the one before.
All grades share one weight per feature; ordered thresholds cut the weighted sum
into grades: ``P(grade <= j) = sigmoid(threshold[j] - sum)``. That gives the
expected grade of a text and the probability of its tail, by which texts are
selected.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeseries.llm.rows import as_rows, with_fields
from lakeseries.llm.samples import draw_texts
from lakeseries.llm.vectors import PrefixHash, column_bytes, mix, release, slices, word_bounds

SIZE = 1 << 16
SAMPLE = 600  # texts of each grade
SAMPLE_CHARS = 20_000  # longer texts are in the sample only for want of others
ROUNDS = 200
KEEP = 0.5
SLICE = 1_000_000  # bytes of texts rated at once

# Shape of a byte: lower case, upper case, digit, beyond ASCII, or the sign itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 97


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades


def features(buffer: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of every token (a row each), and the first token of each text."""
    starts, ends, first = word_bounds(buffer, bounds)
    size = ends - starts
    plain = PrefixHash(buffer)
    form = plain.of(starts, size)
    shape = PrefixHash(_SHAPE[buffer])
    again = np.zeros(len(form), bool)
    again[1:] = form[1:] == form[:-1]
    again[first[:-1][np.diff(first) > 0]] = False
    tail = np.minimum(size, 3)
    columns = [
        form,
        shape.of(starts, np.minimum(size, 6)),
        shape.of(ends - tail, tail),
        plain.of(ends - tail, tail),
        again.astype(np.uint64),
    ]
    kinds = [mix(x * np.uint64(8) + np.uint64(i + 1)) for i, x in enumerate(columns)]
    return (np.stack(kinds, axis=1) % np.uint64(SIZE)).astype(np.int64), first


def _sums(weights: np.ndarray, hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean weight of the tokens of every text, 0 without tokens."""
    sizes = np.diff(first)
    out = np.zeros(len(sizes))
    has = sizes > 0
    if has.any():
        token = weights[hashed].sum(axis=1)
        out[has] = np.add.reduceat(token, first[:-1][has]) / sizes[has]
    return out


def _tails(eta: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """``P(grade > j)`` for every text and threshold."""
    return 1 / (1 + np.exp(-np.clip(eta[:, None] - thresholds[None, :], -30, 30)))


def _means(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and mean count of every feature that a text has."""
    buffer, offsets = column_bytes(pa.array(texts, pa.string()))
    parts = []
    for a, b in slices(offsets, 500_000):
        hashed, first = features(buffer[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        sizes = np.diff(first)
        doc = np.repeat(np.arange(b - a), sizes * hashed.shape[1])
        cell, count = np.unique(doc * SIZE + hashed.ravel(), return_counts=True)
        doc = cell // SIZE
        parts.append((doc + a, cell % SIZE, count / sizes[doc]))
    doc, column, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    return doc, column, value


def _fit(
    doc: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, weight: np.ndarray
) -> Model:
    """Maximum weighted likelihood with a quadratic penalty, by Adam."""
    n_grades = int(grade.max()) + 1
    share = np.array([weight[grade > j].sum() for j in range(n_grades - 1)]) / weight.sum()
    cuts = np.log((1 - share) / share)
    steps = np.log(np.maximum(np.diff(cuts), 1e-3))  # thresholds stay in order
    theta = np.concatenate([np.zeros(SIZE), cuts[:1], steps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(len(grade))
    for step in range(1, ROUNDS + 1):
        thresholds = np.cumsum(np.concatenate([theta[SIZE : SIZE + 1], np.exp(theta[SIZE + 1 :])]))
        eta = np.bincount(doc, theta[column] * value, len(grade))
        tails = _tails(eta, thresholds)
        over = np.concatenate([np.ones((len(grade), 1)), tails, np.zeros((len(grade), 1))], axis=1)
        p = np.maximum(over[rows, grade] - over[rows, grade + 1], 1e-12)
        slope = over * (1 - over)
        d_eta = -weight * (slope[rows, grade] - slope[rows, grade + 1]) / p
        d_cut = np.zeros((len(grade), n_grades + 1))
        d_cut[rows, grade] += weight * slope[rows, grade] / p
        d_cut[rows, grade + 1] -= weight * slope[rows, grade + 1] / p
        d_cut = d_cut.sum(axis=0)[1:-1]
        later = np.cumsum(d_cut[::-1])[::-1]
        grad = np.concatenate([
            np.bincount(column, d_eta[doc] * value, SIZE) + 0.01 * theta[:SIZE],
            later[:1], later[1:] * np.exp(theta[SIZE + 1 :]),
        ])
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    thresholds = np.cumsum(np.concatenate([theta[SIZE : SIZE + 1], np.exp(theta[SIZE + 1 :])]))
    return Model(theta[:SIZE], thresholds)


def fit(rated: DataFrame) -> Model:
    """Fit to ``rated`` (``doc_id``, ``text``, ``grade`` from 0 on).

    At most ``SAMPLE`` texts of each grade (``samples.draw_texts``), those of more than
    ``SAMPLE_CHARS`` characters only where a grade has too few others, are weighted
    back to the shares of all ratings; that bounds what the driver holds. Which
    grades there are is decided by all rows; repeated rows count as often as they
    are there. A grade without texts gets no probability. With fewer than two grades
    all texts get the one that is known.
    """
    rated = rated.where(F.col("grade") >= 0)
    sizes = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}
    top = max(sizes, default=0)
    if len(sizes) < 2:
        return Model(np.zeros(SIZE), np.full(top, -30.0))
    rows = []
    for grade in sorted(sizes):
        drawn = draw_texts(rated.where(F.col("grade") == grade), SAMPLE, SAMPLE_CHARS)
        rows += [(r["draw"], grade, r["text"]) for r in drawn]
    rows.sort()
    grade = np.array([r[1] for r in rows])
    doc, column, value = _means([r[2] for r in rows])
    has = np.bincount(doc, minlength=len(rows)) > 0
    drawn = np.bincount(grade, minlength=top + 1)
    weight = np.array([sizes[g] / drawn[g] for g in grade]) * has
    known = sorted(sizes)  # grades that no text has would have no finite threshold
    scale = weight / max(weight.mean(), 1e-12)
    model = _fit(doc, column, value, np.searchsorted(known, grade), scale)
    release()
    cuts = np.concatenate([[-30.0], model.thresholds])
    return Model(model.weights, np.array([cuts[np.searchsorted(known, j + 1)] for j in range(top)]))


def rate(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``docs``, ``expected_grade`` and ``tails``.

    ``tails`` are the probabilities of a grade above 0, above 1, and so on.
    Null and empty texts have a weighted sum of 0. Texts are rated whole at any
    length; repeated rows come out as often as they are there. Columns named like the new
    ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = as_rows(docs, [text], ["expected_grade", "tails"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            everything, offsets = column_bytes(batch.column("_row").field(text))
            for a, b in slices(offsets, SLICE):
                hashed, first = features(
                    everything[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                )
                tails = _tails(_sums(model.weights, hashed, first), model.thresholds)
                ends = np.arange(b - a + 1) * tails.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(a, b - a), pa.array(tails.sum(axis=1)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tails.ravel()))],
                    ["_row", "expected_grade", "tails"],
                )
            release()

    kinds = with_fields(rows, "expected_grade double, tails array<double>")
    return rows.mapInArrow(run, kinds).select("_row.*", "expected_grade", "tails")
