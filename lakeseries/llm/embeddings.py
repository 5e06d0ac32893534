"""Integer vectors, and sums over all of them that Spark adds up from partial ones.

Matrices as wide as a vector reach the driver; they do not grow with the rows.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 8192  # vectors multiplied at once


def usable(vector: Column) -> Column:
    """Whether a vector is there, without null or non-finite entries; an empty one is."""
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, number), F.lit(False))


def grid(vector: Column, scale: int) -> Column:
    """Entries as the whole numbers ``floor(scale * entry)``; beyond long they are its ends."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows; short ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def width(vectors: DataFrame, column: str) -> int:
    """Entries of the longest vector; 0 without vectors."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _added(vectors: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], shape) -> np.ndarray:
    """Sum over all rows of the float matrices that ``part`` gives for some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for rows in _parts(batch):
                total += part(rows)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(total.ravel()[cells])], ["cell", "amount"]
        )

    sums = vectors.mapInArrow(run, "cell long, amount double").groupBy("cell")
    out = np.zeros(shape)
    for cell, amount in sums.agg(F.sum("amount")).collect():
        out.flat[cell] = amount
    return out


def weights_of(batch: pa.RecordBatch, weight: str | None) -> np.ndarray:
    if weight is None:
        return np.ones(batch.num_rows, np.int64)
    return batch.column(weight).to_numpy(zero_copy_only=False)


def sums(vectors: DataFrame, column: str, d: int, weight: str | None = None) -> tuple[int, list]:
    """Weighted number of vectors, and their sum in every dimension.

    Sums of whole numbers are exact, whatever their size up to 38 digits.
    """
    whole = vectors.schema[column].dataType.elementType.typeName() == "long"
    kind = "decimal(38,0)" if whole else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            for rows in _parts(batch):
                x, w = matrix(rows.column(column), d), weights_of(rows, weight)
                n += int(w.sum())
                if whole and len(x) and float(np.abs(x.astype(float)).max(initial=0)) * float(w.sum()) >= 2.0**62:
                    x, w = x.astype(object), w.astype(object)
                total = [a + b for a, b in zip(total, (x * w[:, None]).sum(0).tolist())]
        amounts = [str(t) for t in total] if whole else [float(t) for t in total]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(-1, d), pa.int64()),
                pa.array([str(n) if whole else float(n), *amounts], pa.string() if whole else pa.float64()),
            ],
            ["cell", "amount"],
        )

    parts = vectors.mapInArrow(run, f"cell long, amount {'string' if whole else 'double'}")
    found = parts.groupBy("cell").agg(F.sum(F.col("amount").cast(kind))).collect()
    by_cell = {cell: int(amount) if whole else amount for cell, amount in found}
    return int(by_cell.get(-1, 0)), [by_cell.get(i, 0) for i in range(d)]


def covariance(
    vectors: DataFrame, column: str, mean: np.ndarray, n: int, weight: str | None = None
) -> np.ndarray:
    """Weighted covariance, divisor ``n``; vectors are centred before they are multiplied."""
    d = len(mean)

    def part(rows: pa.RecordBatch) -> np.ndarray:
        x = matrix(rows.column(column), d) - mean
        return (x * weights_of(rows, weight)[:, None]).T @ x

    return _added(vectors, part, (d, d)) / n


def second_moments(vectors: DataFrame, column: str, d: int) -> np.ndarray:
    """Sum of the products of every two dimensions."""

    def part(rows: pa.RecordBatch) -> np.ndarray:
        x = matrix(rows.column(column), d).astype(float)
        return x.T @ x

    return _added(vectors, part, (d, d))
