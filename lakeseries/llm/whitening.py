"""Whitening of embeddings by the covariance of their distinct vectors.

Equal vectors are grouped first. The fit counts each distinct vector by its
multiplicity or once; the covariance is a sum of centred products that tasks
multiply out for their rows. Every distinct vector is whitened once, and the
result is joined back to the rows.

Rows whose vector is null or holds null or non-finite entries are left out.
Shorter vectors end in zeros. A component without variance has no ``whitened``
value, and a deviation beyond a long is null. Rows that share an id, or have none,
are rows of their own; other columns are not looked at. Without rows the result
is empty. Few wide vectors or very many narrow ones make no difference: tasks
hold some thousand vectors and a square matrix as wide as a vector.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeseries.llm.embeddings import ROWS, covariance, grid, matrix, sums, usable, width
from lakeseries.llm.stores import stored

FLAT = 1e-12  # share of the largest variance below which a component has none

_RESULT = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _deviations(x: np.ndarray, n: int, total: list[int]) -> pa.Array:
    """Sum of ``(n * x - total) ** 2`` over the dimensions, exactly; null beyond a long."""
    if not len(x):
        return pa.array([], pa.int64())
    peak = n * int(np.abs(x.astype(object)).max(initial=0)) + max(map(abs, total), default=0)
    exact = np.int64 if len(total) * peak * peak < 2**63 else object
    centred = x.astype(exact) * n - np.array(total, exact)
    found = (centred * centred).sum(1).tolist()
    return pa.array([int(v) if v < 2**63 else None for v in found], pa.int64())


def _projected(
    vectors: DataFrame, n: int, total: list[int], axes: np.ndarray, scale: np.ndarray
) -> DataFrame:
    """Distinct vectors with their deviation and their whitened values."""
    d, shift = len(total), np.array(total, float) / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                x = matrix(rows.column("x"), d)
                white = np.ascontiguousarray(((x - shift) @ axes) / scale)
                ends = pa.array(np.arange(len(x) + 1) * axes.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("x"),
                        rows.column("copies"),
                        _deviations(x, n, total),
                        pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    ],
                    ["x", "copies", "deviation", "white"],
                )

    return vectors.mapInArrow(
        run, "x array<long>, copies long, deviation long, white array<double>"
    )


def whiten(
    table: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    components: int = 4,
    weights: str = "one",
) -> DataFrame:
    """``components`` whitened values of every row, one row for each of them.

    ``weights`` is ``one`` to fit on each distinct vector once, ``count`` to
    fit on each as often as it occurs; ``n`` is the number of fitted vectors.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights are 'one' or 'count'")
    weight = "copies" if weights == "count" else None
    rows = table.where(usable(F.col(vector))).select(
        F.col(id), grid(F.col(vector), scale).alias("x")
    )
    distinct = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "distinct-vectors")
    d = width(distinct, "x")
    if not d:
        return rows.where("false").selectExpr(
            f"`{id}`", *[f"cast(null as {t}) as {c}" for c, t in (x.split() for x in _RESULT.split(", "))]
        )
    n, total = sums(distinct, "x", d, weight)
    variances = covariance(distinct, "x", np.array(total, float) / n, n, weight)
    values, axes = np.linalg.eigh((variances + variances.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    values, axes, trace = values[order], axes[:, order], float(np.trace(variances))
    spread = values > FLAT * max(values[0], 0)
    spread &= values > 0
    size = np.sqrt(np.where(spread, values, 1))
    white = stored(_projected(distinct, n, total, axes, size), "whitened-vectors")
    _, white_sums = sums(white, "white", len(order), weight)
    left = covariance(white, "white", np.array(white_sums) / n, n, weight)
    left = left[np.ix_(spread, spread)]
    error = float(np.abs(left - np.eye(len(left))).max()) if len(left) else None
    shares = F.array(*[F.lit(float(v) / trace if trace > 0 else None) for v in values])
    known = F.array(*[F.lit(bool(s)) for s in spread])
    each = rows.join(white, "x").select(
        F.col(id), "deviation", F.posexplode("white").alias("at", "value")
    )
    return each.select(
        F.col(id),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(F.get(known, F.col("at")), F.col("value")).alias("whitened"),
        F.get(shares, F.col("at")).cast("double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
