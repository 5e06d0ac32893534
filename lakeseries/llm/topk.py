"""Exact top-k inner products: vectors by falling length, pruned by residual bounds.

Candidates are stored in order of falling length, and rotated onto the singular
vectors of the table, so that the first dimensions hold most of every product.
For a block of queries, given to all tasks, a task goes through its candidates:
a length too small for any query skips them; the product over the first rotated
dimensions plus the product of the lengths of the rests (Cauchy-Schwarz) rules
out most pairs, a second such bound most others, and what is left gets its
exact integer product. The longest vectors give every query a first bound, which
rises with what the task finds.

Equal vectors have equal scores, so of each only the ``k + 1`` smallest ids can
be in a result, and equal queries are searched once; one vector in a third of
all rows costs as much as any other.

A result holds for every query row the ``k`` best other rows; ties go to the
smaller id, rows without an id come last. Vectors that are null or hold null or
non-finite entries take no part; shorter ones end in zeros, so an empty one
scores 0. Rows that share an id are rows of their own, a repeated query row has
its result as often. Other columns are not looked at. Without queries the result
is empty. Scores that may exceed a long raise ``ArithmeticError``.

Per block of ``QUERIES`` a task returns at most ``k + 1`` rows for a query; the
driver holds one block, the ``HEAD`` longest vectors, and a square matrix.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.llm.embeddings import grid, matrix, second_moments, usable, width
from lakeseries.llm.stores import fresh_path, stored

QUERIES = 4096  # distinct queries of a block, about
HEAD = 2048  # longest vectors, which give first bounds
CANDIDATES = 32_768  # candidates of a stored file, about
STEP = 256  # candidates multiplied at once
SHARES = (0.6, 0.9)  # of the squared lengths that each bound's dimensions hold

_PENDING = 200_000
_LAST = np.iinfo(np.int64).max
_FOUND = "query long, vec_id long, score long, same boolean, copies long"


@dataclass
class _Rotation:
    axes: np.ndarray
    cuts: list[int]
    exact: type

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rotated vectors, and the lengths of what lies beyond each cut."""
        turned = x.astype(float) @ self.axes
        return turned, [np.sqrt((turned[:, c:] ** 2).sum(1)) for c in self.cuts]

    def scores(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)


def _rotation(vectors: DataFrame, d: int) -> _Rotation:
    peak = vectors.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0] or 0
    if d * int(peak) ** 2 >= 2**63:
        raise ArithmeticError("inner products of these vectors may exceed a long")
    moments = second_moments(vectors, "x", d)
    values, axes = np.linalg.eigh((moments + moments.T) / 2)
    order = np.argsort(-values)
    held = np.cumsum(np.maximum(values[order], 0))
    share = held / max(held[-1], 1e-300) if d else held
    cuts = sorted({min(d, int(np.searchsorted(share, s)) + 1) for s in SHARES}) if d else [0]
    # Products of whole numbers below 2 ** 53 are exact as doubles too.
    return _Rotation(axes[:, order], cuts, np.float64 if d * int(peak) ** 2 < 2**53 else np.int64)


class _Best:
    """The best rows of each query so far: score, then id, rows without an id last."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self._k = floor.copy(), k
        self._kept = [np.zeros(0, np.int64) for _ in range(6)]
        self._new: list[tuple] = []
        self._waiting = 0

    def add(self, query, score, vec_id, null, same, copies) -> None:
        self._new.append((query, score, vec_id, null, same, copies))
        self._waiting += len(query)
        if self._waiting >= _PENDING:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        if self._new:
            both = [np.concatenate(x) for x in zip(self._kept, *self._new)]
            query, score, vec_id, null = both[:4]
            order = np.lexsort((vec_id, null, -score, query))
            both = [x[order] for x in both]
            query, copies = both[0], both[5]
            ahead = np.cumsum(copies) - copies
            first = np.searchsorted(query, query)
            place = ahead - ahead[first] if len(query) else ahead
            both = [x[place < self._k] for x in both]
            full = place[place < self._k] + both[5] >= self._k
            np.maximum.at(self.floor, both[0][full], both[1][full].astype(float))
            self._kept, self._new, self._waiting = both, [], 0
        return self._kept


def _search(
    queries: np.ndarray, candidates: Iterator[tuple], rotation: _Rotation, floor: np.ndarray, k: int
) -> _Best:
    """Best candidates of every query; candidates are (vectors, ids, nulls, copies)."""
    best = _Best(floor, k)
    queries = queries.astype(rotation.exact)
    turned, rests = rotation.parts(queries)
    length = np.sqrt((queries.astype(float) ** 2).sum(1))
    for x, vec_id, null, copies in candidates:
        for at in range(0, len(x), STEP):
            some = slice(at, at + STEP)
            rows = x[some].astype(rotation.exact)
            c_turned, c_rests = rotation.parts(rows)
            c_length = np.sqrt((rows.astype(float) ** 2).sum(1))
            top = c_length.max()
            slack = 1e-9 * (length * top + 1)
            q = np.flatnonzero(length * top + slack >= best.floor)
            c = np.arange(len(rows))
            known, start = np.zeros((len(q), len(c))), 0
            for cut, q_rest, c_rest in zip(rotation.cuts, rests, c_rests):
                if not len(q) or not len(c):
                    break
                known = known + turned[q, start:cut] @ c_turned[c, start:cut].T
                bound = known + np.multiply.outer(q_rest[q], c_rest[c]) + slack[q, None]
                open_ = bound >= best.floor[q, None]
                rows_open, columns_open = open_.any(1), open_.any(0)
                q, c = q[rows_open], c[columns_open]
                known, open_ = known[rows_open][:, columns_open], open_[rows_open][:, columns_open]
                start = cut
            if not len(q) or not len(c):
                continue
            left, right = np.nonzero(open_)
            if len(left) * 8 > open_.size:
                score = (queries[q] @ rows[c].T)[left, right].astype(np.int64)
            else:
                score = rotation.scores(queries[q[left]], rows[c[right]])
            good = score >= best.floor[q[left]] - (0 if rotation.exact is np.float64 else slack[q[left]])
            left, right, score = q[left[good]], c[right[good]], score[good]
            same = (score.astype(float) >= length[left] ** 2 - slack[left]) & (
                rows[right] == queries[left]
            ).all(1)
            best.add(left, score, vec_id[some][right], null[some][right], same, copies[some][right])
    best.settle()
    return best


def _read(batch: pa.RecordBatch, d: int) -> tuple:
    ids = batch.column("id")
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return (
        matrix(batch.column("x"), d),
        ids.fill_null(_LAST).to_numpy(zero_copy_only=False),
        null,
        batch.column("copies").to_numpy(zero_copy_only=False),
    )


def _arrow(rows: list, schema: str = "x array<long>, id long, copies long") -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r["x"] for r in rows], pa.list_(pa.int64())),
            pa.array([r["id"] for r in rows], pa.int64()),
            pa.array([r["copies"] for r in rows], pa.int64()),
        ],
        ["x", "id", "copies"],
    )


def _with_floor(asked: DataFrame, head: tuple, rotation: _Rotation, d: int, k: int) -> DataFrame:
    """Distinct queries with a score that their ``k`` best candidates reach at least."""
    shared = asked.sparkSession.sparkContext.broadcast(head)  # HEAD vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                rows = batch.slice(at, QUERIES)
                x = matrix(rows.column("x"), d)
                lowest = np.full(len(x), -np.inf)
                floor = _search(x, iter([shared.value]), rotation, lowest, k).floor
                yield pa.RecordBatch.from_arrays(
                    [rows.column("x"), pa.array(floor)], ["x", "floor"]
                )

    return asked.mapInArrow(run, "x array<long>, floor double")


def _found(
    candidates: DataFrame, queries: np.ndarray, names: np.ndarray, floor: np.ndarray,
    rotation: _Rotation, k: int,
) -> tuple[DataFrame, object]:
    """Best candidates of one block of queries, from every task."""
    d = queries.shape[1]
    length2 = (queries.astype(float) ** 2).sum(1)
    least = np.where(floor > 0, floor**2 / np.maximum(length2, 1e-300), 0).min(initial=np.inf)
    shared = candidates.sparkSession.sparkContext.broadcast((queries, names, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, query, lowest = shared.value
        best = _search(x, (_read(b, d) for b in batches), rotation, lowest, k)
        at, score, vec_id, null, same, copies = best.settle()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query[at]),
                pa.array(vec_id, mask=null.astype(bool)),
                pa.array(score),
                pa.array(same.astype(bool)),
                pa.array(copies),
            ],
            ["query", "vec_id", "score", "same", "copies"],
        )

    longest = candidates.where(F.col("length2") >= float(least) * (1 - 1e-9))
    return longest.select("id", "x", "copies").mapInArrow(run, _FOUND), shared


def _first(rows: DataFrame, groups: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def top_products(
    table: DataFrame,
    is_query: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows for every row of ``is_query``.

    The score is the inner product of ``floor(scale * entry)``. ``is_query`` is
    a condition on the id, here named ``id``; rows without an id are no queries.
    """
    spark = table.sparkSession
    numbered = table.where(usable(F.col(vector))).select(
        F.col(id).cast("long").alias("id"), grid(F.col(vector), scale).alias("x")
    )
    # Rows equal in id and vector are one row with copies.
    rows = stored(numbered.groupBy("id", "x").agg(F.count(F.lit(1)).alias("copies")), "vectors")
    asked = rows.where(F.col("id").isNotNull() & is_query)
    empty = "query_id long, rank int, vec_id long, score long"
    n_asked = asked.select("x").distinct().count()
    if not n_asked:
        return spark.createDataFrame([], empty)
    d = width(rows, "x")
    rotation = _rotation(rows, d)
    length2 = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    fewest = _first(rows, ["x"], [F.col("id").asc_nulls_last()], k + 1, "_place").select(
        "id", "x", F.least("copies", F.lit(k + 1)).alias("copies"), length2.alias("length2")
    )
    files = max(spark.sparkContext.defaultParallelism, -(-rows.count() // CANDIDATES))
    falling = F.col("length2").desc()
    candidates = stored(
        fewest.repartitionByRange(files, falling, F.xxhash64("id", "x")).sortWithinPartitions(falling),
        "candidates",
    )
    head = _read(_arrow(candidates.orderBy(falling).limit(HEAD).collect()), d)
    blocks = -(-n_asked // QUERIES)
    bounded = _with_floor(asked.select("x").distinct(), head, rotation, d, k + 1)
    queries = stored(
        bounded.select(
            "x",
            "floor",
            F.monotonically_increasing_id().alias("query"),
            F.pmod(F.xxhash64("x"), F.lit(blocks)).alias("block"),
        ),
        "queries",
    )
    path = fresh_path(spark, "products")
    for block in range(blocks):
        part = queries.where(F.col("block") == block).select("x", "floor", "query").toArrow()
        if not part.num_rows:
            continue
        found, shared = _found(
            candidates,
            matrix(part.column("x"), d),
            part.column("query").to_numpy(),
            part.column("floor").to_numpy(),
            rotation,
            k + 1,
        )
        found.write.mode("append").parquet(path)
        shared.unpersist()
    found = spark.read.schema(_FOUND).parquet(path)
    by_score = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    best = _first(found, ["query"], by_score, k + 1, "_place").drop("_place")
    each = asked.join(queries.select("x", "query"), "x").select(
        F.col("id").alias("query_id"), F.col("copies").alias("asked"), "query"
    )
    own = F.col("same") & (F.col("vec_id") == F.col("query_id"))
    others = F.col("copies") - F.when(own, 1).otherwise(0)
    lists = best.groupBy("query").agg(F.collect_list(F.struct("vec_id", "score", "same", "copies")).alias("best"))
    met = each.join(lists, "query").select("query_id", "asked", "query", F.inline("best"))
    met = met.withColumn("copies", F.least(others, F.lit(k))).where("copies > 0")
    expanded = met.select(
        "query_id", "asked", "query", "vec_id", "score",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    )
    ranked = _first(expanded, ["query_id", "query"], by_score, k, "rank")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("asked")))
    return ranked.select("query_id", "rank", "vec_id", "score", again.alias("_again")).drop("_again")
