"""Order within long series, without a task that holds a whole series.

Rows are sorted over the whole cluster by key and order, so that a long series
lies in many pieces, one after the other, each in one task. What a row needs from
the rows before it has two parts: a window inside its piece, and a carry, which
is worked out over one summary row per piece. Pieces follow the number of rows,
so a series with a third of all rows has a third of the pieces.

The sorted rows are stored once, in ``folder`` or the session's checkpoint folder:
their places must not change while several plans read them. Rows that are equal
in key and order are placed by a hash of their other columns. A null key is a
series of its own.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.sources.work import stored

PLACE, PIECE = "_lugar", "_pedaco"

_IN_PIECE = 33  # low bits of a place: the row's number in its piece
_UNHASHED = ("map", "variant")


def in_pieces(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], folder: str | None = None
) -> DataFrame:
    """The rows, stored in global order, with their ``_lugar`` and ``_pedaco``.

    ``_lugar`` grows with the order; inside a piece it grows by one from row to row.
    """
    others = [f.name for f in rows.schema if f.dataType.typeName() not in _UNHASHED]
    by = [*[F.col(c) for c in (*keys, *order)], F.xxhash64(*others)]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    kept = stored(placed.withColumn(PLACE, F.monotonically_increasing_id()), "pedacos", folder)
    return kept.withColumn(PIECE, F.shiftright(PLACE, _IN_PIECE))


def joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """The columns of ``left``, then the others of ``right``; null keys are equal."""
    names = [f"_chave{i}" for i in range(len(on))]
    keys = [F.col(c).alias(n) for c, n in zip(on, names)]
    renamed = right.select(*keys, *[c for c in right.columns if c not in on])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(on, names)])
    return left.join(renamed, same, how).drop(*names)


def with_carry(placed: DataFrame, keys: Sequence[str], summary: Column, carry: Column) -> DataFrame:
    """Adds ``_vindo``, which ``carry`` makes of the ``_resumo`` of all earlier pieces.

    ``summary`` is an aggregate over a piece, ``carry`` one over ``_resumo``. There
    is a row per key and piece, and a key has at most as many pieces as tasks
    sorted the table.
    """
    pieces = placed.groupBy(*keys, PIECE).agg(summary.alias("_resumo"))
    earlier = (
        Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = pieces.withColumn("_vindo", carry.over(earlier)).drop("_resumo")
    return joined(placed, carried, [*keys, PIECE])


def prefix_sums(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    before: str,
    folder: str | None = None,
) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over all earlier rows of the key; 0 for the first."""
    placed = in_pieces(rows, keys, order, folder)
    total = F.sum(F.coalesce(amount, F.lit(0)))
    carried = with_carry(placed, keys, total, F.sum("_resumo"))
    inside = (
        Window.partitionBy(*keys, PIECE)
        .orderBy(PLACE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    own = total.over(inside)
    none = F.lit(0)
    return carried.withColumn(before, F.coalesce("_vindo", none) + F.coalesce(own, none)).drop(
        "_vindo", PLACE, PIECE
    )


def positions(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: str = "posicao",
    folder: str | None = None,
) -> DataFrame:
    """Adds the row's place in its key, from 0. Needs no window over rows."""
    placed = in_pieces(rows, keys, order, folder)
    piece = F.struct(F.min(PLACE).alias("inicio"), F.count(F.lit(1)).alias("linhas"))
    pieces = placed.groupBy(*keys, PIECE).agg(piece.alias("_resumo"))
    earlier = (
        Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.coalesce(F.sum("_resumo.linhas").over(earlier), F.lit(0)) - F.col("_resumo.inicio")
    offsets = pieces.withColumn("_inicio", first).drop("_resumo")
    met = joined(placed, offsets, [*keys, PIECE])
    return met.withColumn(position, F.col(PLACE) + F.col("_inicio")).drop(PLACE, PIECE, "_inicio")
