"""As-of join: the last known row of one series at the times of another."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.operators.ordered import PIECE, PLACE, in_pieces, with_carry


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    time: str = "data",
    values: Sequence[str] = ("valor",),
    strict: bool = False,
    tolerance_days: int | None = None,
    suffix: str = "_ref",
    folder: str | None = None,
) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the last row of ``right`` at its time.

    Last is the greatest ``time`` not after that of the left row, or before it if
    ``strict``; of several right rows at one time the greatest by ``values``. The
    time and values of the right row come with ``suffix``; they are null where
    there is none, where it is more than ``tolerance_days`` older, and for a
    left row without key or time. Right rows without key or time count as none.

    What is sorted are the distinct times of both sides: a time that very many
    left rows share is one row there, and meets them again in an equi-join that
    adaptive execution splits.
    """
    names = [f"{c}{suffix}" for c in (time, *values)]
    taken = {c.lower() for c in left.columns} & {c.lower() for c in names}
    if taken:
        raise ValueError(f"left has columns of the result's names: {', '.join(sorted(taken))}")
    point = [*keys, time]
    present = reduce(and_, [F.col(c).isNotNull() for c in point])
    state = F.struct(F.col(time).alias("_t"), *[F.col(v).alias(f"_{i}") for i, v in enumerate(values)])
    known = right.where(present).select(*point, state.alias("_estado"), F.lit(False).alias("_pedido"))
    kind = known.schema["_estado"].dataType
    asked = left.where(present).select(
        *point, F.lit(None).cast(kind).alias("_estado"), F.lit(True).alias("_pedido")
    )
    points = known.unionByName(asked).groupBy(*point).agg(
        F.max("_estado").alias("_estado"), F.max("_pedido").alias("_pedido")
    )
    placed = in_pieces(points, keys, [time], folder)
    newest = F.max_by("_estado", F.when(F.col("_estado").isNotNull(), F.col(PLACE)))
    carried = with_carry(placed, keys, newest, F.last("_resumo", ignorenulls=True))
    inside = (
        Window.partitionBy(*keys, PIECE)
        .orderBy(PLACE)
        .rowsBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    )
    found = F.coalesce(F.last("_estado", ignorenulls=True).over(inside), F.col("_vindo"))
    met = carried.withColumn("_achado", found).where("_pedido").select(*point, "_achado")
    if tolerance_days is not None:
        age = F.datediff(time, "_achado._t")
        met = met.withColumn("_achado", F.when(age <= tolerance_days, F.col("_achado")))
    renamed = met.toDF(*[f"_p{i}" for i in range(len(point))], "_achado")
    same = reduce(and_, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(point)])
    fields = [F.col(f"_achado.{f}").alias(n) for f, n in zip(kind.fieldNames(), names)]
    return left.join(renamed, same, "left").select(*left.columns, *fields)
