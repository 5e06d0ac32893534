"""Frames over long series: trailing rows, trailing days, running totals, months.

A series is cut in blocks. A block also gets the rows before it that its frames
reach back to (a halo), so a window partition is one block of one series and not
the whole series.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.operators.ordered import positions, prefix_sums

BLOCK = 10_000  # rows of a block, if the frame is not longer


def _in_blocks(rows: DataFrame, block: Column, in_halo: Column | None = None) -> DataFrame:
    """Rows once in their own block, and once more in the next one's halo."""
    following = block + 1 if in_halo is None else F.when(in_halo, block + 1)
    own = F.struct(block.alias("bloco"), F.lit(True).alias("proprio"))
    halo = F.struct(following.alias("bloco"), F.lit(False).alias("proprio"))
    return rows.withColumn("_lugar", F.explode(F.array(own, halo))).where(
        "_lugar.bloco is not null"
    )


def trailing_rows(
    rows: DataFrame,
    n: int,
    keys: Sequence[str] = ("serie_codigo",),
    order: Sequence[str] = ("data",),
    value: str = "valor",
    folder: str | None = None,
) -> DataFrame:
    """Sum, mean, least, greatest and number of the values of the last ``n`` rows.

    The frame is that of ``ROWS BETWEEN n - 1 PRECEDING AND CURRENT ROW``; null
    values take a place but count for nothing. Rows that are equal in ``order``
    are taken in an order that is the same in every run.
    """
    if n < 1:
        raise ValueError("a frame has one row at least")
    placed = positions(rows, keys, order, "_posicao", folder)
    size = max(n, BLOCK)
    block = F.floor(F.col("_posicao") / size)
    reach = F.col("_posicao") % size > size - n
    frame = (
        Window.partitionBy(*keys, "_lugar.bloco").orderBy("_posicao").rowsBetween(-(n - 1), 0)
    )
    found = _in_blocks(placed, block, reach).withColumns(
        {
            "soma": F.sum(value).over(frame),
            "media": F.avg(value).over(frame),
            "minimo": F.min(value).over(frame),
            "maximo": F.max(value).over(frame),
            "quantidade": F.count(value).over(frame),
        }
    )
    return found.where("_lugar.proprio").drop("_lugar", "_posicao")


def daily_states(
    rows: DataFrame, keys: Sequence[str], date: str = "data", value: str = "valor"
) -> DataFrame:
    """One row per key and day: partial states that frames and sums merge."""
    return rows.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(
        F.sum(value).alias("soma"),
        F.count(value).alias("quantidade"),
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
    )


def trailing_days(
    rows: DataFrame,
    days: int,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    value: str = "valor",
) -> DataFrame:
    """Per key and day that has rows: the values of the last ``days`` days, that day included.

    Days are folded first, so a window partition holds at most ``2 * days`` rows
    however many rows a day has. Rows without a date are left out.
    """
    if days < 1:
        raise ValueError("a frame has one day at least")
    states = daily_states(rows, keys, date, value)
    numbered = states.withColumn("_dia", F.datediff(date, F.lit("1970-01-01").cast("date")))
    frame = (
        Window.partitionBy(*keys, "_lugar.bloco").orderBy("_dia").rangeBetween(-(days - 1), 0)
    )
    held = _in_blocks(numbered, F.floor(F.col("_dia") / days)).withColumns(
        {
            "soma": F.sum("soma").over(frame),
            "quantidade": F.sum("quantidade").over(frame),
            "minimo": F.min("minimo").over(frame),
            "maximo": F.max("maximo").over(frame),
        }
    )
    own = held.where("_lugar.proprio").drop("_lugar", "_dia")
    return own.withColumn("media", F.try_divide("soma", "quantidade"))


def running_totals(
    rows: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    value: str = "valor",
    folder: str | None = None,
) -> DataFrame:
    """Per key and day that has rows: sum and number of all values up to that day."""
    states = daily_states(rows, keys, date, value).select(*keys, date, "soma", "quantidade")
    amounts = prefix_sums(states, keys, [date], "soma", "_soma", folder)
    both = prefix_sums(amounts, keys, [date], "quantidade", "_quantidade", folder)
    return both.select(
        *keys,
        date,
        (F.col("_soma") + F.coalesce("soma", F.lit(0))).alias("acumulado"),
        (F.col("_quantidade") + F.col("quantidade")).alias("quantidade"),
    )


def accumulated_months(
    months: DataFrame,
    n: int = 12,
    code: str = "serie_codigo",
    value: str = "valor_medio",
) -> DataFrame:
    """Adds the sum of the last ``n`` calendar months, and how many of them exist.

    Runs on monthly rows; missing months count for nothing.
    """
    month = F.col("ano") * 12 + F.col("mes")
    frame = Window.partitionBy(code).orderBy(month).rangeBetween(-(n - 1), 0)
    return months.withColumns(
        {"acumulado": F.sum(value).over(frame), "meses": F.count(value).over(frame)}
    )
