"""Sessions of a series: runs of dates without long pauses, the gaps between, a calendar.

A run is found in pieces of the sorted dates. Inside a piece a window tells where
runs begin; the first run of a piece may go on from earlier pieces, and its begin
is carried over one summary row per piece. Parts of one run are merged by their
begin, so a series with a third of all dates is in no one task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.operators.ordered import PIECE, PLACE, in_pieces, joined


def series_runs(
    rows: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    value: str = "valor",
    pause_days: int = 1,
    folder: str | None = None,
) -> DataFrame:
    """One row per run: ``inicio``, ``fim``, ``dias``, ``linhas``, ``soma`` and ``fim_anterior``.

    Neighbouring dates of a run are at most ``pause_days`` apart. ``dias`` counts dates
    that have a row, ``linhas`` rows, ``soma`` adds the values that are not null (0
    if all are), and ``fim_anterior`` is the end of the run before, null for
    the first. Rows without a date are in no run; a null key is a series of its own.
    """
    days = rows.where(F.col(date).isNotNull()).groupBy(*keys, F.col(date).alias("_dia")).agg(
        F.count(F.lit(1)).alias("_linhas"), F.coalesce(F.sum(value), F.lit(0.0)).alias("_soma")
    )
    placed = in_pieces(days, keys, ["_dia"], folder)
    piece = [*keys, PIECE]
    inside = Window.partitionBy(*piece).orderBy(PLACE)
    before = F.lag("_dia").over(inside)
    far = F.datediff("_dia", "_antes") > pause_days
    # The first date of a piece begins a part, whatever lies in the piece before.
    begins = F.when(F.col("_antes").isNull() | far, F.col("_dia"))
    parts = (
        placed.withColumn("_antes", before)
        .withColumn("_comeco", begins)
        .withColumn("_comeco", F.last("_comeco", ignorenulls=True).over(inside))
        .groupBy(*piece, "_comeco")
        .agg(
            F.max("_dia").alias("fim"),
            F.count(F.lit(1)).alias("dias"),
            F.sum("_linhas").alias("linhas"),
            F.sum("_soma").alias("soma"),
            # Of the part's first date; of later ones it is no older.
            F.min("_antes").alias("_min_antes"),
            F.count_if(F.col("_antes").isNull()).alias("_primeira"),
        )
    )
    parts = parts.withColumn("_primeira", F.col("_primeira") > 0)
    ends = placed.groupBy(*piece).agg(F.min("_dia").alias("_de"), F.max("_dia").alias("_ate"))
    last_part = parts.groupBy(*piece).agg(
        F.max("_comeco").alias("_ultimo"), F.count(F.lit(1)).alias("_partes")
    )
    over = Window.partitionBy(*keys).orderBy(PIECE)
    came = joined(ends, last_part, piece).withColumn("_vindo", F.lag("_ate").over(over))
    goes_on = F.coalesce(F.datediff("_de", "_vindo") <= pause_days, F.lit(False))
    # The begin of the run that is open at the end of a piece, if it begins there.
    own = F.when((F.col("_partes") > 1) | ~goes_on, F.col("_ultimo"))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    came = came.select(
        *piece, "_vindo", goes_on.alias("_segue"),
        F.last(own, ignorenulls=True).over(earlier).alias("_origem"),
    )
    met = joined(parts, came, piece)
    continued = F.col("_primeira") & F.col("_segue")
    previous = F.when(F.col("_primeira"), F.col("_vindo")).otherwise(F.col("_min_antes"))
    return (
        met.withColumn("inicio", F.when(continued, F.col("_origem")).otherwise(F.col("_comeco")))
        .withColumn("fim_anterior", F.when(~continued, previous))
        .groupBy(*keys, "inicio")
        .agg(
            F.max("fim").alias("fim"),
            F.sum("dias").alias("dias"),
            F.sum("linhas").alias("linhas"),
            F.sum("soma").alias("soma"),
            F.max("fim_anterior").alias("fim_anterior"),
        )
    )


def series_gaps(
    rows: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    value: str = "valor",
    pause_days: int = 1,
    folder: str | None = None,
) -> DataFrame:
    """Stretches without a row between two runs: ``falta_de``, ``falta_ate``, ``dias``."""
    runs = series_runs(rows, keys, date, value, pause_days, folder)
    between = runs.where("fim_anterior is not null")
    return between.select(
        *keys,
        F.date_add("fim_anterior", 1).alias("falta_de"),
        F.date_sub("inicio", 1).alias("falta_ate"),
        (F.datediff("inicio", "fim_anterior") - 1).alias("dias"),
    )


def _month(date: str | Column) -> Column:
    return F.trunc(date, "month")


def month_spine(
    rows: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    value: str = "valor",
) -> DataFrame:
    """Every month from a series' first to its last, with ``quantidade`` (0: missing) and ``soma``.

    ``sem_dados`` counts the missing months right before a month that has rows. Rows are
    folded into months first, and windows hold the months of a series.
    """
    months = rows.where(F.col(date).isNotNull()).groupBy(*keys, _month(date).alias("mes")).agg(
        F.count(F.lit(1)).alias("quantidade"), F.sum(value).alias("soma")
    )
    order = Window.partitionBy(*keys).orderBy("mes")
    # Each month brings the missing ones before it: no second pass over the series.
    before = F.coalesce(F.add_months(F.lag("mes").over(order), 1), F.col("mes"))
    filled = months.withColumn("_meses", F.sequence(before, F.col("mes"), F.expr("interval 1 month")))
    lacking = (F.size("_meses") - 1).alias("sem_dados")
    spread = filled.select(*keys, "mes", "quantidade", "soma", lacking, F.explode("_meses").alias("_mes"))
    there = F.col("_mes") == F.col("mes")
    return spread.select(
        *keys,
        F.col("_mes").alias("mes"),
        F.when(there, F.col("quantidade")).otherwise(0).alias("quantidade"),
        F.when(there, F.col("soma")).alias("soma"),
        F.when(there, F.col("sem_dados")).otherwise(0).alias("sem_dados"),
    )
