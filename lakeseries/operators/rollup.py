"""Aggregate states of series and months, merged into coarser levels.

A state holds what a mean, a range, the first and last value and a number of
distinct days need, in one row per series and month. States of parts of the data
are merged by the same aggregates, so they can be stored and added to; coarser
levels are made of states and never read the observations again. No level is a
mean of means.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_KEYS = ("serie_codigo", "serie_nome", "ano", "trimestre", "mes")
LEVELS = {
    "mes": MONTH_KEYS,
    "trimestre": MONTH_KEYS[:4],
    "ano": MONTH_KEYS[:3],
    "serie": MONTH_KEYS[:2],
    "total": (),
}
CUBE = {
    "serie_e_ano": ("serie_codigo", "serie_nome", "ano"),
    "serie": ("serie_codigo", "serie_nome"),
    "ano": ("ano",),
    "total": (),
}


def _merged() -> list[Column]:
    """Aggregates that merge states into one."""
    return [
        F.sum("soma").alias("soma"),
        F.sum("quantidade").alias("quantidade"),
        F.min("minimo").alias("minimo"),
        F.max("maximo").alias("maximo"),
        F.min("primeira").alias("primeira"),
        F.max("ultima").alias("ultima"),
    ]


def month_states(
    rows: DataFrame,
    code: str = "serie_codigo",
    name: str = "serie_nome",
    date: str = "data",
    value: str = "valor",
) -> DataFrame:
    """One state per series and month of ``rows``.

    Rows without a date or a value are in no state. ``primeira`` and ``ultima`` are the
    first and last date with their values; of several values on a first date the least
    counts, on a last date the greatest. ``dias`` has a bit for each day of the month
    that has a value. The sum is a double: for amounts that are not whole its last
    bits depend on the order in which parts are added.
    """
    known = rows.where(F.col(date).isNotNull() & F.col(value).isNotNull())
    point = F.struct(F.col(date).alias("data"), F.col(value).alias("valor"))
    return known.groupBy(
        F.col(code).alias("serie_codigo"),
        F.col(name).alias("serie_nome"),
        F.year(date).alias("ano"),
        F.quarter(date).alias("trimestre"),
        F.month(date).alias("mes"),
    ).agg(
        F.sum(value).alias("soma"),
        F.count(value).alias("quantidade"),
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
        F.min(point).alias("primeira"),
        F.max(point).alias("ultima"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.day(date) - 1)).alias("dias"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """States of parts of the data (a union of them) as states of all of it."""
    return states.groupBy(*MONTH_KEYS).agg(*_merged(), F.bit_or("dias").alias("dias"))


def grouped(states: DataFrame, levels: Mapping[str, Sequence[str]] = LEVELS) -> DataFrame:
    """The aggregates of every level, from states of months.

    ``levels`` gives the keys of each level; keys that a level lacks are null, and
    ``nivel`` names it. A day counts once in ``dias``, however many values or series
    it has: months are merged by their bits first, and then the bits are counted.
    States need not be merged before. Without states no level has a row.
    """
    keys = [k for k in MONTH_KEYS if any(k in of for of in levels.values())]
    lacking = {
        name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in of)
        for name, of in levels.items()
    }
    if len(set(lacking.values())) < len(lacking):
        raise ValueError("two levels have the same keys")
    # Two copies of the month: one that levels may lack, one that all keep.
    month = states.withColumn("_mes", F.col("ano") * 12 + F.col("mes"))
    by_month = month.groupingSets(
        [[F.col(k) for k in [*of, "_mes"]] for of in levels.values()],
        *[F.col(k) for k in [*keys, "_mes"]],
    ).agg(F.grouping_id().alias("_nivel"), *_merged(), F.bit_or("dias").alias("dias"))
    level = F.coalesce(
        # The month is the last key and never lacks: its bit is 0.
        *[F.when(F.col("_nivel") == 2 * bits, F.lit(name)) for name, bits in lacking.items()]
    )
    found = by_month.groupBy(level.alias("nivel"), *keys).agg(
        *_merged(), F.sum(F.bit_count("dias")).alias("dias")
    )
    return found.select(
        "nivel", *keys, "soma", "quantidade",
        (F.col("soma") / F.col("quantidade")).alias("media"), "minimo", "maximo",
        F.col("primeira.data").alias("primeira_data"), F.col("primeira.valor").alias("primeiro_valor"),
        F.col("ultima.data").alias("ultima_data"), F.col("ultima.valor").alias("ultimo_valor"),
        "dias",
    )
