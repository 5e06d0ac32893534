"""Plan the yearly extraction windows of each catalog entry."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeseries.functions import catalog_date

INVALID_DATE = "invalid_date"
START_AFTER_END = "start_after_end"


def resolve_requests(catalog: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Catalog rows with typed ``inicio``/``fim`` and an ``erro`` code.

    An absent or empty end date means today.
    """
    end_text = F.nullif(F.col("data_final"), F.lit(""))
    open_end = F.lit(today) if today else F.current_date()
    end = F.when(end_text.isNull(), open_end).otherwise(catalog_date(end_text))
    typed = catalog.select(
        "codigo",
        "nome",
        catalog_date(F.col("data_inicial")).alias("inicio"),
        end.alias("fim"),
    )
    return typed.withColumn(
        "erro",
        F.when(F.col("inicio").isNull() | F.col("fim").isNull(), INVALID_DATE).when(
            F.col("inicio") > F.col("fim"), START_AFTER_END
        ),
    )


def invalid_requests(catalog: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Catalog entries whose interval cannot be requested."""
    requests = resolve_requests(catalog, today)
    return requests.filter(F.col("erro").isNotNull()).select("codigo", "nome", "erro")


def split_by_year(start: Column, end: Column, years: int = 1) -> Column:
    """Array of ``(janela_inicio, janela_fim)`` that covers [start, end].

    A window ends on the anniversary of its start, which belongs to it, and the
    next one starts a day later. Starts therefore drift, and around leap days
    the drift has no closed form, so each window is derived from the one before.
    """
    empty = F.array().cast("array<struct<janela_inicio:date,janela_fim:date>>")
    # A window spans more than `years` years, so this many steps are enough.
    steps = F.sequence(F.lit(0), F.floor((F.year(end) - F.year(start)) / years).cast("int"))

    def extend(windows: Column, _step: Column) -> Column:
        last_end = F.try_element_at(windows, F.lit(-1))["janela_fim"]
        first_day = F.coalesce(F.date_add(last_end, 1), start)
        last_day = F.least(F.add_months(first_day, 12 * years), end)
        window = F.struct(first_day.alias("janela_inicio"), last_day.alias("janela_fim"))
        return F.when(first_day > end, windows).otherwise(
            F.concat(windows, F.array(window))
        )

    return F.when(start <= end, F.aggregate(steps, empty, extend))


def year_windows(
    catalog: DataFrame, years: int = 1, today: dt.date | None = None
) -> DataFrame:
    """One row per (series, window), numbered from 0 in ``ordem``.

    Entries with an invalid interval have no windows and so give no row; see
    :func:`invalid_requests`.
    """
    windows = resolve_requests(catalog, today).select(
        "codigo",
        "nome",
        F.posexplode(split_by_year(F.col("inicio"), F.col("fim"), years)).alias("ordem", "w"),
    )
    return windows.select("codigo", "nome", "ordem", "w.janela_inicio", "w.janela_fim")
