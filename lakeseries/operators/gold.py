"""Monthly aggregates per series and their side-by-side comparison."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.functions import percent_change


def monthly_totals(
    rows: DataFrame,
    code: str = "serie_codigo",
    name: str = "serie_nome",
    date: str = "data",
    value: str = "valor",
) -> DataFrame:
    """Mean, least, greatest and number of values per series and month."""
    by_month = rows.groupBy(code, name, F.year(date).alias("ano"), F.month(date).alias("mes"))
    return by_month.agg(
        F.avg(value).alias("valor_medio"),
        F.min(value).alias("valor_min"),
        F.max(value).alias("valor_max"),
        F.count(value).alias("qtd_observacoes"),
    )


def with_percent_change(
    months: DataFrame,
    code: str = "serie_codigo",
    order: Sequence[str] = ("ano", "mes", "serie_nome"),
    value: str = "valor_medio",
) -> DataFrame:
    """Add the change against the previous month that exists for the series.

    Runs on monthly rows, so a window partition holds months, not observations.
    """
    history = Window.partitionBy(code).orderBy(*order)
    return (
        months.withColumn("_anterior", F.lag(value).over(history))
        .withColumn(
            "variacao_percentual_mensal", percent_change(F.col(value), F.col("_anterior"))
        )
        .drop("_anterior")
    )


def monthly(
    rows: DataFrame,
    code: str = "serie_codigo",
    name: str = "serie_nome",
    date: str = "data",
    value: str = "valor",
    ordered: bool = True,
) -> DataFrame:
    """Monthly table per series, with month-over-month percent change.

    ``ordered=False`` leaves out the final sort, for a plan that goes on.
    """
    table = with_percent_change(
        monthly_totals(rows, code, name, date, value), code, ("ano", "mes", name)
    )
    return table.orderBy(code, "ano", "mes", name) if ordered else table


def comparison(
    months: DataFrame,
    names: Sequence[str] | None = None,
    code: str = "serie_codigo",
    name: str = "serie_nome",
    value: str = "valor_medio",
    ordered: bool = True,
) -> DataFrame:
    """One row per month and one column per series, in alphabetical order.

    With ``names`` (from the catalog) no job is needed to discover the columns; a
    row of another name fails the query, and a null name has no column.
    If two codes share a name in one month, the smaller code gives the cell.
    """
    columns = sorted(names) if names is not None else None
    if columns is not None:
        fault = F.raise_error(
            F.concat(F.lit("series without a column in the comparison: "), F.col(name))
        ).cast("boolean")
        known = F.col(name).isNull() | F.col(name).isin(columns)
        months = months.filter(F.when(known, True).otherwise(fault))
    cell = F.min(F.struct(code, value))[value]
    wide = months.groupBy("ano", "mes").pivot(name, columns).agg(cell)
    return wide.orderBy("ano", "mes") if ordered else wide
