"""Consumer queries over the gold tables."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeseries.functions import display_label, percent_text, period_start, two_decimals

# The columns of the detail table, in order.
DETAIL_COLUMNS = [
    "serie_nome",
    "periodo",
    "valor_medio",
    "valor_min",
    "valor_max",
    "variacao_percentual_mensal",
]


def with_period(table: DataFrame) -> DataFrame:
    """Add ``periodo``, the first day of (ano, mes)."""
    return table.withColumn("periodo", period_start(F.col("ano"), F.col("mes")))


def monthly_view(months: DataFrame) -> DataFrame:
    return with_period(months).orderBy(
        F.asc_nulls_last("serie_nome"), F.asc_nulls_last("periodo")
    )


def comparison_view(wide: DataFrame) -> DataFrame:
    return with_period(wide).orderBy(F.asc_nulls_last("periodo"))


def series_options(months: DataFrame) -> DataFrame:
    return months.select("serie_nome").distinct().orderBy("serie_nome")


def period_bounds(view: DataFrame) -> DataFrame:
    return view.agg(
        F.min("periodo").alias("periodo_min"), F.max("periodo").alias("periodo_max")
    )


def _in_period(start: dt.date | None, end: dt.date | None) -> Column:
    # periodo is computed, so only the bounds on ano can reach the file scan.
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("ano") >= start.year) & (F.col("periodo") >= F.lit(start))
    if end is not None:
        inside = inside & (F.col("ano") <= end.year) & (F.col("periodo") <= F.lit(end))
    return inside


def filter_period(
    view: DataFrame,
    series: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Rows of the selected series inside [start, end].

    ``None`` means no restriction; an empty selection gives no row.
    """
    inside = _in_period(start, end)
    if series is not None:
        inside = inside & (F.col("serie_nome").isin(list(series)) if series else F.lit(False))
    return view.filter(inside)


def latest_per_series(view: DataFrame) -> DataFrame:
    """The row of the greatest ``periodo`` of each ``serie_nome``.

    If two codes share the name in that month, the greater code is taken.
    """
    rest = [c for c in view.columns if c not in ("serie_nome", "periodo", "serie_codigo")]
    newest = F.max(F.struct("periodo", "serie_codigo", *rest)).alias("ultima")
    return view.groupBy("serie_nome").agg(newest).select("serie_nome", "ultima.*").select(
        *view.columns
    )


def kpi_cards(latest: DataFrame) -> DataFrame:
    """Display texts: label, value, and change (null when there is none)."""
    return latest.select(
        "serie_nome",
        display_label(F.col("serie_nome")).alias("rotulo"),
        two_decimals(F.col("valor_medio")).alias("valor"),
        percent_text(F.col("variacao_percentual_mensal")).alias("variacao"),
    )


def series_points(view: DataFrame) -> DataFrame:
    """Long form: one point per series and period."""
    return view.select("periodo", "valor_medio", "serie_nome")


def comparison_period(
    view: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    return view.filter(_in_period(start, end))


def comparison_long(view: DataFrame, series: Sequence[str] | None = None) -> DataFrame:
    """Unpivot the wide view: (periodo, variable, value), nulls kept.

    Selected series without a column are left out; with none left there is no row.
    """
    available = [c for c in view.columns if c not in ("ano", "mes", "periodo")]
    chosen = available if series is None else [s for s in series if s in available]
    if not chosen:
        return view.select(
            "periodo",
            F.lit(None).cast("string").alias("variable"),
            F.lit(None).cast("double").alias("value"),
        ).filter(F.lit(False))
    quoted = [F.col("`" + name.replace("`", "``") + "`") for name in chosen]
    return view.unpivot(["periodo"], quoted, "variable", "value")


def detail_table(view: DataFrame) -> DataFrame:
    return view.select(*DETAIL_COLUMNS).orderBy(
        F.asc_nulls_last("serie_nome"), F.asc_nulls_last("periodo")
    )
