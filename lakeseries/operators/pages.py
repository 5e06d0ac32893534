"""Landed response pages -> raw documents, with failures isolated per series.

A page is one response body for one window of one series, and becomes one raw
document of its own at every size. The order of a series' records is that of
(window start, page number, place in the page). A series with a failing page
gives no document: the keys of such series are few and small, and are taken off
by an anti join, so record payloads move no more than that join needs.
"""

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeseries.operators.ordered import joined, prefix_sums
from lakeseries.schemas import RECORD_SCHEMA

HTTP_STATUS = "http_status"
INVALID_JSON = "invalid_json"
NOT_A_LIST = "not_a_list"
MISSING_PAGE = "missing_page"
UNPLANNED_PAGE = "unplanned_page"

_STRICT = {"allowSingleQuotes": "false"}
_RECORD = RECORD_SCHEMA.simpleString()
_RUN = ["codigo", "nome", "data_ingestao"]
_PAGE_ORDER = ["janela_inicio", "pagina"]


def _with_page_number(pages: DataFrame) -> DataFrame:
    if "pagina" in pages.columns:
        return pages
    return pages.withColumn("pagina", F.lit(0).cast("long"))


def validate_pages(pages: DataFrame) -> DataFrame:
    """Replace ``status``/``body`` by ``registros``, their number, and an ``erro`` code.

    ``erro`` is null for a page with status 200 and a JSON list as body. List
    elements that are no objects stay, as null records. The number is a column
    of its own so that profiles of a stored result need not read the records.

    A body is parsed as the only element of an outer list: that refuses
    trailing text and a bare object, which a direct parse would let through.
    Each step is a column that the next one reads, so that every body is parsed
    once, and a second time only if it is no list of objects.
    """
    answered = F.col("status").eqNullSafe(200)
    wrapped = F.when(answered, F.concat(F.lit("["), F.col("body"), F.lit("]")))
    numbered = _with_page_number(pages)
    parsed = (
        numbered.withColumn("_listas", F.from_json(wrapped, f"array<array<{_RECORD}>>", _STRICT))
        .withColumn(
            "_textos",
            F.from_json(
                F.when(F.col("_listas").isNull(), wrapped), "array<array<string>>", _STRICT
            ),
        )
        .withColumn(
            "registros",
            F.when(F.size("_listas") == 1, F.get("_listas", F.lit(0))).when(
                F.size("_textos") == 1,
                F.transform(
                    F.get("_textos", F.lit(0)), lambda item: F.from_json(item, _RECORD, _STRICT)
                ),
            ),
        )
    )
    error = (
        F.when(~answered, HTTP_STATUS)
        .when(F.col("registros").isNotNull(), F.lit(None))
        .when(F.try_parse_json("body").isNull(), INVALID_JSON)
        .otherwise(NOT_A_LIST)
    )
    return parsed.select(
        *[c for c in numbered.columns if c not in ("status", "body")],
        "registros",
        F.size("registros").alias("quantidade"),
        error.alias("erro"),
    )


def failed_series(checked: DataFrame) -> DataFrame:
    """One row per series with a failing page: the first error in window order."""
    first = F.min(F.struct("janela_inicio", "pagina", "erro"))
    return (
        checked.filter(F.col("erro").isNotNull())
        .groupBy("codigo", "nome")
        .agg(first.alias("primeira"), F.count(F.lit(1)).alias("paginas_com_erro"))
        .select("codigo", "nome", "primeira.erro", "paginas_com_erro")
    )


def _ingestion_date(value: Column | dt.date | str | None) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.date):
        return F.lit(value.isoformat())
    if value is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.lit(value)


def assemble_documents(
    checked: DataFrame, ingestion_date: Column | dt.date | str | None = None
) -> DataFrame:
    """One raw document per page of every series without a failing page.

    Records keep the order of the response; ``janela_inicio`` and ``pagina``
    place the page in its series. ``checked`` is read twice, once for its keys.
    """
    pages = _with_page_number(checked).select(
        "codigo",
        "nome",
        _ingestion_date(ingestion_date).alias("data_ingestao"),
        *_PAGE_ORDER,
        "registros",
        "quantidade",
        "erro",
    )
    failed = pages.filter(F.col("erro").isNotNull()).select(*_RUN).distinct()
    same = reduce(and_, [pages[c].eqNullSafe(failed[c]) for c in _RUN])
    return pages.join(failed, same, "left_anti").select(
        *_RUN,
        F.col("quantidade").alias("quantidade_registros"),
        "registros",
        F.date_format("janela_inicio", "yyyy-MM-dd").alias("janela_inicio"),
        F.col("pagina").cast("long").alias("pagina"),
    )


def series_totals(documents: DataFrame) -> DataFrame:
    """Pages and records of every series and ingestion."""
    return documents.groupBy(*_RUN).agg(
        F.count(F.lit(1)).alias("paginas"), F.sum("quantidade_registros").alias("registros")
    )


def series_positions(documents: DataFrame, folder: str | None = None) -> DataFrame:
    """Documents with ``posicao_inicial`` and ``total_serie``, as if their pages were one list.

    A record's place in its series' response is ``posicao_inicial`` plus its
    place in the page. Pages are in order of window and number; documents that
    share both also share their first position. The sums run over the keys and
    counts of pages alone, in pieces of a series, so neither records nor a whole
    series lie in one task.
    """
    counts = documents.groupBy(*_RUN, *_PAGE_ORDER).agg(
        F.sum("quantidade_registros").alias("_registros")
    )
    placed = prefix_sums(counts, _RUN, _PAGE_ORDER, "_registros", "posicao_inicial", folder).drop(
        "_registros"
    )
    totals = counts.groupBy(*_RUN).agg(F.sum("_registros").alias("total_serie"))
    return joined(joined(documents, placed, [*_RUN, *_PAGE_ORDER]), totals, _RUN)
