"""Catalog and landed pages -> raw documents and failed series."""

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeseries.operators.pages import (
    MISSING_PAGE,
    UNPLANNED_PAGE,
    assemble_documents,
    failed_series,
    validate_pages,
)
from lakeseries.operators.windows import invalid_requests, year_windows
from lakeseries.sources.bronze import write_bronze
from lakeseries.sources.tables import read_table, write_table
from lakeseries.sources.work import remove, stored_at, work_path

logger = logging.getLogger(__name__)

# pagina may be absent if every window has one page.
ANSWER_COLUMNS = ["codigo", "janela_inicio", "pagina", "status", "body"]


@dataclass(frozen=True)
class Ingestion:
    """What became of the landed pages and of the planned series.

    ``documents`` go to the raw store; ``failures`` has one row per failed
    series; ``unplanned`` has every page of no planned window. All three read
    the stored pages at ``path``, which the owner removes when done.
    """

    documents: DataFrame
    failures: DataFrame
    unplanned: DataFrame
    path: str

    def close(self) -> None:
        remove(self.documents.sparkSession, self.path)


def check_pages(catalog: DataFrame, pages: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Validated pages of all planned windows, windows without a page, pages without a window.

    One outer join on the keys finds all three, with one scan of the landing
    table; bodies are parsed after it, past the last shuffle. The catalog names
    the series; columns that documents do not need are left out.
    """
    planned = year_windows(catalog, today=today).select(
        F.col("codigo").alias("_codigo"), "nome", F.col("janela_inicio").alias("_inicio")
    )
    answers = pages.select(*[c for c in ANSWER_COLUMNS if c in pages.columns])
    met = answers.withColumn("_pagina", F.lit(True)).join(
        planned,
        (F.col("codigo") == F.col("_codigo")) & (F.col("janela_inicio") == F.col("_inicio")),
        "full_outer",
    )
    missing, unplanned = F.col("_pagina").isNull(), F.col("_codigo").isNull()
    page = F.col("pagina") if "pagina" in pages.columns else F.lit(0)
    checked = validate_pages(
        met.select(
            F.coalesce("codigo", "_codigo").alias("codigo"),
            "nome",
            F.coalesce("janela_inicio", "_inicio").alias("janela_inicio"),
            F.when(missing, 0).otherwise(page).cast("long").alias("pagina"),
            "status",
            "body",
            F.when(missing, MISSING_PAGE).when(unplanned, UNPLANNED_PAGE).alias("_plano"),
        )
    )
    return checked.withColumn("erro", F.coalesce("_plano", "erro")).drop("_plano")


def ingest_pages(
    catalog: DataFrame,
    pages: DataFrame,
    ingestion_date: dt.date | str | None = None,
    today: dt.date | None = None,
    folder: str | None = None,
) -> Ingestion:
    """Documents of every catalog series whose planned windows all landed well.

    One bad or missing window fails its whole series and no other; a page of no
    planned window fails none. The checked pages are stored first, in ``folder``
    or the session's checkpoint folder: all results read them, and every body is
    parsed a single time.
    """
    spark = catalog.sparkSession
    path = work_path(spark, "paginas", folder)
    checked = stored_at(check_pages(catalog, pages, today), path)
    stray = F.col("erro").eqNullSafe(F.lit(UNPLANNED_PAGE))
    planned = checked.filter(~stray)
    failures = (
        failed_series(planned)
        .select("codigo", "nome", "erro")
        .unionByName(invalid_requests(catalog, today))
    )
    unplanned = checked.filter(stray).select("codigo", "janela_inicio", "pagina", "erro")
    return Ingestion(assemble_documents(planned, ingestion_date), failures, unplanned, path)


@dataclass(frozen=True)
class IngestionMetrics:
    failed_series: int
    unplanned_pages: int


def run_ingestion(
    catalog: DataFrame,
    pages: DataFrame,
    bronze_path: str,
    ingestion_date: dt.date | str | None = None,
    today: dt.date | None = None,
    folder: str | None = None,
    failures_path: str | None = None,
) -> tuple[DataFrame, IngestionMetrics]:
    """Write the documents of all good series; returns the failed series and counts.

    The failures are a table at ``failures_path``, beside the raw store if not
    given. The stored pages are removed.
    """
    run = ingest_pages(catalog, pages, ingestion_date, today, folder)
    failures_path = failures_path or f"{bronze_path.rstrip('/')}_falhas"
    try:
        write_bronze(run.documents, bronze_path)
        write_table(run.failures, failures_path)
        unplanned = run.unplanned.count()
    finally:
        run.close()
    failures = read_table(catalog.sparkSession, failures_path)
    failed = failure_count(failures)
    if failed:
        logger.error("%d series failed", failed)
    if unplanned:
        logger.warning("%d pages of no planned window", unplanned)
    return failures, IngestionMetrics(failed, unplanned)


def failure_count(failures: DataFrame) -> int:
    return failures.agg(F.count(F.lit(1))).first()[0]
