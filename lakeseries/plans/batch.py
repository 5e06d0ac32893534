"""The gated batch: raw -> silver -> quality gate -> gold."""

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructType

from lakeseries.operators.gold import comparison, monthly
from lakeseries.operators.quality import DEFAULT_RANGE, SERIES_RANGES, Ranges, require_quality
from lakeseries.operators.silver import bronze_to_silver, document_counts
from lakeseries.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from lakeseries.sources.bronze import CORRUPT, read_bronze
from lakeseries.sources.tables import read_table, write_table

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchConfig:
    bronze_glob: str = "data/bronze/serie=*/data_ingestao=*/part-*"
    silver_path: str = "data/silver/series"
    gold_monthly_path: str = "data/gold/mensal_por_serie"
    gold_comparison_path: str = "data/gold/comparativo_mensal"
    # Report of the quality check; beside silver if not given.
    quality_report_path: str | None = None
    skip_quality_check: bool = False
    multi_line: bool = False
    fmt: str = "parquet"
    ranges: Ranges = field(default_factory=lambda: SERIES_RANGES)
    default_range: tuple[float, float] = DEFAULT_RANGE
    # One directory per series. With very many series leave it empty: rows are
    # clustered and sorted by series in any case, so files can still be skipped.
    silver_partition_by: Sequence[str] = ("serie_codigo",)
    # Column names of the comparison, which must cover all series; discovered
    # from the monthly table if None.
    series_names: Sequence[str] | None = None
    bronze_schema: StructType = BRONZE_SCHEMA
    silver_schema: StructType = SILVER_SCHEMA


@dataclass(frozen=True)
class SilverCounts:
    read: int
    discarded: int
    corrupt: int
    rows: int


@dataclass(frozen=True)
class BatchMetrics:
    records_read: int
    records_discarded: int
    corrupt_documents: int
    silver_rows: int
    monthly_rows: int
    comparison_rows: int


def refresh_silver(spark: SparkSession, config: BatchConfig) -> SilverCounts:
    """Rebuild silver from all raw documents.

    Counts come from a pass of their own over the documents, which has no
    shuffle: tasks that are run again cannot count twice there.
    """
    schema = StructType([*config.bronze_schema.fields]).add(CORRUPT, StringType())
    bronze = read_bronze(spark, config.bronze_glob, config.multi_line, schema)
    counts = document_counts(bronze, CORRUPT).first()
    written = Observation("silver")
    write_table(
        bronze_to_silver(bronze),
        config.silver_path,
        config.fmt,
        partition_by=config.silver_partition_by,
        sort_by=["serie_codigo", "data"],
        count_into=written,
    )
    return SilverCounts(
        counts["lidos"],
        counts["lidos"] - counts["validos"],
        counts["corrompidos"],
        written.get["linhas"],
    )


def refresh_gold(spark: SparkSession, config: BatchConfig) -> tuple[int, int]:
    """Rebuild both gold tables from silver; returns their row counts.

    The comparison reads the monthly table back instead of computing it again.
    """
    silver = read_table(spark, config.silver_path, config.fmt, config.silver_schema)
    monthly_count, comparison_count = Observation("mensal"), Observation("comparativo")
    write_table(
        monthly(silver, ordered=False),
        config.gold_monthly_path,
        config.fmt,
        sort_by=["serie_codigo", "ano", "mes"],
        count_into=monthly_count,
    )
    months = read_table(spark, config.gold_monthly_path, config.fmt)
    write_table(
        comparison(months, config.series_names, ordered=False),
        config.gold_comparison_path,
        config.fmt,
        sort_by=["ano", "mes"],
        count_into=comparison_count,
    )
    return monthly_count.get["linhas"], comparison_count.get["linhas"]


def run_batch(spark: SparkSession, config: BatchConfig = BatchConfig()) -> BatchMetrics:
    """Run all stages. Bad data raises ``DataQualityError`` after silver, before gold.

    After a failure silver holds the rejected data and gold the previous result.
    The check runs on the stored silver, not on its lineage.
    """
    counts = refresh_silver(spark, config)
    if counts.discarded:
        logger.warning(
            "%d of %d records discarded: no usable date or value", counts.discarded, counts.read
        )
    if counts.corrupt:
        logger.error("%d raw documents cannot be read", counts.corrupt)
    logger.info("silver: %d rows in %s", counts.rows, config.silver_path)
    if config.skip_quality_check:
        logger.warning("quality check skipped")
    else:
        silver = read_table(spark, config.silver_path, config.fmt, config.silver_schema)
        report_path = config.quality_report_path or f"{config.silver_path.rstrip('/')}_qualidade"
        require_quality(silver, report_path, config.ranges, config.default_range)
        logger.info("quality check passed on %d rows", counts.rows)
    months, wide = refresh_gold(spark, config)
    logger.info("gold: %d monthly rows, %d comparison rows", months, wide)
    return BatchMetrics(
        counts.read, counts.discarded, counts.corrupt, counts.rows, months, wide
    )
