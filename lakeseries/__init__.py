"""Spark-native medallion analytics for periodic indicator series."""

from lakeseries.operators.asof import asof_join
from lakeseries.operators.frames import (
    accumulated_months,
    running_totals,
    trailing_days,
    trailing_rows,
)
from lakeseries.operators.gaps import month_spine, series_gaps, series_runs
from lakeseries.operators.gold import comparison, monthly, with_percent_change
from lakeseries.operators.pages import (
    assemble_documents,
    failed_series,
    series_positions,
    series_totals,
    validate_pages,
)
from lakeseries.operators.periods import overlaps, period_join, range_by_period
from lakeseries.operators.quality import DataQualityError, quality_report, require_quality
from lakeseries.operators.serve import (
    comparison_long,
    comparison_period,
    comparison_view,
    detail_table,
    filter_period,
    kpi_cards,
    latest_per_series,
    monthly_view,
    period_bounds,
    series_options,
    series_points,
)
from lakeseries.operators.silver import (
    bronze_to_silver,
    discard_metric,
    drop_invalid,
    keep_latest,
    normalise,
)
from lakeseries.operators.snapshots import snapshot_changes, write_snapshot
from lakeseries.operators.windows import invalid_requests, year_windows
from lakeseries.plans.batch import BatchConfig, BatchMetrics, run_batch
from lakeseries.plans.incremental import IncrementalConfig, merge_documents
from lakeseries.plans.ingestion import Ingestion, failure_count, ingest_pages, run_ingestion
from lakeseries.sources import (
    TableNotFoundError,
    catalog_from_rows,
    corrupt_documents,
    read_bronze,
    read_catalog,
    read_table,
    write_bronze,
    write_table,
)

__all__ = [
    "BatchConfig",
    "BatchMetrics",
    "DataQualityError",
    "IncrementalConfig",
    "Ingestion",
    "TableNotFoundError",
    "accumulated_months",
    "asof_join",
    "assemble_documents",
    "bronze_to_silver",
    "catalog_from_rows",
    "comparison",
    "comparison_long",
    "comparison_period",
    "comparison_view",
    "corrupt_documents",
    "detail_table",
    "discard_metric",
    "drop_invalid",
    "failed_series",
    "failure_count",
    "filter_period",
    "ingest_pages",
    "invalid_requests",
    "keep_latest",
    "kpi_cards",
    "latest_per_series",
    "merge_documents",
    "month_spine",
    "monthly",
    "monthly_view",
    "normalise",
    "overlaps",
    "period_bounds",
    "period_join",
    "quality_report",
    "range_by_period",
    "read_bronze",
    "read_catalog",
    "read_table",
    "require_quality",
    "run_batch",
    "run_ingestion",
    "running_totals",
    "series_gaps",
    "series_options",
    "series_points",
    "series_positions",
    "series_runs",
    "series_totals",
    "snapshot_changes",
    "trailing_days",
    "trailing_rows",
    "validate_pages",
    "with_percent_change",
    "write_bronze",
    "write_snapshot",
    "write_table",
    "year_windows",
]
