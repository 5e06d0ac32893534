"""One callable (spark, sf_dir) -> DataFrame per operator, over whole tables."""

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeseries.functions import br_date, br_date_text, br_number, catalog_date
from lakeseries.operators import (
    frames,
    gaps,
    gold,
    pages,
    periods,
    quality,
    rollup,
    serve,
    silver,
    sketches,
    snapshots,
    windows,
)
from lakeseries.operators.asof import asof_join as last_known
from lakeseries.plans.batch import BatchConfig, run_batch
from lakeseries.plans.incremental import (
    IncrementalConfig,
    merge_documents,
    read_comparison,
    read_monthly,
    read_silver,
)
from lakeseries.plans.ingestion import ingest_pages
from lakeseries.schemas import SILVER_SCHEMA
from lakeseries.sources import (
    bronze_glob,
    read_bronze,
    read_catalog,
    read_table,
    stored,
    work_path,
    write_bronze,
    write_table,
)
from lakeseries.sources import corrupt_documents as read_corrupt
from lakeseries.streaming.landing import STREAM_SCHEMA, StreamConfig, close_all, run_available
from workload.inputs import (
    br_text,
    broken_lines,
    cents,
    comma_text,
    customer_catalog,
    customer_pages,
    customer_series,
    event_pages,
    event_series,
    lineitem_series,
    open_catalog,
    order_series,
    price_catalog,
    priority_pages,
    segment_series,
    table,
    window_pages,
)

QUERIES = {}

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_RANGES = {"click": (0, 100), "purchase": (1, 250), "error": (2, 150)}
EVENT_DEFAULT = (0, 300)
START, END = dt.date(1996, 3, 1), dt.date(1999, 12, 1)
SELECTION = ["1-URGENT", "5-LOW"]


def query(function):
    QUERIES[function.__name__] = function
    return function


# Windows, pages, documents


@query
def year_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.year_windows(customer_catalog(spark, sf_dir))


@query
def interval_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.invalid_requests(price_catalog(spark, sf_dir))


@query
def catalog_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", "d/M/yyyy")
    parsed = table(spark, sf_dir, "orders").select("o_orderkey", catalog_date(text).alias("data"))
    return parsed.withColumn("texto", br_date_text(F.col("data")))


@query
def page_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.validate_pages(event_pages(spark, sf_dir)).select(
        "codigo", "pagina", "erro", "quantidade"
    )


def _document_texts(documents: DataFrame) -> DataFrame:
    record = F.transform("registros", lambda r: F.concat_ws("=", r["data"], r["valor"]))
    return documents.select(
        "codigo",
        "nome",
        "data_ingestao",
        "quantidade_registros",
        "janela_inicio",
        "pagina",
        F.array_join(record, "|").alias("texto"),
    )


@query
def page_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = customer_pages(spark, sf_dir).withColumn("status", F.lit(200))
    checked = stored(pages.validate_pages(landed), "paginas")
    return _document_texts(pages.assemble_documents(checked, "2026-07-23"))


def _isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = stored(pages.validate_pages(customer_pages(spark, sf_dir)), "paginas")
    return pages.assemble_documents(checked, "2026-07-23")


@query
def series_failure_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_texts(_isolated(spark, sf_dir))


@query
def series_record_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.series_totals(_isolated(spark, sf_dir))


@query
def failed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.failed_series(pages.validate_pages(customer_pages(spark, sf_dir)))


@query
def ingestion_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows without orders did not land and fail their series."""
    landed = window_pages(spark, sf_dir, empty_windows=False)
    return ingest_pages(customer_catalog(spark, sf_dir), landed).failures


@query
def ingestion_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = window_pages(spark, sf_dir, empty_windows=True)
    run = ingest_pages(customer_catalog(spark, sf_dir), landed, "2026-07-23")
    return _document_texts(run.documents)


@query
def unplanned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order day: the catalog plans few of them."""
    return ingest_pages(price_catalog(spark, sf_dir), customer_pages(spark, sf_dir)).unplanned


@query
def catalog_open_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "catalogo")
    open_catalog(spark, sf_dir).write.json(path)
    return windows.year_windows(read_catalog(spark, path), today=dt.date(2002, 1, 31))


def _priority_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = stored(pages.validate_pages(priority_pages(spark, sf_dir)), "paginas")
    return pages.assemble_documents(checked, F.col("dia"))


# Silver


@query
def bronze_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.explode_records(_priority_documents(spark, sf_dir)).select(
        "serie_codigo", "serie_nome", "data_ingestao", "data_texto", "valor_texto"
    )


@query
def parse_br_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        br_text(F.to_date("o_orderdate")).alias("data_texto"),
        comma_text(F.col("o_totalprice")).alias("valor_texto"),
    )
    return texts.select(
        "o_orderkey",
        br_date(F.col("data_texto")).alias("data"),
        br_number(F.col("valor_texto")).alias("valor"),
    )


def _defective_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records; three priorities come in a form that cannot be used."""
    priority = F.col("o_orderpriority")
    day = F.to_date("o_orderdate")
    date_text = F.when(priority == "4-NOT SPECIFIED", day.cast("string")).otherwise(br_text(day))
    grouped = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    value_text = (
        F.when(priority == "3-MEDIUM", grouped)
        .when((priority == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit("n/d"))
        .when((priority == "5-LOW") & (F.col("o_orderstatus") == "F"), F.lit(None))
        .otherwise(comma_text(F.col("o_totalprice")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("serie_codigo"),
        br_date(date_text).alias("data"),
        br_number(value_text).alias("valor"),
    )


@query
def parse_invalid_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.drop_invalid(_defective_records(spark, sf_dir))


@query
def discard_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.discard_metric(_defective_records(spark, sf_dir))


def _order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("serie_codigo"),
        F.to_date("o_orderdate").alias("data"),
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("valor"),
    )


@query
def dedup_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.keep_latest(_order_versions(spark, sf_dir), silver.KEY, ["o_orderkey"])


@query
def null_before_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = silver.drop_invalid(_order_versions(spark, sf_dir))
    return silver.keep_latest(valid, silver.KEY, ["o_orderkey"])


@query
def dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.to_date("l_shipdate").alias("data"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return silver.keep_latest(versions, ["l_returnflag", "l_linestatus", "data"], order)


@query
def silver_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.bronze_to_silver(_priority_documents(spark, sf_dir))


# Gold


@query
def monthly_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly(order_series(spark, sf_dir))


@query
def monthly_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly(lineitem_series(spark, sf_dir))


@query
def monthly_lag_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse series: the previous month is seldom the one before."""
    return gold.monthly(customer_series(spark, sf_dir, pending_as_zero=False))


@query
def pct_change_zero_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly(customer_series(spark, sf_dir)).select(
        "serie_codigo", "ano", "mes", "valor_medio", "variacao_percentual_mensal"
    )


@query
def comparison_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.comparison(gold.monthly(order_series(spark, sf_dir), ordered=False))


@query
def comparison_known_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.comparison(gold.monthly(order_series(spark, sf_dir), ordered=False), PRIORITIES)


@query
def pivot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of a segment and a nation: many months lack some of them."""
    names = [f"{segment}_{nation}" for segment in SEGMENTS for nation in range(25)]
    return gold.comparison(gold.monthly(segment_series(spark, sf_dir), ordered=False), names)


# Order within long series


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped with the keys of its rows: three long series, by return flag."""
    code = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    return table(spark, sf_dir, "lineitem").select(
        code.alias("serie_codigo"),
        F.to_date("l_shipdate").alias("data"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        cents("l_extendedprice").alias("valor"),
    )


@query
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments of three series with the last order of three others at that day."""
    orders = order_series(spark, sf_dir)
    return last_known(_shipments(spark, sf_dir), orders).drop("l_suppkey")


@query
def asof_join_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of a customer before each order, if at most a year older."""
    orders = customer_series(spark, sf_dir, pending_as_zero=False)
    return last_known(orders, orders, strict=True, tolerance_days=365)


@query
def trailing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["data", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "valor"]
    found = frames.trailing_rows(_shipments(spark, sf_dir), 50, order=order)
    return found.drop("l_suppkey", "media")


@query
def trailing_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.trailing_days(_shipments(spark, sf_dir), 365).drop("media")


@query
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.running_totals(_shipments(spark, sf_dir))


@query
def accumulated_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve calendar months of the greatest value of sparse series."""
    months = gold.monthly_totals(customer_series(spark, sf_dir))
    return frames.accumulated_months(months, 12, value="valor_max").select(
        "serie_codigo", "ano", "mes", "valor_max", "acumulado", "meses"
    )


@query
def rollup_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months, quarters, years, series and total of one series per priority."""
    return rollup.grouped(rollup.month_states(order_series(spark, sf_dir)))


@query
def cube_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series by year, each margin and the total of one series per return flag."""
    return rollup.grouped(rollup.month_states(lineitem_series(spark, sf_dir)), rollup.CUBE)


@query
def series_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its place in the joined pages of its series."""
    placed = pages.series_positions(_priority_documents(spark, sf_dir))
    return placed.select(
        "codigo",
        "data_ingestao",
        "posicao_inicial",
        "total_serie",
        F.posexplode("registros").alias("posicao", "registro"),
    ).select(
        "codigo",
        "data_ingestao",
        (F.col("posicao_inicial") + F.col("posicao")).alias("posicao"),
        "total_serie",
        "registro.data",
        "registro.valor",
    )


@query
def series_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer that are at most 90 days apart."""
    return gaps.series_runs(customer_series(spark, sf_dir), pause_days=90)


@query
def series_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without an order between two orders of a customer."""
    return gaps.series_gaps(customer_series(spark, sf_dir))


@query
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.month_spine(customer_series(spark, sf_dir))


# Validity periods


def _customer_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An urgent order limits its customer's orders for 180 days, an open one without end."""
    date = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("serie_codigo"),
        date.alias("valido_de"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(date, 180)).alias("valido_ate"),
        F.lit(100_000.0).alias("minimo"),
        cents("o_totalprice").alias("maximo"),
        F.col("o_orderkey").alias("limite"),
    )


@query
def range_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders out of the ranges valid at their dates; other dates have a default."""
    limits = _customer_limits(spark, sf_dir)
    rows = customer_series(spark, sf_dir)
    return periods.range_by_period(rows, limits, default=(0, 20_000_000))


@query
def period_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30 days after each order against the limits of its customer."""
    date = F.to_date("o_orderdate")
    deliveries = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("serie_codigo"), "o_orderkey", date.alias("de"),
        F.date_add(date, 30).alias("ate"),
    )
    return periods.overlaps(deliveries, _customer_limits(spark, sf_dir)).select(
        "serie_codigo", "o_orderkey", "limite"
    )


# Sketches


@query
def approximate_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of series and year, merged from stored sketches of months."""
    kept = stored(sketches.quantile_sketch(lineitem_series(spark, sf_dir)), "faixas")
    found = sketches.quantiles(kept, [0, 0.25, 0.5, 0.9, 0.99, 1], ("serie_codigo", "ano"))
    return found.withColumn("valor", F.round("valor"))


@query
def approximate_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parts by series and year: the merged estimate lies within four standard errors."""
    rows = _shipments(spark, sf_dir)
    kept = stored(sketches.distinct_sketch(rows, "l_partkey"), "registros")
    keys = ["serie_codigo", "ano"]
    estimate = sketches.distinct_estimates(kept, keys)
    dated = rows.where("data is not null").withColumn("ano", F.year("data"))
    # Distinct pairs first: no task holds the parts of a year of a series.
    exact = dated.select(*keys, "l_partkey").distinct().groupBy(*keys).agg(
        F.count("l_partkey").alias("distintos")
    )
    error = F.abs(F.col("estimativa") - F.col("distintos"))
    within = error <= F.col("distintos") * 4 * 1.04 / 2 ** (sketches.HLL_BITS / 2) + 1
    return exact.join(estimate, keys).select(*keys, "distintos", within.alias("no_limite"))


# Quality


@query
def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null_counts(event_series(spark, sf_dir))


@query
def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_rows(order_series(spark, sf_dir))


@query
def quality_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_violations(event_series(spark, sf_dir), EVENT_RANGES, EVENT_DEFAULT)


@query
def quality_range_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges as a table: each customer's orders against the customer's balance.

    Customers in debt have no range of their own.
    """
    bounds = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        F.concat(F.lit("cliente_"), F.col("c_custkey")).alias("serie_nome"),
        F.lit(0.0).alias("minimo"),
        (cents("c_acctbal") * 40).alias("maximo"),
    )
    return quality.range_violations(customer_series(spark, sf_dir), bounds)


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(event_series(spark, sf_dir), EVENT_RANGES, EVENT_DEFAULT)


@query
def quality_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored report of a gate that fails."""
    path = work_path(spark, "qualidade")
    try:
        quality.require_quality(event_series(spark, sf_dir), path, EVENT_RANGES, EVENT_DEFAULT)
    except quality.DataQualityError as error:
        return error.report(spark)
    raise AssertionError("the events have defects")


# Consumer queries


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.with_period(gold.monthly(order_series(spark, sf_dir), ordered=False))


def _wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = gold.monthly(order_series(spark, sf_dir), ordered=False)
    return serve.with_period(gold.comparison(months, PRIORITIES, ordered=False))


@query
def period_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.monthly_view(gold.monthly(order_series(spark, sf_dir), ordered=False))


@query
def comparison_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = gold.monthly(order_series(spark, sf_dir), ordered=False)
    return serve.comparison_view(gold.comparison(months, PRIORITIES, ordered=False))


@query
def detail_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.detail_table(_view(spark, sf_dir))


@query
def series_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.series_options(_view(spark, sf_dir))


@query
def period_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.period_bounds(_view(spark, sf_dir))


@query
def filter_series_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.filter_period(_view(spark, sf_dir), SELECTION, START, END)


@query
def series_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.series_points(serve.filter_period(_view(spark, sf_dir), SELECTION, START, END))


@query
def latest_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.latest_per_series(_view(spark, sf_dir))


@query
def latest_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = gold.monthly(customer_series(spark, sf_dir), ordered=False)
    return serve.latest_per_series(serve.with_period(months))


@query
def kpi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = gold.monthly(customer_series(spark, sf_dir), ordered=False)
    return serve.kpi_cards(serve.latest_per_series(serve.with_period(months)))


@query
def comparison_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.comparison_period(_wide_view(spark, sf_dir), START, END)


@query
def comparison_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = serve.comparison_period(_wide_view(spark, sf_dir), START, END)
    return serve.comparison_long(inside, [*SELECTION, "no_such_series"])


# Written and read back


@query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "bronze")
    write_bronze(_priority_documents(spark, sf_dir), path)
    return silver.bronze_to_silver(read_bronze(spark, bronze_glob(path)))


@query
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "silver")
    write_table(order_series(spark, sf_dir), path, partition_by=["serie_codigo"])
    return read_table(spark, path, schema=SILVER_SCHEMA)


@query
def corrupt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "bronze")
    broken_lines(spark, sf_dir).write.partitionBy("serie", "data_ingestao").text(path)
    return read_corrupt(spark, bronze_glob(path)).select("texto")


def _batch_config(spark: SparkSession, sf_dir: str) -> BatchConfig:
    base = work_path(spark, "batch")
    write_bronze(_priority_documents(spark, sf_dir), f"{base}/bronze")
    return BatchConfig(
        bronze_glob=bronze_glob(f"{base}/bronze"),
        silver_path=f"{base}/silver",
        gold_monthly_path=f"{base}/mensal",
        gold_comparison_path=f"{base}/comparativo",
        default_range=(0, 100_000_000),
    )


def _batch(spark: SparkSession, sf_dir: str) -> BatchConfig:
    config = _batch_config(spark, sf_dir)
    run_batch(spark, config)
    return config


@query
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a batch whose raw store also holds documents that cannot be read."""
    config = _batch_config(spark, sf_dir)
    raw = config.bronze_glob.split("/serie=")[0]
    lines = broken_lines(spark, sf_dir)
    lines.write.mode("append").partitionBy("serie", "data_ingestao").text(raw)
    return spark.createDataFrame([dataclasses.asdict(run_batch(spark, config))])


@query
def gated_batch_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _batch(spark, sf_dir).gold_monthly_path)


@query
def gated_batch_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _batch(spark, sf_dir).gold_comparison_path)


# Kept up to date


DAYS = ["2026-07-22", "2026-07-20", "2026-07-23"]


def _incremental_config(spark: SparkSession, name: str) -> IncrementalConfig:
    return IncrementalConfig(work_path(spark, name), ranges={}, default_range=(0, 100_000_000))


def _added(spark: SparkSession, sf_dir: str) -> str:
    """Tables after three additions, of which the second is older than the first."""
    config = _incremental_config(spark, "incremental")
    documents = stored(_priority_documents(spark, sf_dir), "documentos")
    for day in DAYS:
        merge_documents(documents.where(F.col("data_ingestao") == day), config)
    return config.base


@query
def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _added(spark, sf_dir))


@query
def incremental_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_monthly(spark, _added(spark, sf_dir))


@query
def incremental_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_comparison(spark, _added(spark, sf_dir))


@query
def silver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of one ingestion day against silver of another."""
    documents = stored(_priority_documents(spark, sf_dir), "documentos")
    base = work_path(spark, "retratos")
    states = [
        snapshots.write_snapshot(
            silver.bronze_to_silver(documents.where(F.col("data_ingestao") == day)), base
        )
        for day in ("2026-07-20", "2026-07-23")
    ]
    return snapshots.snapshot_changes(spark, *states, SILVER_SCHEMA)


@query
def streaming_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that land in three drops, taken in one drop after the other."""
    base = work_path(spark, "fluxo")
    tables = IncrementalConfig(f"{base}/tabelas", ranges={}, default_range=(0, 100_000_000))
    config = StreamConfig(f"{base}/pouso", tables.base, f"{base}/progresso", 1, tables)
    landed = priority_pages(spark, sf_dir).select(
        "codigo", "nome", "janela_inicio", F.col("janela_inicio").alias("janela_fim"), "pagina",
        "status", "body", F.col("dia").alias("data_ingestao"),
        F.lit("2026-07-24 00:00:00").cast("timestamp").alias("recebido"),
    ).select(*STREAM_SCHEMA.fieldNames())
    for day in sorted(DAYS):
        landed.where(F.col("data_ingestao") == day).write.mode("append").json(config.landing)
        run_available(spark, config)
    close_all(spark, config)
    return read_monthly(spark, tables.base)
