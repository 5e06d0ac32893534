"""Data-quality checks as distributed aggregates, and the gate on their report."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeseries.functions import is_missing
from lakeseries.sources.tables import write_table

# Accepted closed range of each known series, the range of all
# other series, and the expectation names of the report.
SERIES_RANGES = {
    "selic_diaria": (0, 100),
    "taxa_media_juros_credito": (0, 200),
    "cambio_usd_venda": (0, 20),
    "ipca_mensal": (-5, 5),
}
DEFAULT_RANGE = (-1_000_000, 1_000_000)
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_compound_columns_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"

GLOBAL_SCOPE = "global"

_NO_NAME = "\x00"

REPORT_SCHEMA = "expectativa string, escopo string, unexpected_count long"
Ranges = Mapping[str, tuple[float, float]] | DataFrame


class DataQualityError(Exception):
    """The table did not pass the checks.

    ``count`` is the number of failures; all of them are stored at ``report_path``.
    """

    def __init__(self, count: int, report_path: str):
        super().__init__(f"{count} quality problem(s), see the report at '{report_path}'")
        self.count = count
        self.report_path = report_path

    def report(self, spark: SparkSession) -> DataFrame:
        return read_report(spark, self.report_path)


def not_null_counts(rows: DataFrame) -> DataFrame:
    """Rows, rows without date, and rows with a null or NaN value."""
    return rows.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(F.col("data").isNull()).alias("data_nula"),
        F.count_if(is_missing(F.col("valor"))).alias("valor_nulo"),
    )


def duplicate_rows(rows: DataFrame, keys: tuple[str, ...] = ("serie_codigo", "data")) -> DataFrame:
    """Number of rows whose key occurs more than once; all-null keys are ignored."""
    some_key = F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()
    groups = rows.filter(some_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")))
    return groups.agg(F.coalesce(repeated, F.lit(0)).cast("long").alias("linhas_repetidas"))


def _range_table(rows: DataFrame, ranges: Ranges) -> DataFrame:
    """Ranges with one row per name; a null or repeated name fails the query."""
    if not isinstance(ranges, DataFrame):
        listed = [(name, float(low), float(high)) for name, (low, high) in ranges.items()]
        ranges = rows.sparkSession.createDataFrame(
            listed, "serie_nome string, minimo double, maximo double"
        )
    # The join only asks for names that are not null, so a null one gets a mark.
    name = F.coalesce("serie_nome", F.lit(_NO_NAME)).alias("serie_nome")
    named = ranges.groupBy(name).agg(
        F.first(F.col("minimo").cast("double")).alias("minimo"),
        F.first(F.col("maximo").cast("double")).alias("maximo"),
        F.count(F.lit(1)).alias("_vezes"),
    )
    fault = F.raise_error(
        F.concat(F.lit("range name is null or repeated: "), F.col("serie_nome"))
    ).cast("boolean")
    unique = (F.col("serie_nome") != _NO_NAME) & (F.col("_vezes") == 1)
    unique = F.when(unique, True).otherwise(fault)
    return named.filter(unique).drop("_vezes")


def series_profile(
    rows: DataFrame, ranges: Ranges = SERIES_RANGES, default: tuple[float, float] = DEFAULT_RANGE
) -> DataFrame:
    """Per ``serie_nome``: rows, missing dates, missing values, values out of range.

    Ends of a range belong to it. Missing values are not out of range. The join
    with the ranges has one row per name on that side, so it keeps every row
    once; adaptive execution decides how to run it and splits large series.
    """
    bounded = rows.select("serie_nome", "valor", "data").join(
        _range_table(rows, ranges), "serie_nome", "left"
    )
    missing = is_missing(F.col("valor"))
    low = F.coalesce(F.col("minimo"), F.lit(float(default[0])))
    high = F.coalesce(F.col("maximo"), F.lit(float(default[1])))
    return bounded.groupBy("serie_nome").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(F.col("data").isNull()).alias("data_nula"),
        F.count_if(missing).alias("valor_nulo"),
        F.count_if(~missing & ~F.col("valor").between(low, high)).alias("fora_da_faixa"),
    )


def range_violations(
    rows: DataFrame, ranges: Ranges = SERIES_RANGES, default: tuple[float, float] = DEFAULT_RANGE
) -> DataFrame:
    """Values out of range per named series, zero included."""
    return (
        series_profile(rows, ranges, default)
        .filter(F.col("serie_nome").isNotNull())
        .select("serie_nome", "fora_da_faixa")
    )


def quality_report(
    rows: DataFrame,
    ranges: Ranges = SERIES_RANGES,
    default: tuple[float, float] = DEFAULT_RANGE,
    ordered: bool = True,
) -> DataFrame:
    """One row per failed expectation; no row when all checks pass.

    Global checks come first, then the range failures by series name. Two scans:
    one profile per series feeds both null checks and the ranges, and the
    uniqueness check counts keys.
    """

    def finding(position: int, expectation: str, scope: Column, count: str) -> Column:
        return F.struct(
            F.lit(position).alias("ordem"),
            F.lit(expectation).alias("expectativa"),
            scope.alias("escopo"),
            F.col(count).alias("unexpected_count"),
        )

    everywhere = F.lit(GLOBAL_SCOPE)
    profiled = series_profile(rows, ranges, default).select(
        F.inline(
            F.array(
                finding(0, NOT_NULL, everywhere, "data_nula"),
                finding(1, NOT_NULL, everywhere, "valor_nulo"),
                finding(3, BETWEEN, F.col("serie_nome"), "fora_da_faixa"),
            )
        )
    )
    repeated = duplicate_rows(rows).select(
        F.inline(F.array(finding(2, UNIQUE, everywhere, "linhas_repetidas")))
    )
    failures = (
        profiled.filter(F.col("escopo").isNotNull() & (F.col("unexpected_count") > 0))
        .groupBy("ordem", "expectativa", "escopo")
        .agg(F.sum("unexpected_count").alias("unexpected_count"))
        .unionByName(repeated.filter(F.col("unexpected_count") > 0))
    )
    report = failures.orderBy("ordem", "escopo") if ordered else failures
    return report.select("expectativa", "escopo", "unexpected_count")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).parquet(path)


def require_quality(
    rows: DataFrame,
    report_path: str,
    ranges: Ranges = SERIES_RANGES,
    default: tuple[float, float] = DEFAULT_RANGE,
) -> None:
    """Write the report as the table ``report_path``; raise if it has any row.

    The report is computed once, and the error names its version, which the next
    run still keeps. Empty input passes.
    """
    version = write_table(quality_report(rows, ranges, default, ordered=False), report_path)
    count = read_report(rows.sparkSession, version).count()
    if count:
        raise DataQualityError(count, version)
