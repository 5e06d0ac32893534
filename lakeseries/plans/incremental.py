"""Silver and gold kept up to date by additions, without a rebuild of all history.

Tables are partitioned by month. An addition reads and replaces only the silver
months that its records fall in. Silver keeps what decides between two records of
one date, so a late or repeated document gives what a rebuild would give, and
merging the same documents twice changes nothing.

What an addition changes in gold is closed over first: the months of a series
with changed dates, and the next month that exists, whose percent change moves.
The history of the changed series is read from the monthly table, a row for each
month; silver is not.

Every set of new partitions is complete in ``pendentes`` before it replaces the
old ones, and a run starts by putting in place what the run before could not: a
run may die at any point. A run that died before its silver was complete is run
again with the same documents. Months that fail the quality check stay
pending, with gold as it was, and are checked again with the next addition. The
tables have one writer at a time.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lakeseries.operators.gold import comparison, monthly_totals, with_percent_change
from lakeseries.operators.ordered import joined
from lakeseries.operators.quality import DEFAULT_RANGE, SERIES_RANGES, Ranges, require_quality
from lakeseries.operators.silver import (
    KEY,
    RECENCY,
    SILVER_COLUMNS,
    drop_invalid,
    keep_latest,
    normalise,
)
from lakeseries.schemas import SILVER_SCHEMA
from lakeseries.sources.work import children, exists, remove, stored_at

SILVER, MONTHLY, COMPARISON = "silver", "mensal", "comparativo"
PENDING = "pendentes"
MONTH = ["ano", "mes"]

_MONTH_FIELDS = [StructField("ano", IntegerType()), StructField("mes", IntegerType())]
_STATE = StructType(
    [
        *SILVER_SCHEMA.fields,
        StructField("data_ingestao", StringType()),
        StructField("janela_inicio", StringType()),
        StructField("pagina", LongType()),
        StructField("posicao", IntegerType()),
        *_MONTH_FIELDS,
    ]
)
_MONTHLY = StructType(
    [
        StructField("serie_codigo", IntegerType()),
        StructField("serie_nome", StringType()),
        StructField("valor_medio", DoubleType()),
        StructField("valor_min", DoubleType()),
        StructField("valor_max", DoubleType()),
        StructField("qtd_observacoes", LongType()),
        StructField("variacao_percentual_mensal", DoubleType()),
        *_MONTH_FIELDS,
    ]
)
_KEYS = StructType([StructField("serie_codigo", IntegerType()), *_MONTH_FIELDS])


@dataclass(frozen=True)
class IncrementalConfig:
    base: str
    skip_quality_check: bool = False
    ranges: Ranges = field(default_factory=lambda: SERIES_RANGES)
    default_range: tuple[float, float] = DEFAULT_RANGE


@dataclass(frozen=True)
class IncrementalMetrics:
    """Months whose files were replaced."""

    silver_months: int
    monthly_months: int
    comparison_months: int


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_silver(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, f"{base}/{SILVER}", _STATE).select(*SILVER_COLUMNS)


def read_monthly(spark: SparkSession, base: str) -> DataFrame:
    columns = ["serie_codigo", "serie_nome", *MONTH, *_MONTHLY.fieldNames()[2:-2]]
    return _read(spark, f"{base}/{MONTHLY}", _MONTHLY).select(*columns)


def _names(monthly: DataFrame) -> list[str]:
    found = monthly.where("serie_nome is not null").select("serie_nome").distinct().collect()
    return sorted(r.serie_nome for r in found)


def read_comparison(spark: SparkSession, base: str) -> DataFrame:
    """A column for every series that now has a month, null where a month lacks it.

    Rows without a series name have no column.
    """
    columns = _names(read_monthly(spark, base))
    schema = StructType([*_MONTH_FIELDS, *[StructField(c, DoubleType()) for c in columns]])
    return _read(spark, f"{base}/{COMPARISON}", schema).select(*[F.col(f"`{c}`") for c in [*MONTH, *columns]])


def _months(rows: DataFrame) -> list[tuple[int, int]]:
    """Calendar months of the rows; the driver holds no more than there are months."""
    return sorted((r.ano, r.mes) for r in rows.select(*MONTH).distinct().collect())


def _within(months: Sequence[tuple[int, int]]) -> Column:
    """A condition on partition columns alone: other months' files are not read."""
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    out = F.lit(False)
    for year, some in by_year.items():
        out = out | ((F.col("ano") == year) & F.col("mes").isin(some))
    return out


def _put(spark: SparkSession, staged: str, path: str) -> None:
    """Replace the months of complete staged rows; done again, it does the same."""
    rows = spark.read.parquet(staged)
    (
        rows.hint("rebalance", *MONTH)
        .sortWithinPartitions(*MONTH, *[c for c in KEY if c in rows.columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MONTH)
        .parquet(path)
    )
    remove(spark, staged)


def _replace(rows: DataFrame, base: str, run: str, table: str) -> int:
    spark, staged = rows.sparkSession, f"{run}/{table}"
    months = len(_months(stored_at(rows, staged)))
    _put(spark, staged, f"{base}/{table}")
    return months


def _recover(spark: SparkSession, base: str) -> list[str]:
    """Put complete staged partitions in place; returns the runs whose gold is still to do."""
    folder = f"{base}/{PENDING}"
    if not exists(spark, folder):
        return []
    runs = [f"{folder}/{name}" for name in sorted(children(spark, folder))]
    for run in runs:
        for table in (SILVER, MONTHLY, COMPARISON):
            staged = f"{run}/{table}"
            if exists(spark, f"{staged}/_SUCCESS"):
                _put(spark, staged, f"{base}/{table}")
            elif exists(spark, staged):
                remove(spark, staged)
    return [run for run in runs if exists(spark, f"{run}/chaves/_SUCCESS")]


def _merged_silver(spark: SparkSession, new: DataFrame, base: str) -> DataFrame:
    old = _read(spark, f"{base}/{SILVER}", _STATE).where(_within(_months(new)))
    return keep_latest(old.unionByName(new), KEY, RECENCY)


def _changed_monthly(spark: SparkSession, changed: DataFrame, base: str, run: str) -> DataFrame:
    """All rows of the calendar months in which a row of the monthly table changes."""
    names = ["serie_codigo", *MONTH]
    silver = _read(spark, f"{base}/{SILVER}", _STATE).where(_within(_months(changed)))
    table = _read(spark, f"{base}/{MONTHLY}", _MONTHLY)
    mark = changed.withColumn("_mudou", F.lit(True))
    totals = joined(monthly_totals(silver), mark, names, "inner")
    codes = changed.select("serie_codigo").distinct()
    history = joined(table.drop("variacao_percentual_mensal"), codes, ["serie_codigo"], "inner")
    others = joined(history, mark, names).where("_mudou is null")
    series = with_percent_change(totals.unionByName(others))
    before = Window.partitionBy("serie_codigo").orderBy(*MONTH, "serie_nome")
    moved = F.col("_mudou").isNotNull() | F.lag("_mudou").over(before).isNotNull()
    # A month of a series is replaced as a whole, under all its names.
    whole = F.max("_moveu").over(Window.partitionBy(*names))
    rows = series.withColumn("_moveu", moved).withColumn("_moveu", whole).where("_moveu")
    rows = stored_at(rows.drop("_mudou", "_moveu"), f"{run}/mudou")
    gone = rows.select(*names).unionByName(changed).distinct().withColumn("_mudou", F.lit(True))
    kept = joined(table.where(_within(_months(gone))), gone, names).where("_mudou is null")
    return kept.drop("_mudou").unionByName(rows)


def merge_documents(
    bronze: DataFrame, config: IncrementalConfig
) -> IncrementalMetrics:
    """Add raw documents to silver, check the months they change, and bring gold up to date.

    Raises ``DataQualityError`` after silver, before gold.
    """
    spark, base = bronze.sparkSession, config.base.rstrip("/")
    unfinished = _recover(spark, base)
    run = f"{base}/{PENDING}/{uuid.uuid4().hex}"
    by_month = {"ano": F.year("data"), "mes": F.month("data")}
    records = drop_invalid(normalise(bronze)).withColumns(by_month)
    new = stored_at(
        keep_latest(records, KEY, RECENCY).select(*[F.col(c).cast(t.dataType) for c, t in zip(_STATE.names, _STATE)]),
        f"{run}/novos",
    )
    stored_at(new.select(*_KEYS.names).distinct(), f"{run}/chaves")
    silver_months = _replace(_merged_silver(spark, new, base), base, run, SILVER)
    remove(spark, f"{run}/novos")
    runs = [*unfinished, run]
    changed = spark.read.schema(_KEYS).parquet(*[f"{r}/chaves" for r in runs]).distinct()
    months = _months(changed)
    if not config.skip_quality_check and months:
        silver = _read(spark, f"{base}/{SILVER}", _STATE).where(_within(months))
        report = f"{base}/qualidade"
        require_quality(silver.select(*SILVER_COLUMNS), report, config.ranges, config.default_range)
    monthly_months = comparison_months = 0
    if months:
        rows = _changed_monthly(spark, changed, base, run)
        monthly_months = _replace(rows, base, run, MONTHLY)
        table = _read(spark, f"{base}/{MONTHLY}", _MONTHLY).where(_within(months))
        wide = comparison(table, _names(table), ordered=False)
        comparison_months = _replace(wide, base, run, COMPARISON)
    for done in runs:
        remove(spark, done)
    return IncrementalMetrics(silver_months, monthly_months, comparison_months)
