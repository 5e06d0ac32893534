"""Landed pages as a file stream, closed run by run into silver and gold.

A page belongs to the ingestion run of its ``data_ingestao``, and a failing page
fails its series in that run only. A run is therefore kept open until the newest
run seen is ``delay_days`` ahead of it; then its pages are validated, assembled and
merged into the tables of ``plans.incremental``. Of a page that landed several
times in a run the last one counts. Pages of a run that is already closed go to
the side table ``atrasadas``.

Spark's checkpoint names the files of every micro-batch. A batch writes what it
lands to folders of its own number and decides by what earlier batches closed, so
a batch that is run again after a failure lands the same pages in the same place,
closes the same runs, and merges the same documents, which changes nothing twice.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from lakeseries.operators.pages import assemble_documents, failed_series, validate_pages
from lakeseries.operators.silver import keep_latest
from lakeseries.plans.incremental import IncrementalConfig, merge_documents
from lakeseries.schemas import PAGE_SCHEMA
from lakeseries.sources.work import exists

LANDED, LATE, CLOSED, FAILED = "paginas", "atrasadas", "fechadas", "falhas"

# recebido says which of two landings of one page is the later one.
STREAM_SCHEMA = StructType(
    [
        *PAGE_SCHEMA.fields,
        StructField("data_ingestao", StringType()),
        StructField("recebido", TimestampType()),
    ]
)

_PAGE = ["data_ingestao", "codigo", "janela_inicio", "pagina"]
_LOT = StructField("lote", LongType())
_STORED = StructType([*STREAM_SCHEMA.fields, _LOT])
_CLOSED = StructType([StructField("data_ingestao", StringType()), _LOT])


@dataclass(frozen=True)
class StreamConfig:
    landing: str  # JSON Lines with the columns of STREAM_SCHEMA
    base: str
    checkpoint: str
    delay_days: int = 1
    tables: IncrementalConfig | None = None

    def incremental(self) -> IncrementalConfig:
        return self.tables or IncrementalConfig(self.base)


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _write(rows: DataFrame, path: str, lot: int, by: tuple[str, ...] = ()) -> None:
    """Replace what an earlier attempt at this batch wrote."""
    (
        rows.withColumn("lote", F.lit(lot).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, "lote")
        .parquet(path)
    )


def read_late(spark: SparkSession, base: str) -> DataFrame:
    """Pages that landed after their run was closed."""
    return _read(spark, f"{base}/{LATE}", _STORED)


def read_failures(spark: SparkSession, base: str) -> DataFrame:
    """Series that failed, one row for each run."""
    schema = "codigo int, nome string, data_ingestao string, erro string, paginas_com_erro long, lote long"
    return _read(spark, f"{base}/{FAILED}", StructType.fromDDL(schema))


def _closed_before(spark: SparkSession, base: str, lot: int) -> DataFrame:
    closed = _read(spark, f"{base}/{CLOSED}", _CLOSED).where(F.col("lote") < lot)
    return closed.select("data_ingestao").distinct()


def _close(spark: SparkSession, config: StreamConfig, lot: int, delay_days: int | None) -> list[str]:
    """Merge all open runs that are old enough; all of them if there is no delay."""
    base = config.base.rstrip("/")
    landed = _read(spark, f"{base}/{LANDED}", _STORED).where(F.col("lote") <= lot)
    runs = landed.select("data_ingestao").distinct()
    due = runs.join(_closed_before(spark, base, lot), "data_ingestao", "left_anti")
    if delay_days is not None:
        newest = runs.agg(F.max(F.to_date("data_ingestao"))).first()[0]
        last = F.date_sub(F.lit(newest), delay_days)
        due = due.where(F.to_date("data_ingestao") <= last)
    names = sorted(r.data_ingestao for r in due.collect())  # a row for each open day
    if not names:
        return names
    pages = landed.where(F.col("data_ingestao").isin(names))
    latest = keep_latest(pages, _PAGE, ["recebido", "lote", "status", "body"])
    checked = validate_pages(latest.drop("lote", "recebido"))
    documents = assemble_documents(checked, F.col("data_ingestao"))
    merge_documents(documents, config.incremental())
    by_run = checked.withColumn("nome", F.struct("nome", "data_ingestao"))
    failures = failed_series(by_run).select(
        "codigo", "nome.nome", "nome.data_ingestao", "erro", "paginas_com_erro"
    )
    _write(failures, f"{base}/{FAILED}", lot)
    _write(spark.createDataFrame([(n,) for n in names], "data_ingestao string"), f"{base}/{CLOSED}", lot)
    return names


def land(batch: DataFrame, lot: int, config: StreamConfig) -> None:
    """One micro-batch: late pages aside, the others to their runs, due runs closed.

    Lots of batches are even numbers; what :func:`close_all` closes after one has
    the odd number that follows.
    """
    spark, base = batch.sparkSession, config.base.rstrip("/")
    # A row for each closed day. By the date all pages of a run would meet in one task.
    closed = F.broadcast(_closed_before(spark, base, lot))
    known = batch.where(F.to_date("data_ingestao").isNotNull())
    _write(known.join(closed, "data_ingestao", "left_semi"), f"{base}/{LATE}", lot)
    on_time = known.join(closed, "data_ingestao", "left_anti")
    _write(on_time, f"{base}/{LANDED}", lot, ("data_ingestao",))
    _close(spark, config, lot, config.delay_days)


def run_available(spark: SparkSession, config: StreamConfig) -> None:
    """Take in everything that has landed since the last call, then stop."""
    pages = spark.readStream.schema(STREAM_SCHEMA).json(config.landing)
    query = (
        pages.writeStream.foreachBatch(lambda batch, number: land(batch, 2 * number, config))
        .option("checkpointLocation", config.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def close_all(spark: SparkSession, config: StreamConfig) -> list[str]:
    """Close the runs that are still open; returns their dates."""
    landed = _read(spark, f"{config.base.rstrip('/')}/{LANDED}", _STORED)
    last = landed.agg(F.max("lote")).first()[0]
    return [] if last is None else _close(spark, config, last + 1, None)
