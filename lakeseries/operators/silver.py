"""Raw documents -> one typed row per series and date."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeseries.functions import br_date, br_number

SILVER_COLUMNS = ["serie_codigo", "serie_nome", "data", "valor"]
KEY = ["serie_codigo", "data"]
# Later ingestion wins. Inside one ingestion the later record of the response
# wins, and the last two columns settle what is still equal.
RECENCY = ["data_ingestao", "janela_inicio", "pagina", "posicao", "valor", "serie_nome"]


def explode_records(bronze: DataFrame) -> DataFrame:
    """One row per raw record, with its place in the series' response."""
    placed = bronze
    for column, kind in (("janela_inicio", "string"), ("pagina", "long")):
        if column not in placed.columns:
            placed = placed.withColumn(column, F.lit(None).cast(kind))
    rows = placed.select(
        F.col("codigo").alias("serie_codigo"),
        F.col("nome").alias("serie_nome"),
        "data_ingestao",
        "janela_inicio",
        "pagina",
        F.posexplode("registros").alias("posicao", "registro"),
    )
    return rows.select(
        "serie_codigo",
        "serie_nome",
        "data_ingestao",
        "janela_inicio",
        "pagina",
        "posicao",
        F.col("registro.data").alias("data_texto"),
        F.col("registro.valor").alias("valor_texto"),
    )


def normalise(bronze: DataFrame) -> DataFrame:
    """Exploded records with typed ``data`` and ``valor``; bad text becomes null."""
    return (
        explode_records(bronze)
        .withColumn("data", br_date(F.col("data_texto")))
        .withColumn("valor", br_number(F.col("valor_texto")))
        .drop("data_texto", "valor_texto")
    )


def is_valid() -> Column:
    return F.col("data").isNotNull() & F.col("valor").isNotNull()


def drop_invalid(rows: DataFrame) -> DataFrame:
    return rows.filter(is_valid())


def discard_metric(rows: DataFrame) -> DataFrame:
    """One row: records read, kept and discarded by :func:`drop_invalid`."""
    return rows.agg(
        F.count(F.lit(1)).alias("lidos"), F.count_if(is_valid()).alias("validos")
    ).withColumn("descartados", F.col("lidos") - F.col("validos"))


def document_counts(bronze: DataFrame, corrupt: str) -> DataFrame:
    """One row: what :func:`discard_metric` counts, and documents that cannot be read.

    Records are counted inside their documents, without a row for each.
    """
    usable = F.filter(
        "registros",
        lambda r: br_date(r["data"]).isNotNull() & br_number(r["valor"]).isNotNull(),
    )
    return bronze.agg(
        F.coalesce(F.sum(F.size("registros")), F.lit(0)).alias("lidos"),
        F.coalesce(F.sum(F.size(usable)), F.lit(0)).alias("validos"),
        F.count(corrupt).alias("corrompidos"),
    )


def keep_latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key, the row that is greatest in ``order``; nulls are smallest.

    Spark limits each key to one row per map task before the shuffle (window
    group limit), so a key with very many copies does not load its reducer.
    Rows that are equal in ``order`` should be equal in all columns.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        rows.withColumn("_posto", F.row_number().over(newest_first))
        .filter(F.col("_posto") == 1)
        .drop("_posto")
    )


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Parse, drop invalid records, then keep the latest version of each date.

    The order matters: an unusable newer record never hides a good older one.
    """
    return keep_latest(drop_invalid(normalise(bronze)), KEY, RECENCY).select(*SILVER_COLUMNS)
