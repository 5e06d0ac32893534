"""Column layouts of the tables that the operators exchange.

The raw and catalog schemas are passed to the readers, so that no job infers a
schema from data.
"""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

CATALOG_SCHEMA = StructType(
    [
        StructField("codigo", IntegerType()),
        StructField("nome", StringType()),
        StructField("data_inicial", StringType()),
        StructField("data_final", StringType()),
    ]
)

PAGE_SCHEMA = StructType(
    [
        StructField("codigo", IntegerType()),
        StructField("nome", StringType()),
        StructField("janela_inicio", DateType()),
        StructField("janela_fim", DateType()),
        StructField("pagina", LongType()),
        StructField("status", IntegerType()),
        StructField("body", StringType()),
    ]
)

RECORD_SCHEMA = StructType(
    [
        StructField("data", StringType()),
        StructField("valor", StringType()),
    ]
)

# A document is one page; janela_inicio and pagina place it in its series. Documents
# of a whole series, as older runs wrote them, lack both and stay readable.
BRONZE_SCHEMA = StructType(
    [
        StructField("codigo", IntegerType()),
        StructField("nome", StringType()),
        StructField("data_ingestao", StringType()),
        StructField("quantidade_registros", IntegerType()),
        StructField("registros", ArrayType(RECORD_SCHEMA)),
        StructField("janela_inicio", StringType()),
        StructField("pagina", LongType()),
    ]
)

SILVER_SCHEMA = StructType(
    [
        StructField("serie_codigo", IntegerType()),
        StructField("serie_nome", StringType()),
        StructField("data", DateType()),
        StructField("valor", DoubleType()),
    ]
)
