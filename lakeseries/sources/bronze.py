"""Raw document store: JSON under ``serie=<code>/data_ingestao=<date>``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lakeseries.schemas import BRONZE_SCHEMA

CORRUPT = "_corrupt_record"
PAYLOAD = BRONZE_SCHEMA.fieldNames()


def bronze_glob(path: str) -> str:
    """Glob of the files that :func:`write_bronze` puts under ``path``."""
    return f"{path.rstrip('/')}/serie=*/data_ingestao=*/part-*"


def read_bronze(
    spark: SparkSession,
    glob: str,
    multi_line: bool = False,
    schema: StructType = BRONZE_SCHEMA,
) -> DataFrame:
    """Documents of all files under a glob, with the payload's columns only.

    JSON Lines by default, which Spark can split. Set ``multi_line`` for files
    that hold one pretty-printed document each. Text that is no document gives
    a row of nulls; :func:`corrupt_documents` shows it, and a field
    ``_corrupt_record`` in ``schema`` holds it.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(glob)


def corrupt_documents(
    spark: SparkSession,
    glob: str,
    multi_line: bool = False,
    schema: StructType = BRONZE_SCHEMA,
) -> DataFrame:
    """File and text of everything that :func:`read_bronze` cannot read as a document."""
    texts = spark.read.text(glob, wholetext=multi_line)
    marked = StructType([*schema.fields]).add(CORRUPT, StringType())
    parsed = F.from_json("value", marked, {"columnNameOfCorruptRecord": CORRUPT})
    broken = (F.trim("value") != "") & parsed[CORRUPT].isNotNull()
    return texts.filter(broken).select(
        F.input_file_name().alias("arquivo"), F.col("value").alias("texto")
    )


def write_bronze(documents: DataFrame, path: str) -> None:
    """Write documents as JSON Lines; reruns replace their own partitions only.

    The payload is written as text since the partition columns would otherwise
    leave it. Rebalancing keeps the number of files per partition low and still
    splits the partition of a very large series.
    """
    lines = documents.select(
        F.col("codigo").alias("serie"),
        "data_ingestao",
        F.to_json(F.struct(*[c for c in PAYLOAD if c in documents.columns])).alias("value"),
    )
    (
        lines.hint("rebalance", "serie", "data_ingestao")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("serie", "data_ingestao")
        .text(path)
    )
