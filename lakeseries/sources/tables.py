"""Typed tables of files, replaced version by version.

A table is a folder with one data folder per version below ``dados`` and a log
of versions in ``versoes``. A new version is complete before one small file is
added to the log, which makes it the table; nothing is moved or renamed. Readers
that opened the version before keep its files until the next version but one. A
table has one writer at a time.
"""

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeseries.sources.work import children, remove

FORMATS = ("parquet", "orc")

_LOG = "numero long, pasta string"


class TableNotFoundError(Exception):
    """The table has not been written yet."""


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """The last two versions, the newest first; none if there is no table."""
    try:
        log = spark.read.schema(_LOG).json(f"{path.rstrip('/')}/versoes")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    newest = log.orderBy(F.desc("numero"), F.desc("pasta")).limit(2).collect()
    return [(row["numero"], row["pasta"]) for row in newest]


def _checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt} is not one of {', '.join(FORMATS)}")
    return fmt


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Latest state of a table.

    With a ``schema``, columns come in its order and with its types; otherwise
    partition columns come last, with types guessed from directory names.
    """
    versions = _versions(spark, path)
    if not versions:
        raise TableNotFoundError(
            f"No table at '{path}'. Run the batch first: lakeseries.run_batch(spark, config)"
        )
    reader = spark.read.format(_checked(fmt))
    table = (reader.schema(schema) if schema is not None else reader).load(
        f"{path.rstrip('/')}/dados/{versions[0][1]}"
    )
    return table.select(*schema.fieldNames()) if schema is not None else table


def write_table(
    table: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    count_into: Observation | None = None,
) -> str:
    """Replace the whole table, schema included; returns the folder of the version.

    Rows are rebalanced on the partition columns: few files per partition, and
    a partition too large for one task is split. ``count_into`` receives the
    written rows as ``linhas``; it sits in the last stage, whose tasks Spark
    counts once each even when some are run again. A job that fails at any point
    leaves the table as it was, and a plan may read the table it replaces. Data
    of versions before the last one, and of failed runs, is removed at the end.
    """
    out = table.hint("rebalance", *partition_by)
    if count_into is not None:
        out = out.observe(count_into, F.count(F.lit(1)).alias("linhas"))
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    writer = out.write.format(_checked(fmt))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark, path = table.sparkSession, path.rstrip("/")
    before = _versions(spark, path)
    number = before[0][0] + 1 if before else 1
    name = f"v{number}-{uuid.uuid4().hex}"
    writer.mode("errorifexists").save(f"{path}/dados/{name}")
    entry = spark.createDataFrame([(number, name)], _LOG).coalesce(1)
    entry.write.mode("append").json(f"{path}/versoes")
    kept = {name, *(folder for _, folder in before[:1])}
    for folder in children(spark, f"{path}/dados"):
        if folder not in kept:
            remove(spark, f"{path}/dados/{folder}")
    return f"{path}/dados/{name}"
