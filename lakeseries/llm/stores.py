"""Intermediate tables that several plans read, in the shared checkpoint folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``; a local session without one gets a folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lakeseries-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(table: DataFrame, name: str) -> DataFrame:
    """The table, written once and read back; a lost executor costs nothing written."""
    spark = table.sparkSession
    path = fresh_path(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)
