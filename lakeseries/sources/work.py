"""Where intermediate tables go."""

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A fresh path in ``folder``, or in the shared folder that the session names."""
    folder = folder or spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        raise ValueError(f"give a folder or set {CHECKPOINT_DIR}: all executors must share it")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_at(table: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result that several plans read, and read it back.

    Cheaper than deriving it again where its expressions are dear, and a lost
    executor costs nothing that is already written.
    """
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def stored(table: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """:func:`stored_at` a fresh :func:`work_path`."""
    return stored_at(table, work_path(table.sparkSession, name, folder))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in any store that the session reaches; it may be absent."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(place)]


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
