"""Series catalog: a small table, so that a new series is data only."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from lakeseries.schemas import CATALOG_SCHEMA


def catalog_from_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Catalog from mappings with ``codigo, nome, data_inicial[, data_final]``."""
    fields = CATALOG_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], CATALOG_SCHEMA)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog from JSON Lines."""
    return spark.read.schema(CATALOG_SCHEMA).json(path)
