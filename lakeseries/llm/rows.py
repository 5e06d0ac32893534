"""Rows of any columns carried through functions on Arrow batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def as_rows(docs: DataFrame, needed: list[str], new: list[str]) -> DataFrame:
    """Every row as one struct ``_row``, without columns named like the ``new`` ones.

    So columns of any name pass through. The ``needed`` ones must not be new.
    """
    own = [c for c in docs.columns if c.lower() not in new]
    for column in needed:
        if column not in own:
            raise ValueError(f"no column {column}, or the result has one of that name: rename it")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"))


def with_fields(rows: DataFrame, fields: str) -> StructType:
    """The type of ``_row`` followed by the given fields."""
    return StructType([rows.schema["_row"], *StructType.fromDDL(fields).fields])
