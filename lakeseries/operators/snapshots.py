"""What changed between two states of a table, without reading the blocks that did not.

A snapshot is written in blocks: the month of the date and, if asked for, a slice of
the series, so that additions touch few blocks. A block may be of any size: it is
written in as many files as its size asks for. Beside the rows lies one digest per
block. Two snapshots are compared by their digests first; only blocks
whose digests differ are read, and there the rows of both sides are folded by key.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeseries.sources.work import stored_at

SLICES = 1
BLOCK = "_bloco"
KEYS = ("serie_codigo", "data")


def _blocked(table: DataFrame, keys: Sequence[str], date: str, slices: int) -> DataFrame:
    month = F.year(date) * 12 + F.month(date)
    series = [k for k in keys if k != date]
    part = F.pmod(F.xxhash64(*series), F.lit(slices))
    return table.withColumn(BLOCK, F.coalesce(month, F.lit(0)) * slices + part)


def _row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two independent hashes of a row that also tell which columns are null."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*columns, *nulls), F.xxhash64(F.lit(1), *nulls, *reversed(columns))


def block_digests(blocked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per block: rows, and sums of two hashes of its rows, which any order gives alike.

    The sums are exact decimals, so a row that occurs twice is told from none.
    """
    one, two = _row_hashes(columns)
    wide = "decimal(38,0)"
    return blocked.groupBy(BLOCK).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum(one.cast("decimal(20,0)")).cast(wide).alias("soma_1"),
        F.sum(two.cast("decimal(20,0)")).cast(wide).alias("soma_2"),
    )


def write_snapshot(
    table: DataFrame,
    path: str,
    keys: Sequence[str] = KEYS,
    date: str = "data",
    slices: int = SLICES,
) -> str:
    """Write ``table`` in blocks with their digests; returns the folder of the snapshot.

    More ``slices`` (of the keys but the date) make smaller blocks, for tables where a
    month of all series is much to read. Rows without a date form the month 0. All snapshots that are compared need the
    same ``keys``, ``date`` and ``slices``. The digests are made from the written
    rows, so a table that is not the same when read twice has right digests too.
    """
    folder = f"{path.rstrip('/')}/retrato-{uuid.uuid4().hex}"
    blocked = _blocked(table, keys, date, slices)
    # Rebalanced: a block too large for one task is split, small ones share a file.
    blocked.hint("rebalance", BLOCK).write.partitionBy(BLOCK).parquet(f"{folder}/linhas")
    rows = _rows(table.sparkSession, folder, table.schema)
    stored_at(block_digests(rows, table.columns), f"{folder}/resumos")
    return folder


def _rows(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    whole = StructType(list(schema.fields)).add(BLOCK, "long")
    return spark.read.schema(whole).parquet(f"{folder}/linhas")


def read_snapshot(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return _rows(spark, folder, schema).drop(BLOCK)


def changed_blocks(spark: SparkSession, before: str, after: str) -> DataFrame:
    """The blocks whose digests differ, or which only one of the snapshots has."""
    sides = [spark.read.parquet(f"{folder}/resumos") for folder in (before, after)]
    digest = ["linhas", "soma_1", "soma_2"]
    # Equal digests occur on both sides; others once each.
    both = sides[0].unionByName(sides[1]).groupBy(BLOCK, *digest).agg(F.count(F.lit(1)).alias("n"))
    return both.where("n = 1").select(BLOCK).distinct()


def snapshot_changes(
    spark: SparkSession,
    before: str,
    after: str,
    schema: StructType,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Per key that differs: ``mudanca`` and the values before and after.

    ``mudanca`` is ``inserido``, ``removido`` or ``alterado``; values come as ``x_antes``
    and ``x_depois`` and are null on a side without the key. Null keys are equal to
    each other, and null values too. A key in several rows of one snapshot is an error:
    which of its rows changed has no answer. Empty snapshots are as good as any.

    The names of the changed blocks are a filter on the partition column, so the files
    of all others are never opened; the driver holds these names, at most one per
    partition folder, all of which Spark lists there too. Rows are folded by key and
    need no outer join, which adaptive execution could not split.
    """
    values = [c for c in schema.fieldNames() if c not in keys]
    blocks = [row[BLOCK] for row in changed_blocks(spark, before, after).collect()]
    state = F.struct(*values)
    sides = [
        _rows(spark, folder, schema)
        .where(F.col(BLOCK).isin(blocks))
        .select(
            *keys,
            (state if side == 0 else F.lit(None)).alias("_antes"),
            (state if side == 1 else F.lit(None)).alias("_depois"),
        )
        for side, folder in enumerate((before, after))
    ]
    found = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.first("_antes", ignorenulls=True).alias("_antes"),
        F.first("_depois", ignorenulls=True).alias("_depois"),
        F.count("_antes").alias("_n_antes"),
        F.count("_depois").alias("_n_depois"),
    )
    repeated = F.raise_error(F.lit("a key occurs in several rows of one snapshot")).cast("string")
    kind = (
        F.when((F.col("_n_antes") > 1) | (F.col("_n_depois") > 1), repeated)
        .when(F.col("_n_antes") == 0, "inserido")
        .when(F.col("_n_depois") == 0, "removido")
        .when(~F.col("_antes").eqNullSafe(F.col("_depois")), "alterado")
    )
    named = found.withColumn("mudanca", kind).where("mudanca is not null")
    return named.select(
        *keys, "mudanca",
        *[F.col(f"_antes.{v}").alias(f"{v}_antes") for v in values],
        *[F.col(f"_depois.{v}").alias(f"{v}_depois") for v in values],
    )
