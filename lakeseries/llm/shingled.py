"""Words and their hashes as native columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    plain = F.lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(plain, r"[^\p{L}\p{N}]+"), "")


def hashes(array: Column) -> Column:
    return F.transform(array, lambda w: F.xxhash64(w))


def keyed(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """``doc``, ``variant`` (tells rows with the same id apart) and ``text``; nulls kept."""
    return docs.select(
        F.col(f"`{id_column}`").alias("doc"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("variant"),
        F.col(f"`{text}`").alias("text"),
    )




ROWS_AT_ONCE = 250_000


def blocks(few: DataFrame) -> list[DataFrame]:
    """``few`` in blocks of about ``ROWS_AT_ONCE`` rows, dealt by a hash of the whole row."""
    n = max(1, -(-few.count() // ROWS_AT_ONCE))
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in few.columns]), F.lit(n))
    return [few.where(place == block) for block in range(n)]


def meet(many: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Inner join on a column of numbers, ``few`` broadcast in blocks of bounded size.

    ``few`` is a stated query set of a few numbers per row, without repeated rows.
    Each block is one pass over ``many``; a small set is one block. Rows of one
    key may be in several blocks, so a frequent key makes no block greater.
    """
    met = None
    for block in blocks(few):
        part = many.join(F.broadcast(block), key)
        met = part if met is None else met.unionByName(part)
    return met
