"""Bounded samples of labelled texts for fitting."""

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def draw_texts(rows: DataFrame, n: int, chars: int) -> list[Row]:
    """``draw``, ``text`` of at most ``n`` rows of ``rows`` (``doc_id``, ``text``).

    The rows are those with the least 64-bit hash of id and text among the texts of
    at most ``chars`` characters. Where these are too few, the shortest of the longer
    ones follow, until there are ``n`` rows or ``n * chars`` characters; one row is
    always drawn if there is any. Null texts count as empty; repeated rows may be
    drawn repeatedly. The order does not depend on the layout of the table.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.char_length(text)
    place: Column = F.struct(
        F.greatest(size - chars, F.lit(0)).alias("beyond"),
        F.xxhash64("doc_id", text).alias("draw"),
    )
    # First the sizes alone, so that only texts that fit are sent to the driver.
    least = rows.select(place.alias("place"), size.alias("size")).orderBy("place").limit(n).collect()
    taken, total = 0, 0
    for row in least:
        total += row["size"]
        if taken and total > n * chars:
            break
        taken += 1
    if not taken:
        return []
    last = least[taken - 1]["place"]
    up_to = (place["beyond"] < last["beyond"]) | (
        (place["beyond"] == last["beyond"]) & (place["draw"] <= last["draw"])
    )
    drawn = rows.where(up_to).select(place.alias("place"), text.alias("text"))
    drawn = drawn.orderBy("place").limit(taken)
    return drawn.select(F.col("place.draw").alias("draw"), "text").collect()
