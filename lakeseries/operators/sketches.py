"""Approximate quantiles and distinct counts from stored sketches that merge.

A quantile sketch is a table of counts per logarithmic bucket: bucket ``b`` holds
the magnitudes in ``(g^(b-1), g^b]`` with ``g = (1 + a) / (1 - a)``. Sketches of parts
merge by adding counts, in any order and with the same result. The answer for a
bucket differs from each value in it by at most the share ``a`` of that value, and
the bucket of a quantile is always the right one. A distinct sketch is a
HyperLogLog register set of Spark's own aggregate, merged by its union.

Both are kept per series and month; coarser levels are merged from them and never
read the observations again.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR = 0.01
HLL_BITS = 14
_HASHED = ("integer", "long", "string", "binary")


def _gamma(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError("the relative error lies between 0 and 1")
    return (1 + error) / (1 - error)


def _bucket(value: Column, error: float) -> Column:
    return F.ceil(F.ln(F.abs(value)) / math.log(_gamma(error))).cast("int")


def quantile_sketch(
    rows: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    value: str = "valor",
    error: float = ERROR,
) -> DataFrame:
    """Counts per key, month, sign and bucket of the values of ``rows``.

    Null, NaN and infinite values, and rows without a date, are not counted. A month
    of a series has at most as many rows as its values have buckets: 1,400 for
    twelve orders of magnitude at the error of 0.01.
    """
    number = F.col(value).cast("double")
    finite = ~F.isnan(number) & (F.abs(number) < float("inf"))  # null is neither
    known = rows.where(finite & F.col(date).isNotNull())
    sign = F.signum(number).cast("int")
    return known.groupBy(
        *keys, F.year(date).alias("ano"), F.month(date).alias("mes"), sign.alias("sinal"),
        F.when(sign != 0, _bucket(number, error)).otherwise(0).alias("faixa"),
    ).agg(F.count(F.lit(1)).alias("quantidade"))


def merged_sketch(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches, or a union of sketches of parts, as those of the coarser ``keys``."""
    return sketch.groupBy(*keys, "sinal", "faixa").agg(F.sum("quantidade").alias("quantidade"))


def quantiles(
    sketch: DataFrame,
    shares: Sequence[float],
    keys: Sequence[str] = (),
    error: float = ERROR,
) -> DataFrame:
    """Per key and share ``q``: ``posicao`` (from 1), ``quantidade`` of all values and ``valor``.

    The quantile is the value at position ``floor(q * (n - 1)) + 1`` of the ``n`` values
    in order; ``valor`` differs from it by at most ``error`` times its magnitude, and zero
    is exact. Windows hold the buckets of a key, not its values.
    """
    if not shares or any(not 0 <= q <= 1 for q in shares):
        raise ValueError("shares lie between 0 and 1, and there must be one")
    merged = merged_sketch(sketch, keys)
    every = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    up = every.orderBy("sinal", F.col("sinal") * F.col("faixa"))
    counted = merged.withColumns(
        {"_n": F.sum("quantidade").over(every),
         "_ate": F.sum("quantidade").over(up.rowsBetween(Window.unboundedPreceding, 0))}
    )
    gamma = _gamma(error)
    middle = F.col("sinal") * F.lit(2.0) * F.pow(F.lit(gamma), F.col("faixa")) / F.lit(gamma + 1)
    asked = counted.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in shares])))
    place = (F.floor(F.col("q") * (F.col("_n") - 1)) + 1).cast("long")
    inside = (place <= F.col("_ate")) & (place > F.col("_ate") - F.col("quantidade"))
    return asked.where(inside).select(
        *keys, "q", place.alias("posicao"), F.col("_n").alias("quantidade"), "sinal", "faixa",
        F.when(F.col("sinal") == 0, F.lit(0.0)).otherwise(middle).alias("valor"),
    )


def distinct_sketch(
    rows: DataFrame,
    item: str,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    bits: int = HLL_BITS,
) -> DataFrame:
    """Per key and month the registers of the distinct ``item`` values; nulls do not count.

    Items of types that Spark's aggregate does not take are told apart by their text.
    """
    known = rows.where(F.col(date).isNotNull())
    if rows.schema[item].dataType.typeName() not in _HASHED:
        known = known.withColumn(item, F.col(item).cast("string"))
    return known.groupBy(*keys, F.year(date).alias("ano"), F.month(date).alias("mes")).agg(
        F.hll_sketch_agg(item, F.lit(bits)).alias("registros")
    )


def distinct_estimates(sketch: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per key the estimated number of distinct items in all its months.

    The standard error is about ``1.04 / sqrt(2 ** bits)``, 0.8 % with 14 bits, whatever
    the number of merged sketches.
    """
    return sketch.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("registros")).alias("estimativa")
    )
