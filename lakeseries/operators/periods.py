"""Joins on validity periods: a row meets the periods that its date lies in.

Time is cut into bins of ``bin_days``. A period has a row per bin that it touches,
a date lies in one bin; rows then meet in an equi-join on key and bin, and the dates
are compared there. So a long series is dealt by bins, and no task compares
all rows of a key with all its periods. Two periods that share several bins meet
only in the one in which the later of them begins.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 92
_DAY = "date'1970-01-01'"


def _bin(date: str | Column, days: int) -> Column:
    return F.floor(F.datediff(date, F.expr(_DAY)) / days).cast("int")


def _clamped(
    periods: DataFrame, rows: DataFrame, keys: Sequence[str], since: str, until: str,
    row_since: str, row_until: str, bin_days: int,
) -> DataFrame:
    """The periods with ``_bin``, a row for each bin within the dates of the key's rows.

    Open and very long periods have no more bins than the rows of their key span.
    ``_passo`` numbers the bins of a period from 0.
    """
    span = rows.groupBy(*keys).agg(F.min(row_since).alias("_min"), F.max(row_until).alias("_max"))
    first = F.greatest(F.col(since), F.col("_min"))
    last = F.least(F.col(until), F.col("_max"))
    met = periods.join(span, list(keys)).where(first <= last)
    bins = F.sequence(_bin(first, bin_days), _bin(last, bin_days))
    return met.select(*periods.columns, F.posexplode(bins).alias("_passo", "_bin"))


def period_join(
    rows: DataFrame,
    periods: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    date: str = "data",
    since: str = "valido_de",
    until: str = "valido_ate",
    how: str = "left",
    bin_days: int = BIN_DAYS,
) -> DataFrame:
    """``rows`` with the other columns of every period of their keys that holds their date.

    Both ends belong to a period; a null end is open. A row in several periods comes
    once for each; with ``how="left"`` a row in none comes once, with nulls, and
    with ``"inner"`` not at all. Null keys and dates lie in no period. A period
    whose end is before its begin holds nothing; repeated rows and repeated
    periods all count. Columns of ``periods`` must not have names of ``rows``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a period join is left or inner, not {how}")
    others = [c for c in periods.columns if c not in keys]
    taken = {c.lower() for c in rows.columns} & {c.lower() for c in others}
    if taken:
        raise ValueError(f"both sides have columns {', '.join(sorted(taken))}")
    dated = rows.withColumn("_bin", _bin(date, bin_days))
    known = rows.where(F.col(date).isNotNull())
    binned = _clamped(periods, known, keys, since, until, date, date, bin_days)
    names = [f"_chave{i}" for i in range(len(keys))]
    right = binned.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_bin").alias("_bin_p"), *others
    )
    same = F.col("_bin") == F.col("_bin_p")
    for key, name in zip(keys, names):
        same = same & (F.col(key) == F.col(name))
    inside = F.coalesce(F.col(date) >= F.col(since), F.lit(True)) & F.coalesce(
        F.col(date) <= F.col(until), F.lit(True)
    )
    return dated.join(right, same & inside, how).drop("_bin", "_bin_p", *names)


def overlaps(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    left_period: tuple[str, str] = ("de", "ate"),
    right_period: tuple[str, str] = ("valido_de", "valido_ate"),
    bin_days: int = BIN_DAYS,
) -> DataFrame:
    """Pairs of a row of each side with equal keys whose periods share a day.

    Both ends belong to a period, null ends are open, and null keys meet nothing.
    Columns other than the keys must differ in name.
    """
    others = [c for c in right.columns if c not in keys]
    taken = {c.lower() for c in left.columns} & {c.lower() for c in others}
    if taken:
        raise ValueError(f"both sides have columns {', '.join(sorted(taken))}")
    (l_since, l_until), (r_since, r_until) = left_period, right_period

    def closed(side: DataFrame, since: str, until: str, mark: str) -> DataFrame:
        """Ends without open ones; beyond all dates of a calendar of four digits."""
        begin = F.coalesce(F.col(since), F.lit("0001-01-01").cast("date"))
        end = F.coalesce(F.col(until), F.lit("9999-12-31").cast("date"))
        return side.withColumns({f"_{mark}de": begin, f"_{mark}ate": end}).where(
            F.col(f"_{mark}de") <= F.col(f"_{mark}ate")
        )

    one = closed(left, l_since, l_until, "e")
    two = closed(right, r_since, r_until, "d")

    def ends(side: DataFrame, since: str, until: str) -> DataFrame:
        """The begins and ends that a side names; any day for a period open at both."""
        begin = F.coalesce(since, until, F.expr(_DAY))
        span = F.array(begin, F.coalesce(until, since, F.expr(_DAY)))
        return side.select(*keys, F.explode(span).alias("_dia"))

    # Every pair that overlaps does so within the dates that either side names.
    named = ends(left, l_since, l_until).unionByName(ends(right, r_since, r_until))
    one = _clamped(one, named, keys, "_ede", "_eate", "_dia", "_dia", bin_days)
    two = _clamped(two, named, keys, "_dde", "_date", "_dia", "_dia", bin_days)
    met = one.join(two.withColumnRenamed("_passo", "_passo_d"), [*keys, "_bin"])
    # In the first bin that a pair shares, and in no later one, one of them begins.
    owner = (F.col("_passo") == 0) | (F.col("_passo_d") == 0)
    found = met.where((F.col("_ede") <= F.col("_date")) & (F.col("_dde") <= F.col("_eate")))
    return found.where(owner).select(*left.columns, *others)


def range_by_period(
    rows: DataFrame,
    limits: DataFrame,
    keys: Sequence[str] = ("serie_codigo",),
    default: tuple[float, float] = (-1_000_000, 1_000_000),
    bin_days: int = BIN_DAYS,
) -> DataFrame:
    """Per key: rows, rows in no period, and values out of the ranges valid at their date.

    ``limits`` has the keys, ``valido_de``, ``valido_ate``, ``minimo`` and ``maximo``. A
    value is held against every period that its date lies in, or against ``default``
    if there is none; ``verificacoes`` counts these. Ends belong to a range, a null
    end is open, and missing values are out of no range.
    """
    bounds = limits.select(*keys, "valido_de", "valido_ate", "minimo", "maximo")
    marked = bounds.withColumn("_valido", F.lit(True))
    met = period_join(rows.select(*keys, "data", "valor"), marked, keys, bin_days=bin_days)
    alone = F.col("_valido").isNull()
    low = F.when(alone, F.lit(float(default[0]))).otherwise(F.col("minimo"))
    high = F.when(alone, F.lit(float(default[1]))).otherwise(F.col("maximo"))
    value = F.nanvl("valor", F.lit(None).cast("double"))
    out = F.coalesce(value < low, F.lit(False)) | F.coalesce(value > high, F.lit(False))
    return met.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("verificacoes"),
        F.count_if(alone).alias("sem_periodo"),
        F.count_if(out).alias("fora_da_faixa"),
    )
