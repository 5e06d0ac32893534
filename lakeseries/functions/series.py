"""Expressions over series values and periods."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent, two decimals; null without a previous value or at zero."""
    return F.round(F.try_divide(current - previous, previous) * 100, 2)


def is_missing(value: Column) -> Column:
    """Null or NaN."""
    return value.isNull() | F.isnan(value)


def period_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def display_label(name: Column) -> Column:
    """``taxa_media`` to ``Taxa Media``: every run of letters is capitalised."""
    spaced = F.lower(F.translate(name, "_", " "))
    runs = F.regexp_extract_all(spaced, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def two_decimals(value: Column) -> Column:
    """Fixed two decimals, rounding the exact binary value half to even."""
    return F.call_function("format_number", value, F.lit("0.00"))


def percent_text(value: Column) -> Column:
    """Two decimals and a percent sign; null stays null."""
    return F.when(~is_missing(value), F.concat(two_decimals(value), F.lit("%")))
