"""Text <-> value expressions for Brazilian dates and numbers.

All of them are plain Column expressions. The lenient ones use the ``try_``
family, so a bad record becomes null under ANSI mode while real errors
elsewhere still surface.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

BR_DATE = "dd/MM/yyyy"
BR_DATE_UNPADDED = "d/M/yyyy"


def br_date(text: Column) -> Column:
    """``31/12/2024`` to a date; anything else to null."""
    return F.try_to_date(text, BR_DATE)


def catalog_date(text: Column) -> Column:
    """Catalog dates also come without zero padding (``1/1/2015``)."""
    return F.try_to_date(text, BR_DATE_UNPADDED)


def br_date_text(date: Column) -> Column:
    return F.date_format(date, BR_DATE)


def br_number(text: Column) -> Column:
    """Decimal comma to double; text that is no number becomes null.

    Every comma turns into a dot, so a value with thousands separators
    (``1.234,56``) is no number and becomes null.
    """
    return F.translate(text, ",", ".").try_cast("double")
