from lakeseries.functions.parsing import br_date, br_date_text, br_number, catalog_date
from lakeseries.functions.series import (
    display_label,
    is_missing,
    percent_change,
    percent_text,
    period_start,
    two_decimals,
)

__all__ = [
    "br_date",
    "br_date_text",
    "br_number",
    "catalog_date",
    "display_label",
    "is_missing",
    "percent_change",
    "percent_text",
    "period_start",
    "two_decimals",
]
