from vintagelake.functions.dates import (
    add_one_year,
    first_of_month,
    iso_date_part,
    label,
    last_monday,
    month_label,
    nan_to_null,
    parse_iso_date,
    parse_lenient_date,
    qcol,
    week_start,
)

__all__ = [
    "add_one_year", "first_of_month", "iso_date_part", "label", "last_monday",
    "month_label", "nan_to_null", "parse_iso_date", "parse_lenient_date", "qcol", "week_start",
]
