"""Column expressions for dates, labels and missing values (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Label formats of the original outputs.
LABEL_FORMATS = {"year_month": "yyyy-MM", "mon_yy": "MMM-yy"}


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def qcol(name: str) -> Column:
    """Column by exact name, also for names with dots or spaces (``U.S.``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def iso_date_part(raw: ColumnOrName) -> Column:
    """Text before ``T`` of an ISO stamp: ``2024-01-05T09:00:00`` -> ``2024-01-05``."""
    return F.split_part(_c(raw), F.lit("T"), F.lit(1))


def parse_iso_date(raw: ColumnOrName, on_error: str = "null") -> Column:
    """Date of an ISO stamp with or without time; months and days may have one digit.

    Text that is not a date gives NULL, or fails the job with ``on_error='fail'``.
    """
    return _or_fail(_c(raw), F.try_to_date(iso_date_part(raw), "yyyy-M-d"), on_error)


def _or_fail(raw: Column, parsed: Column, on_error: str) -> Column:
    if on_error not in ("null", "fail"):
        raise ValueError("on_error must be 'null' or 'fail'")
    if on_error == "null":
        return parsed
    message = F.concat(F.lit("not a date: "), raw.cast("string"))
    return F.when(raw.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


# Spellings of a day or a month that the lenient parse reads.
LENIENT_FORMATS = {
    "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "yyyy-M": r"^\d{4}-\d{1,2}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "yyyyMMdd": r"^\d{8}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
    "MMM d, yyyy": r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
    "MMM yyyy": r"^[A-Za-z]{3} \d{4}$",
}


def parse_lenient_date(raw: ColumnOrName, on_error: str = "null") -> Column:
    """Date of text in one of ``LENIENT_FORMATS``, with an optional time of day;
    a bare month is its first day.  Other text gives NULL, or fails the job
    with ``on_error='fail'``."""
    text = F.trim(_c(raw).cast("string"))
    day = F.regexp_replace(text, r"^(\d[\d/-]*)[T ]\d{1,2}:.*$", "$1")  # 2024-01-05T09:00, 2024-01-05 09:00:00
    tries = [F.when(day.rlike(pattern), F.try_to_date(day, fmt)) for fmt, pattern in LENIENT_FORMATS.items()]
    return _or_fail(_c(raw), F.coalesce(*tries), on_error)


def first_of_month(d: ColumnOrName) -> Column:
    return F.trunc(_c(d), "MM")


def add_one_year(d: ColumnOrName) -> Column:
    """Same day next year; 29 February maps to 28 February."""
    return F.add_months(_c(d), 12)


def last_monday(month: ColumnOrName) -> Column:
    """Last Monday of the month that contains ``month``."""
    return F.next_day(F.date_sub(F.last_day(_c(month)), 7), "Mon")


def week_start(d: ColumnOrName) -> Column:
    """Most recent Monday, the day itself if it is a Monday."""
    return F.date_trunc("week", _c(d)).cast("date")


def label(d: ColumnOrName, fmt: str = LABEL_FORMATS["year_month"]) -> Column:
    return F.date_format(_c(d), fmt)


def month_label(d: ColumnOrName) -> Column:
    return label(d, LABEL_FORMATS["mon_yy"])


def nan_to_null(v: ColumnOrName) -> Column:
    """Missing is NULL inside the engine; NaN from payloads becomes NULL at the scan."""
    return F.nanvl(_c(v).cast("double"), F.lit(None).cast("double"))
