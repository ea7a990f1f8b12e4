"""Aggregations with the original job's null rules made explicit.

All of these group on their keys with partial (map-side) aggregation, so a
hot key is folded on every map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys_present(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def series_sum(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Sum per key; rows with a NULL key are dropped; a group of only missing
    values sums to 0.0 (not NULL)."""
    return (_keys_present(df, keys).groupBy(*keys)
            .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value)))


def cell_mean(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mean per cell over present values.  Missing values are dropped first, so
    a cell with no value has no row at all (and neither has a report row or a
    location made only of such cells)."""
    present = _keys_present(df, keys).filter(F.col(value).isNotNull())
    return present.groupBy(*keys).agg(F.avg(value).alias(value))


def load_ranges(df: DataFrame, report_col: str = "reportDate", month_col: str = "month",
                by: list[str] | None = None) -> DataFrame:
    """Min/max report date and month (per load, or per ``by`` key), rows, and
    rows whose target month is not the first day of a month (a quality count)."""
    aggs = [F.min(report_col).alias("min_report_date"), F.max(report_col).alias("max_report_date"),
            F.min(month_col).alias("min_month"), F.max(month_col).alias("max_month"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.dayofmonth(month_col) != 1).alias("n_not_first_of_month")]
    return df.groupBy(*(by or [])).agg(*aggs)


def rows_per_source(df: DataFrame, source_col: str = "source") -> DataFrame:
    """Rows per source plus a total row (source NULL); NULL values count as rows."""
    return df.rollup(source_col).agg(F.count(F.lit(1)).alias("n_rows"))
