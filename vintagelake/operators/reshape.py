"""Pivot, melt and densify.

Long form is canonical.  ``densify`` produces every (key, location) pair of a
report table, with missing cells as NULL rows, which is what a pivot followed
by a melt yields.  It is written as a spine (each row key with the list of
locations) left-joined with the cells, so locations are values, never column
names: their number and spelling do not matter, and a filter on location or on
a key reaches the scan of the cells.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.functions import qcol

def observed_values(df: DataFrame, column: str = "location") -> list[str]:
    """Sorted distinct non-NULL values of a dimension column, for the columns
    of a wide view or the location list of ``densify``."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def unique_cells(df: DataFrame, keys: list[str], pivot_col: str = "location",
                 value_cols: tuple[str, ...] = ("value",)) -> DataFrame:
    """Strict pivot check: more than one row for a cell raises at run time."""
    g = df.groupBy(*keys, pivot_col).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in value_cols])
    msg = F.concat(F.lit("duplicate cell for "), F.coalesce(F.col(pivot_col).cast("string"), F.lit("NULL")))
    checked = [F.when(F.col("_n") > 1, F.raise_error(msg)).otherwise(F.col(c)).alias(c) for c in value_cols]
    return g.select(*keys, pivot_col, *checked)


_AGGS = {"first": F.first, "avg": F.avg, "max": F.max, "sum": F.sum, "min": F.min}


def pivot_wide(df: DataFrame, keys: list[str], values: list[str], pivot_col: str = "location",
               value: str = "value", agg: str = "first") -> DataFrame:
    """Wide view: one column per listed value, in list order.  Presentation only."""
    return df.groupBy(*keys).pivot(pivot_col, list(values)).agg(_AGGS[agg](value))


def melt(df: DataFrame, ids: list[str], value_cols: list[str] | None = None,
         var: str = "location", val: str = "value") -> DataFrame:
    """Every non-id column to (var, val) rows; NULL values are kept as rows."""
    cols = value_cols if value_cols is not None else [c for c in df.columns if c not in ids]
    return df.unpivot([qcol(c) for c in ids], [qcol(c) for c in cols], var, val)


def _list(values: list[str]) -> Column:
    """An array of texts as one literal: the plan stays small however long the list is."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def densify(cells: DataFrame, keys: list[str], locations: list[str],
            value_cols: tuple[str, ...] = ("value",), order_col=None,
            location_col: str = "location") -> DataFrame:
    """keys x locations; a location without a cell in a key row gets NULL values.

    Rows of ``cells`` that share (keys, location) are resolved by ``order_col``
    (a column name or expression; the row with the greatest order wins, as a
    later assignment overwrites an earlier one); without it, cells must be unique.
    """
    if not locations:
        return cells.select(*keys, location_col, *value_cols).limit(0)
    spine = cells.select(*keys).distinct().select(*keys, F.explode(_list(locations)).alias(location_col))
    own = cells.where(F.col(location_col).isNotNull())
    if order_col is not None:
        last = F.max_by(F.struct(*value_cols), order_col).alias("_v")
        own = own.groupBy(*keys, location_col).agg(last).select(*keys, location_col, "_v.*")
    names = [*keys, location_col]
    own = own.select(*[F.col(c).alias(f"_{c}") for c in names], *value_cols)
    same = [spine[c].eqNullSafe(own[f"_{c}"]) if c in keys else spine[c] == own[f"_{c}"] for c in names]
    return spine.join(own, same, "left").select(*names, *value_cols)


def wide_view(long: DataFrame, keys: list[str], locations: list[str], fmt: str | None = None,
              pivot_col: str = "location", value: str = "value") -> DataFrame:
    """People's view: one column per location in list order, rows in true date
    order, and (optionally) the date keys turned into labels as the very last
    step, so ``Apr-24`` never sorts before ``Feb-24``."""
    wide = pivot_wide(long.select(*keys, pivot_col, value), keys, locations, pivot_col, value)
    wide = wide.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    if fmt:
        wide = wide.select(*[F.date_format(k, fmt).alias(k) for k in keys], *[qcol(loc) for loc in locations])
    return wide
