"""Tagging, union of sources, sink order and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintagelake.functions import label
from vintagelake.schemas import SINK_COLUMNS, VINTAGE_COLUMNS


def tag(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def to_vintage(df: DataFrame, source: str | None = None) -> DataFrame:
    """Canonical column order; issue_date is added as NULL where a provider has none."""
    if source is not None:
        df = tag(df, source)
    if "issue_date" not in df.columns:
        df = df.withColumn("issue_date", F.lit(None).cast("date"))
    return df.select(*VINTAGE_COLUMNS)


def combine(frames: list[DataFrame], allow_missing_columns: bool = False) -> DataFrame:
    """Bag union by column name.  Fails when no frame is given."""
    if not frames:
        raise ValueError("no source to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing_columns), frames)


def grouped_by_source(df: DataFrame, keys: list[str], sources: dict[str, str], aggs: list[Column],
                      present: dict[str, str] | None = None, location: str = "location") -> DataFrame:
    """One aggregate over several sources of the same rows: source, ``keys``, location, ``aggs``.

    ``sources`` maps a source's name to the column that is its location.  Rows
    are expanded once per source inside the partial aggregate (grouping sets),
    not multiplied before it.  ``present`` names, for a source that lacks some of
    the rows, a boolean column that says which it has.
    """
    flags = present or {}
    sets = [[*keys, of, *([flags[name]] if name in flags else [])] for name, of in sources.items()]
    columns = list(dict.fromkeys(c for s in sets for c in s))
    grouped = df.groupingSets(sets, *columns).agg(
        *aggs, *[F.grouping(of).alias(f"_not_{i}") for i, of in enumerate(sources.values())])
    name, place, wanted = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(True)
    for i, (source, of) in enumerate(sources.items()):
        own = F.col(f"_not_{i}") == 0
        name, place = F.when(own, F.lit(source)).otherwise(name), F.when(own, F.col(of)).otherwise(place)
        if source in flags:
            wanted = wanted & (~own | F.col(flags[source]))
    made = [c for c in grouped.columns if c not in columns and not c.startswith("_not_")]
    return grouped.where(wanted).select(name.alias("source"), *keys, place.alias(location), *made)


def refuse_empty(df: DataFrame) -> DataFrame:
    """Raise before a full refresh would replace a table with nothing."""
    if df.isEmpty():
        raise ValueError("no rows from any source; refusing to refresh the target")
    return df


def sink_order(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Total order for sinks that keep order (files): ascending, missing last."""
    cols = columns or ["source", "report_date", "month", "location"]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def with_place(ordered: DataFrame, stage, name: str = "place") -> DataFrame:
    """Rows of a sorted frame with their place in it, from 1.

    The rows are written (``stage``) with their number inside their partition;
    the partitions' sizes, one row each, give what lies before them.  No task
    sees more than its own partition.
    """
    written = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (written.withColumn("_part", part).join(F.broadcast(sizes), "_part")  # a row per partition
            .withColumn(name, F.col("_before") + inside + 1).drop("_part", "_before", "_at"))


def sink_rows(df: DataFrame, fmt: str = "yyyy-MM") -> DataFrame:
    """Canonical rows -> (reportDate, month, location, value, source) with date labels.

    Labels are made here only, at the edge; ``fmt`` ``MMM-yy`` gives ``Mar-24``.
    """
    return df.select(label("report_date", fmt).alias("reportDate"), label("month", fmt).alias("month"),
                     "location", "value", "source").select(*SINK_COLUMNS)
