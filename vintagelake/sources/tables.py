"""Relational scans: the edition table (parquet or JDBC) and the testdata tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.functions import nan_to_null


def read_table(spark: SparkSession, base: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One parquet table; selecting columns here keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_editions_jdbc(spark: SparkSession, url: str, table: str | None = None,
                       properties: dict[str, str] | None = None, query: str | None = None,
                       num_partitions: int | None = None, partition_column: str | None = None,
                       lower_bound: str | None = None, upper_bound: str | None = None) -> DataFrame:
    """Edition table over JDBC, by table name or by SQL text (``query``).

    Filters written on the result of a table read are pushed to the database
    (``PushedFilters``); a partition column splits a table read across tasks.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", url)
    reader = reader.option("dbtable", table) if table is not None else reader.option("query", query)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def scan_editions(editions: DataFrame, series, flag: str = "Forecast") -> DataFrame:
    """Edition rows of the listed series that are forecasts, renamed to long form.

    ``series`` is a list of ids (an IN filter that reaches the scan) or a series
    dimension DataFrame (a left-semi join against it).
    Output: series_id, month, value, report_date.
    """
    rows = editions.filter(F.col("is_forecast") == flag)
    if isinstance(series, DataFrame):
        rows = rows.join(series.select("series_id"), "series_id", "left_semi")
    else:
        rows = rows.filter(F.col("series_id").isin(list(series)))
    return rows.select(
        "series_id",
        F.col("Date").cast("date").alias("month"),
        nan_to_null("data").alias("value"),
        F.col("Edition").cast("date").alias("report_date"),
    )
