"""Sinks: full refresh of a SQL or file table, dated CSV snapshots, run summary.

A full refresh replaces the target's rows with exactly the input rows, as one
Spark write: for JDBC, ``mode('overwrite')`` with ``truncate`` keeps the
table's definition and empties it before the executors insert; a failed
truncate fails the write (no append on top of old rows).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vintagelake.functions import qcol
from vintagelake.operators.combine import refuse_empty, sink_order
from vintagelake.session import delete_path, list_folder, make_file, path_exists, rename_path


def full_refresh_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
                      allow_empty: bool = False, num_partitions: int | None = None) -> None:
    """Replace the rows of a JDBC table with ``df``'s rows.

    ``num_partitions`` caps concurrent connections (one per write task).
    """
    if not allow_empty:
        refuse_empty(df)
    out = df.coalesce(num_partitions) if num_partitions else df
    writer = (out.write.format("jdbc").mode("overwrite")
              .option("url", url).option("dbtable", table).option("truncate", "true"))
    for key, value in properties.items():
        writer = writer.option(key, value)
    writer.save()


def full_refresh_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                       allow_empty: bool = False) -> str:
    """Replace a parquet table (in a shared folder) with ``df``'s rows.

    The new rows are written beside the old table, checked, and then take its
    place, so a job that fails leaves the old table, and ``df`` may read it.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(new)
        if not allow_empty:
            refuse_empty(spark.read.schema(df.schema).parquet(new))  # of what was written: no second run of the plan
        if path_exists(spark, path):
            rename_path(spark, path, old)
        try:
            rename_path(spark, new, path)
        except OSError:
            if path_exists(spark, old):
                rename_path(spark, old, path)
            raise
    finally:
        delete_path(spark, new)
    delete_path(spark, old)
    return path


def _published(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole versions, the newest last."""
    return list_folder(spark, f"{path}/_published")


def publish_table(df: DataFrame, path: str, partition_by: list[str] | None = None, allow_empty: bool = False,
                  keep: int = 2) -> str:
    """A full refresh that readers never see half of, on any store.

    Each refresh writes a folder of its own, ``versions/<number>-<id>``, which is
    never changed; an empty file of the same name in ``_published``, made last,
    says that it is whole.  ``read_published`` takes the newest.  Nothing is
    renamed, so there is no moment without a table; a refresh that breaks off
    leaves the version before it.  Of older versions ``keep`` - 1 stay, for readers
    that have begun with one.  Returns the name of the version.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = _published(spark, path)
    name = f"{int(before[-1].split('-')[0]) + 1 if before else 0:012d}-{uuid.uuid4().hex}"
    folder = f"{path}/versions/{name}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(folder)
        if not allow_empty:
            refuse_empty(spark.read.schema(df.schema).parquet(folder))
    except Exception:
        delete_path(spark, folder)
        raise
    make_file(spark, f"{path}/_published/{name}")
    # also versions without a mark, of refreshes that broke off, once a later one is whole
    kept = {*before[len(before) - keep + 1:], name} if keep > 1 else {name}
    newest = name.split("-")[0]
    for old in list_folder(spark, f"{path}/versions"):
        if old not in kept and old.split("-")[0] < newest:
            delete_path(spark, f"{path}/_published/{old}")
            delete_path(spark, f"{path}/versions/{old}")
    return name


def read_published(spark: SparkSession, path: str, schema: StructType | str, version: str | None = None) -> DataFrame:
    """The newest whole version of a table, or a given one."""
    path = path.rstrip("/")
    names = _published(spark, path)
    if not names:
        raise FileNotFoundError(f"{path} has no published version")
    whole = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return spark.read.schema(whole).parquet(f"{path}/versions/{version or names[-1]}").select(*[qcol(c) for c in whole.names])


def write_vintage_table(df: DataFrame, path: str) -> str:
    """Canonical vintage table partitioned by source and report month, so that
    reads filtered on either prune whole folders."""
    out = df.withColumn("report_month", F.date_format("report_date", "yyyy-MM"))
    return full_refresh_table(out, path, ["source", "report_month"])


def write_csv_snapshot(df: DataFrame, folder: str, run_date: str,
                       sort_by: list[str] | None = None) -> str:
    """A CSV snapshot with a header, in ``folder/run_date=<YYYYMMDD>``.

    ``run_date`` is an argument (never the clock).  Spark writes a directory of
    part files; ``sort_by`` orders rows (missing last) across the parts.
    """
    out = sink_order(df, sort_by) if sort_by else df
    path = f"{folder.rstrip('/')}/run_date={run_date}"
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def run_summary(df: DataFrame, source_col: str = "source") -> DataFrame:
    """Rows per source and in total (total row has source NULL)."""
    from vintagelake.operators.aggregate import rows_per_source
    return rows_per_source(df, source_col)
