"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.session import path_exists, shared_path

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (``addPyFile``), once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_vintagelake_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="vintagelake-py-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)  # Spark's own file server hands it to every executor
    sc._vintagelake_shipped = True


#: Folders that ``stage`` has made in this application, in order.
MADE: list[str] = []

#: Spark drops a query's shuffle files at its end when this is set.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint directory and read it back.

    This cuts the lineage: what follows survives the loss of any executor
    without running the steps before it again, and the shuffle files of those
    steps go at once.
    """
    spark = df.sparkSession
    path = shared_path(spark, "vintagelake-llm", f"{label}-{uuid.uuid4().hex}")
    MADE.append(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files behind a staged frame that nothing reads any more."""
    from vintagelake.session import delete_path

    files = df.inputFiles()
    if files:
        folder = files[0].rsplit("/", 1)[0]
        if "/vintagelake-llm/" in folder and path_exists(df.sparkSession, folder):
            delete_path(df.sparkSession, folder)


def drop_made_since(spark: SparkSession, n: int, keep: DataFrame) -> None:
    """Delete the folders that were staged after the first ``n``, but for the one behind ``keep``.
    For a run whose last result is written: nothing reads the others any more."""
    from vintagelake.session import delete_path

    held = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in keep.inputFiles()}
    for path in MADE[n:]:
        if path.rsplit("/", 1)[-1] not in held:
            delete_path(spark, path)
            MADE.remove(path)


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of a text column, summed over all rows (one number comes back)."""
    return int(docs.agg(F.sum(F.octet_length(F.col(col))).alias("b")).first()["b"] or 0)


def without_ids(docs: DataFrame, rejected: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is not in ``rejected``.  A null key names no
    row, so rows without a key stay."""
    gone = rejected.select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, docs[key] == gone["__gone"], "left_anti")
