"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings every job relies on.  Partition counts are left to AQE: the initial
# shuffle partition count comes from the caller (cluster default or tests), and
# AQE coalesces small partitions and splits skewed join partitions at runtime.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "vintagelake",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
        pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is named.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; a machine
    local temporary folder is used only when the master is local (tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext; the conf names the folder
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it") from None
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):  # not local-cluster
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it")
    folder = tempfile.mkdtemp(prefix="vintagelake-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for tables written mid-job."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def local_frame(spark: SparkSession, rows, schema: str | StructType) -> DataFrame:
    """Small fixed data (dimensions, hierarchies, location lists) as a local
    relation built from an Arrow table.  Catalyst then knows its exact size, so
    its broadcast threshold decides the join without a hint or an extra job
    (a frame made from a Python list is an RDD scan of unknown size)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow_schema = to_arrow_schema(struct)
    rows = [tuple(r) for r in rows]
    columns = [pa.array([r[i] for r in rows], type=arrow_schema.field(i).type)
               for i in range(len(struct.fields))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow_schema), schema=struct)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (Hadoop file system; a read probe under Spark Connect)."""
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
    except Exception:  # noqa: BLE001 - no JVM gateway
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except Exception:  # noqa: BLE001
            return False


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder (Hadoop file system)."""
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder recursively; False where no file system access exists."""
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    except Exception:  # noqa: BLE001 - no JVM gateway (Spark Connect): leave it to housekeeping
        return False


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (Hadoop file system), sorted; none if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def make_file(spark: SparkSession, path: str) -> None:
    """Create an empty file: a mark that exists or does not, on every store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True).close()
