"""SQL access: the combined vintage as temporary views.

    register_views(spark, vintage)
    spark.sql("SELECT source, count(*) AS n_rows FROM vintage GROUP BY ROLLUP (source)")

``vintage`` has the canonical columns (dates); ``vintage_sink`` the sink
columns (labels).  Both are views over the same lazy plan, so Catalyst plans
SQL on them exactly as DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintagelake.operators.combine import sink_rows


def register_views(spark: SparkSession, vintage: DataFrame, prefix: str = "vintage",
                   label_format: str = "yyyy-MM") -> list[str]:
    vintage.createOrReplaceTempView(prefix)
    sink_rows(vintage, label_format).createOrReplaceTempView(f"{prefix}_sink")
    return [prefix, f"{prefix}_sink"]
