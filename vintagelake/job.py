"""The whole job: landed payloads and editions -> combined vintage -> targets.

Mirrors the original main program as one Spark application: each provider
is a lazy plan over landed tables, missing providers are skipped (an error if
all are missing), the combined long table refreshes the target in full, the
edition provider's wide table is written as a dated CSV snapshot, and a run
summary (rows per source and in total) is returned.

    python -m vintagelake.job --landing /shared/landing --target /shared/vintage \\
        --as-of 2024-05-06 --run-date 20240506
"""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from vintagelake import schemas
from vintagelake.schemas import SINK_COLUMNS
from vintagelake.operators.combine import sink_rows
from vintagelake.operators.reshape import observed_values, wide_view
from vintagelake.plans import providers
from vintagelake.sinks import (full_refresh_jdbc, full_refresh_table, publish_table, read_published, run_summary,
                               write_csv_snapshot)
from vintagelake.sources import dims
from vintagelake.session import local_frame, path_exists
from vintagelake.sources.payloads import (load_metrics, of_item, read_payloads, release_index_outcomes,
                                          release_series_outcomes, report_outcomes)
from vintagelake.sources.tables import read_editions_jdbc
from vintagelake.streaming.landing import landed_days, read_landed

#: Counts and ranges of a report load.
LOAD_SCHEMA = ("min_report_date date, max_report_date date, min_month date, max_month date, n_rows long, "
               "n_not_first_of_month long, n_removed long, n_bad_values long")
LOAD_COLUMNS = [c.split()[0] for c in LOAD_SCHEMA.split(", ")]


@dataclass
class JobConfig:
    landing: str                       # folder with the landed tables below
    target: str | None = None          # parquet target (full refresh)
    published: str | None = None       # versioned parquet target (sinks.publish_table)
    jdbc: dict[str, str] | None = None  # url, dbtable, user, ... (full refresh)
    csv_folder: str | None = None      # edition snapshot folder
    as_of: str = ""                    # report calendar as-of date (never the clock)
    run_date: str = ""                 # snapshot stamp YYYYMMDD
    release_start: str = "2019-12-01"
    report_start: str = "2019-12-01"
    label_format: str = "yyyy-MM"
    payload_format: str = "parquet"
    debug: bool = False
    editions_jdbc: dict[str, str] | None = None  # url, dbtable or query, user, ... instead of the editions folder
    status_folder: str | None = None   # payload statuses and date ranges of the load
    dims_folder: str | None = None     # optional parquet overrides: dataset_dim, series_dim, hierarchy, renames
    rollups: list = field(default_factory=lambda: dims.REPORT_ROLLUPS)

    def path(self, name: str) -> str:
        return os.path.join(self.landing, name)


def _exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def _dim(spark: SparkSession, cfg: JobConfig, name: str, schema: str, default):
    if cfg.dims_folder and _exists(spark, os.path.join(cfg.dims_folder, name)):
        return spark.read.schema(schema).parquet(os.path.join(cfg.dims_folder, name)), True
    return default(), False


def _editions(spark: SparkSession, cfg: JobConfig) -> DataFrame | None:
    if cfg.editions_jdbc:
        opts = dict(cfg.editions_jdbc)
        return read_editions_jdbc(spark, opts.pop("url"), opts.pop("dbtable", None), opts, opts.pop("query", None))
    if _exists(spark, cfg.path("editions")):
        return spark.read.schema(schemas.EDITIONS).parquet(cfg.path("editions"))
    return None


def _payloads(spark: SparkSession, cfg: JobConfig) -> dict[str, DataFrame]:
    """The landed payload tables that exist, by kind."""
    kinds = {"release_index": schemas.RELEASE_INDEX_PAYLOADS, "release_series": schemas.RELEASE_SERIES_PAYLOADS,
             "report": schemas.REPORT_PAYLOADS}
    return {k: read_payloads(spark, cfg.path(k), schema, cfg.payload_format, schemas.LANDED[k])
            for k, schema in kinds.items() if _exists(spark, cfg.path(k))}


def _landed(spark: SparkSession, cfg: JobConfig, stage) -> dict[str, DataFrame]:
    """The tables of parsed rows that ``streaming.landing`` writes (``<kind>_rows``), by kind:
    keyed ones, or appended ones."""
    kinds = {"release_index": schemas.RELEASE_INDEX, "release_series": schemas.LANDED_RELEASE_SERIES,
             "report": schemas.LANDED_REPORT_ROWS}

    def read(kind: str) -> DataFrame:
        path = cfg.path(f"{kind}_rows")
        if _exists(spark, f"{path}/keys"):
            return read_landed(spark, path, kind, stage=stage)
        return spark.read.schema(kinds[kind]).parquet(path)

    return {k: read(k) for k in kinds if _exists(spark, cfg.path(f"{k}_rows"))}


@dataclass
class Opened:
    """Every payload table parsed once (``providers.open_payloads``), and what was counted on the way."""
    tables: dict[str, DataFrame]
    report_load: Observation | None = None


def open_all(spark: SparkSession, cfg: JobConfig, stage=providers.stage) -> Opened:
    payloads = _payloads(spark, cfg)
    seen = Observation("report load") if "report" in payloads else None
    tables = providers.build_all(spark, {
        k: lambda k=k, df=df: providers.open_payloads(
            k, df, stage=stage, **({"observed": seen, "metrics": load_metrics(dims.REPORT_ITEM)} if k == "report" else {}))
        for k, df in payloads.items()})
    return Opened(tables, seen)


def build(spark: SparkSession, cfg: JobConfig, stage=providers.stage,
          opened: Opened | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The provider plans whose landed inputs exist, and the series dimension.

    Payload tables come first; where a kind has none, its landed rows are used.
    Landed report rows name their item: one is selected, while the days of all
    are the probe.
    """
    payloads = (opened or open_all(spark, cfg, stage)).tables
    dataset_dim, _ = _dim(spark, cfg, "dataset_dim", schemas.DATASET_DIM, lambda: dims.dataset_dim(spark))
    series_dim, custom_series = _dim(spark, cfg, "series_dim", schemas.SERIES_DIM, lambda: dims.series_dim(spark))
    hierarchy, _ = _dim(spark, cfg, "hierarchy", schemas.HIERARCHY, lambda: dims.hierarchy(spark, cfg.rollups))
    renames, _ = _dim(spark, cfg, "renames", schemas.RENAME_DIM, lambda: dims.rename_dim(spark))
    landed, editions = _landed(spark, cfg, stage), _editions(spark, cfg)
    first = 3 if cfg.debug else None
    builders = {}
    if {"release_index", "release_series"} <= set(payloads):
        builders["release"] = lambda: providers.release_provider_from_opened(
            payloads["release_index"], payloads["release_series"], dataset_dim, cfg.release_start, first, stage)
    elif {"release_index", "release_series"} <= set(landed):
        builders["release"] = lambda: providers.release_provider(
            landed["release_index"], landed["release_series"], dataset_dim, cfg.release_start, first, stage=stage)
    if "report" in payloads:
        builders["report"] = lambda: providers.report_provider_from_opened(
            payloads["report"], hierarchy, renames, cfg.report_start, cfg.as_of, item=dims.REPORT_ITEM, stage=stage)
    elif "report" in landed:
        builders["report"] = lambda: providers.report_provider(
            landed["report"].where(of_item(dims.REPORT_ITEM)).drop("item"), landed_days(spark, cfg.path("report_rows")),
            hierarchy, renames, cfg.report_start, cfg.as_of, stage=stage)
    if editions is not None:
        # fixed ids reach the scan as an IN filter; a custom dimension is a semi-join
        ids = None if custom_series else [s for s, _ in dims.EDITION_SERIES]
        builders["edition"] = lambda: providers.edition_provider(editions, series_dim, series_ids=ids, stage=stage)
    return providers.build_all(spark, builders), series_dim


def write_status(spark: SparkSession, cfg: JobConfig, opened: Opened) -> None:
    """One table per kind of payload with an outcome per payload, from the payloads
    as they were parsed for the providers, and the report rows' counts and date
    ranges, gathered in that same pass; replaced in full."""
    describe = {"release_index": release_index_outcomes, "release_series": release_series_outcomes, "report": report_outcomes}
    for kind, df in opened.tables.items():
        full_refresh_table(describe[kind](df), f"{cfg.status_folder}/{kind}", allow_empty=True)
    if opened.report_load is not None:
        seen = opened.report_load.get
        full_refresh_table(local_frame(spark, [tuple(seen[c] for c in LOAD_COLUMNS)], LOAD_SCHEMA),
                           f"{cfg.status_folder}/report_ranges", allow_empty=True)


def run(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Run the job; returns the run summary (source, n_rows).  The tables it
    stages on the way are removed at its end, also if it fails."""
    stages = providers.Stages()
    try:
        opened = open_all(spark, cfg, stages)
        parts, series_dim = build(spark, cfg, stages, opened)
        rows = sink_rows(providers.combined_vintage(**parts), cfg.label_format)
        if cfg.status_folder:
            write_status(spark, cfg, opened)
        if cfg.target:
            full_refresh_table(rows, cfg.target, partition_by=["source"])
            # later sinks read the written table instead of computing the union again
            rows = spark.read.schema(rows.schema).parquet(cfg.target).select(*SINK_COLUMNS)
        if cfg.published:
            version = publish_table(rows, cfg.published, partition_by=["source"])
            rows = read_published(spark, cfg.published, rows.schema, version).select(*SINK_COLUMNS)
        if cfg.jdbc:
            opts = dict(cfg.jdbc)
            full_refresh_jdbc(rows, opts.pop("url"), opts.pop("dbtable"), opts)
        if cfg.csv_folder and "edition" in parts:
            locations = observed_values(series_dim, "location")
            wide = wide_view(parts["edition"], ["report_date", "month"], locations, fmt="MMM-yy")
            write_csv_snapshot(wide.withColumnRenamed("report_date", "reportDate"), cfg.csv_folder, cfg.run_date)
        counts = run_summary(rows)
        # a few numbers: collected, so that nothing reads the staged tables after this
        return local_frame(spark, counts.collect(), counts.schema)
    finally:
        stages.drop(spark)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--target")
    ap.add_argument("--published", help="versioned target: readers always see one whole version")
    ap.add_argument("--jdbc", help="JSON object of JDBC options incl. url and dbtable")
    ap.add_argument("--csv-folder")
    ap.add_argument("--as-of", required=True)
    ap.add_argument("--run-date", required=True)
    ap.add_argument("--release-start", default="2019-12-01")
    ap.add_argument("--report-start", default="2019-12-01")
    ap.add_argument("--label-format", default="yyyy-MM")
    ap.add_argument("--payload-format", default="parquet")
    ap.add_argument("--debug", action="store_true")
    ap.add_argument("--editions-jdbc", help="JSON object of JDBC options incl. url and dbtable or query")
    ap.add_argument("--status-folder")
    ap.add_argument("--dims-folder")
    a = ap.parse_args(argv)
    from vintagelake.session import get_spark
    spark = get_spark(app="vintagelake-job")
    cfg = JobConfig(landing=a.landing, target=a.target, published=a.published, jdbc=json.loads(a.jdbc) if a.jdbc else None,
                    csv_folder=a.csv_folder, as_of=a.as_of, run_date=a.run_date,
                    release_start=a.release_start, report_start=a.report_start,
                    label_format=a.label_format, payload_format=a.payload_format, debug=a.debug,
                    editions_jdbc=json.loads(a.editions_jdbc) if a.editions_jdbc else None,
                    status_folder=a.status_folder, dims_folder=a.dims_folder)
    run(spark, cfg).show(truncate=False)


if __name__ == "__main__":
    main()
