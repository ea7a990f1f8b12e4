"""The three providers and their union, as lazy long-form plans.

Inputs are landed, parsed tables (see ``sources.payloads``) and dimension
DataFrames.  Outputs have the canonical columns
(report_date, issue_date, month, location, value); ``combined_vintage`` adds
``source``.  Densifying needs the location list when the plan is built: for
the edition provider it is the series dimension; for the other two it is
collected from the staged cells, a bounded list like a pivot's.

Cells (one row per report, month and location) are staged once as a parquet
table in the shared checkpoint folder: listing their locations, checking them
and densifying them then read that compact table instead of recomputing the
scans, and the lineage is cut, so a lost executor does not send the job back
to the raw inputs.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vintagelake import schemas
from vintagelake.operators.aggregate import cell_mean, series_sum
from vintagelake.operators.calendar import report_calendar, snapped_dates
from vintagelake.operators.combine import combine, to_vintage
from vintagelake.operators.horizon import (cut_from_release, forecasts_only, latest_release_per_month,
                                           one_year_horizon, releases_since)
from vintagelake.operators.joins import lookup, rename_locations
from vintagelake.operators.limits import cap_rows_per_group, first_dims
from vintagelake.operators.reshape import densify, observed_values, unique_cells
from vintagelake.operators.rollup import dense_with_rollups
from vintagelake.session import delete_path, ensure_checkpoint_dir, shared_path
from vintagelake.sources.dims import EDITION_FORECAST_FLAG, EDITION_SCALE, SOURCE_NAMES
from vintagelake.sources import payloads as P
from vintagelake.sources.tables import scan_editions

KEYS = ["report_date", "month"]
OUT = ["report_date", "issue_date", "month", "location", "value"]


class Stages:
    """The staged tables of one run; ``drop`` removes them once nothing reads them any more."""

    def __init__(self):
        self.paths: list[str] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once as a parquet table in the shared checkpoint folder and return a scan of it."""
        spark = df.sparkSession
        path = shared_path(spark, "stage", f"{name}-{uuid.uuid4().hex}")
        df.write.mode("overwrite").parquet(path)
        self.paths.append(path)
        return spark.read.schema(df.schema).parquet(path)

    def drop(self, spark) -> None:
        while self.paths:
            delete_path(spark, self.paths.pop())


def stage(df: DataFrame, name: str) -> DataFrame:
    """A staged table that no run keeps track of (left to housekeeping of the checkpoint folder)."""
    return Stages()(df, name)


# ----------------------------------------------------------------------------
# Edition provider
# ----------------------------------------------------------------------------
def edition_cells(editions: DataFrame, series_dim: DataFrame, flag: str = EDITION_FORECAST_FLAG,
                  scale: float = EDITION_SCALE, series_ids: list[str] | None = None) -> DataFrame:
    """Lazy plan of the edition cells: report_date, month, location, value, issue_date.

    Scan forecasts of the listed series (the ids, or the dimension's ids),
    scale, sum per (edition, month, series) with empty groups summing to 0,
    map series to locations (unmapped ids keep their row key but no column),
    and check that no cell is duplicated.
    """
    rows = scan_editions(editions, series_ids if series_ids is not None else series_dim, flag)
    rows = rows.withColumn("value", F.col("value") * F.lit(scale))
    sums = series_sum(rows, ["report_date", "month", "series_id"])
    dim = series_dim.select("series_id", "location")
    mapped = lookup(sums, dim, "series_id", "left")
    # Sums are unique per series; when the dimension maps ids one-to-one onto
    # locations and only its ids are scanned, cells are unique by construction
    # and the small dimension is checked instead of every cell.
    if not _one_to_one(dim, series_ids):
        mapped = unique_cells(mapped, KEYS, "location")
    return mapped.select(*KEYS, "location", "value",
                         F.when(F.col("location").isNotNull(), F.col("report_date")).alias("issue_date"))


def _one_to_one(dim: DataFrame, ids: list[str] | None) -> bool:
    """Every scanned id maps to exactly one location and no location twice."""
    listed = F.lit(True) if ids is None else F.array_size(F.array_except(F.lit(ids), F.collect_set("series_id"))) == 0
    return dim.agg((F.count(F.lit(1)) == F.countDistinct("series_id")).alias("a"),
                   (F.count(F.lit(1)) == F.countDistinct("location")).alias("b"), listed.alias("c")).where("a AND b AND c").count() == 1


def edition_provider(editions: DataFrame, series_dim: DataFrame, flag: str = EDITION_FORECAST_FLAG,
                     scale: float = EDITION_SCALE, series_ids: list[str] | None = None,
                     strict: bool = True, stage=stage) -> DataFrame:
    """Edition table -> forecasts per (edition date, month, location).

    The cells (``edition_cells``) are staged, then every row key gets every
    location of the dimension.  ``strict`` makes a dimension location that
    never occurs an error, as selecting a missing column is.
    """
    cells = stage(edition_cells(editions, series_dim, flag, scale, series_ids), "edition-cells")
    locations = observed_values(series_dim, "location")
    if strict:
        seen = set(observed_values(cells, "location"))
        missing = [loc for loc in locations if loc not in seen]
        if missing:
            raise ValueError(f"locations never occur in the editions: {missing}")
    return densify(cells, KEYS, locations, ("value", "issue_date")).select(*OUT)


# ----------------------------------------------------------------------------
# Release provider
# ----------------------------------------------------------------------------
def chosen_releases(release_index: DataFrame, dataset_dim: DataFrame, start_date,
                    debug_first: int | None = None) -> DataFrame:
    """Lazy plan: the latest release per mapped dataset and month, on/after the start day."""
    dims = dataset_dim if debug_first is None else first_dims(dataset_dim, "ord", debug_first)
    idx = releases_since(release_index, start_date)
    idx = idx.join(dims.select("dataset_id"), "dataset_id", "left_semi")
    return latest_release_per_month(idx)


def release_cells(release_index: DataFrame, release_series: DataFrame, dataset_dim: DataFrame,
                  start_date, debug_first: int | None = None, chosen: DataFrame | None = None) -> DataFrame:
    """Lazy plan of the release cells: report_date, month, location, value, issue_date, ord, landed_at.

    Per mapped dataset: releases on/after the start day, the latest per month,
    its points on/after the release day.  Rows are keyed on the first day of
    the release month, so datasets released on different days of one month
    share a row while each is cut at its own release day.  Points with a NULL
    value are kept.  ``chosen``: the ``chosen_releases``, where the caller has them staged.
    """
    dims = dataset_dim if debug_first is None else first_dims(dataset_dim, "ord", debug_first)
    if chosen is None:
        chosen = chosen_releases(release_index, dataset_dim, start_date, debug_first)
    points = cut_from_release(release_series, chosen)
    cells = lookup(points, dims.select("dataset_id", "location", "ord"), "dataset_id", "inner")
    landed = F.col("landed_at") if "landed_at" in release_series.columns else F.lit(None).cast("timestamp")
    return cells.select(F.col("release_month").alias("report_date"), F.col("target_date").alias("month"),
                        "location", "value", F.col("release_date").alias("issue_date"), "ord", landed.alias("landed_at"))


def release_provider(release_index: DataFrame, release_series: DataFrame, dataset_dim: DataFrame,
                     start_date, debug_first: int | None = None,
                     locations: list[str] | None = None, stage=stage) -> DataFrame:
    """Release index + release series -> one vintage per release month.

    The cells (``release_cells``) are staged and densified over the locations
    that occur.  If two datasets write one location, the later dataset
    (greater ``ord``) wins.  Of two points of one target day (a payload landed
    twice) the one landed last holds, where the rows say so (``landed_at``), and
    the greater value of two landed together, whatever the order of rows; the
    payload parser keeps the greater text when a payload writes one day twice.
    """
    # a written table has a known size: the planner sees whether it can be
    # broadcast, so that the series' points need no shuffle for the join
    chosen = stage(chosen_releases(release_index, dataset_dim, start_date, debug_first), "release-chosen")
    cells = stage(release_cells(release_index, release_series, dataset_dim, start_date, debug_first, chosen), "release-cells")
    if locations is None:
        locations = observed_values(cells, "location")
    order = F.struct("ord", "landed_at", "value")
    return densify(cells, KEYS, locations, ("value", "issue_date"), order_col=order).select(*OUT)


# ----------------------------------------------------------------------------
# Report provider
# ----------------------------------------------------------------------------
def report_dates(available: DataFrame, start_date, as_of, fallback_days: int = 7,
                 date_col: str = "report_date") -> DataFrame:
    """Calendar candidates snapped to dates that exist in ``available``."""
    spark = available.sparkSession

    def lit_date(v):
        return F.lit(v.strftime("%Y-%m-%d") if isinstance(v, (dt.date, dt.datetime)) else v).cast("date")

    bounds = spark.range(1).select(lit_date(start_date).alias("start_date"), lit_date(as_of).alias("as_of"))
    return snapped_dates(report_calendar(bounds), available, fallback_days, date_col)


def report_cells(report_rows: DataFrame, available: DataFrame, start_date, as_of,
                 fallback_days: int = 7, row_limit: int | None = None) -> DataFrame:
    """Lazy plan of the report cells: report_date, month, location, value, issue_date.

    report_rows: report_date (requested), reportDate, month, subRegion, value.
    available: rows whose ``report_date`` says a report exists on that day.
    Calendar dates snapped to existing reports select the rows; the one-year
    horizon and month >= reportDate cut them; the mean per cell skips missing
    values, so cells, rows and locations without any value do not occur.
    """
    dates = report_dates(available, start_date, as_of, fallback_days)
    # At most one date per calendar month: bounded by the calendar, safe to broadcast.
    rows = report_rows.join(F.broadcast(dates), "report_date")
    rows = one_year_horizon(rows, "report_date", "month")
    if row_limit is not None:
        # the source's page limit, applied after its own filters; ours is ordered, not server order
        rows = cap_rows_per_group(rows, ["report_date"], ["month", "subRegion", "reportDate", "value"], row_limit)
    rows = forecasts_only(rows, "reportDate", "month")
    cells = cell_mean(rows.select(F.col("reportDate").alias("report_date"), "month",
                                  F.col("subRegion").alias("location"), "value"),
                      ["report_date", "month", "location"])
    return cells.withColumn("issue_date", F.col("report_date"))


def report_provider(report_rows: DataFrame, available: DataFrame, hierarchy: DataFrame,
                    renames: DataFrame | None, start_date, as_of, fallback_days: int = 7,
                    locations: list[str] | None = None, row_limit: int | None = None, stage=stage) -> DataFrame:
    """Report rows -> mean per cell, densified over the locations that have a
    value, plus regional rollups, with names renamed last."""
    cells = stage(report_cells(report_rows, available, start_date, as_of, fallback_days, row_limit),
                  "report-cells")
    if locations is None:
        locations = observed_values(cells, "location")
    out = dense_with_rollups(cells, hierarchy, KEYS, locations, ("value", "issue_date"),
                             rollup_columns={"issue_date": F.col("report_date")})
    if renames is not None:
        out = rename_locations(out, renames)
    return out.select(*OUT)


# ----------------------------------------------------------------------------
# From landed payloads
# ----------------------------------------------------------------------------
def open_payloads(kind: str, payloads: DataFrame, bad_rows: str = "drop_payload", stage=stage,
                  observed: Observation | None = None, metrics: list | None = None) -> DataFrame:
    """Payloads of a kind, each parsed once and staged: one row with its key, outcome
    and parsed content, from which rows and statuses are both read.

    ``observed``/``metrics``: aggregates gathered while they are written.  The
    write is the only stage that computes them, and of each of its partitions one
    finished task counts, so a lost executor does not count rows twice.
    """
    opener = {"release_index": P.open_release_index, "release_series": P.open_release_series, "report": P.open_reports}[kind]
    keys = schemas.PAYLOAD_KEYS[kind]
    for name in ("page", "landed_at"):
        if name not in payloads.columns and (name in keys or name == "landed_at"):
            payloads = payloads.withColumn(name, F.lit(None).cast("string" if name == "page" else "timestamp"))
    payloads = payloads.withColumns({"tie": F.xxhash64("payload"), "seq": F.monotonically_increasing_id()})
    extra = ("landed_at", "tie", "seq", *([] if kind != "report" else keys))
    opened = opener(payloads, keep=extra) if kind == "report" else opener(payloads, bad_rows, keep=extra)
    if observed is not None:
        opened = opened.observe(observed, *metrics)
    return stage(opened, f"opened-{kind}")


def release_provider_from_opened(index: DataFrame, series: DataFrame, dataset_dim: DataFrame, start_date,
                                 debug_first: int | None = None, stage=stage) -> DataFrame:
    """Release provider over ``open_payloads`` of indexes and series; of each key the payload landed last holds."""
    index = P.held_payloads(index, schemas.PAYLOAD_KEYS["release_index"], stage=stage)
    series = P.held_payloads(series, schemas.PAYLOAD_KEYS["release_series"], stage=stage)
    return release_provider(P.release_index_rows(index), P.release_series_rows(series), dataset_dim, start_date,
                            debug_first, stage=stage)


def release_provider_from_payloads(index_payloads: DataFrame, series_payloads: DataFrame,
                                   dataset_dim: DataFrame, start_date, bad_rows: str = "drop_payload",
                                   debug_first: int | None = None, stage=stage) -> DataFrame:
    """Release provider over landed payloads: (dataset_id, payload) release
    indexes and (dataset_id, release_raw, payload) series.  A key's last landed
    payload holds (``landed_at``); without that column a second one is an error."""
    index = P.last_landed(index_payloads, ["dataset_id"])
    series = P.last_landed(series_payloads, ["dataset_id", "release_raw"])
    return release_provider(P.parse_release_index(index, bad_rows), P.parse_release_series(series, bad_rows),
                            dataset_dim, start_date, debug_first, stage=stage)


def report_provider_from_opened(opened: DataFrame, hierarchy: DataFrame, renames: DataFrame | None, start_date, as_of,
                                item: str | None = None, fallback_days: int = 7, row_limit: int | None = None,
                                stage=stage) -> DataFrame:
    """Report provider over ``open_payloads`` of pages.  A report exists on a day
    when a page for that day has at least one record, of whatever item; ``item``
    selects records of the reports so found.  Of the pages landed for one
    (report_date, page) the last one holds; a page without a name always does."""
    held = P.held_payloads(opened, schemas.PAYLOAD_KEYS["report"], stage=stage)
    rows = P.report_records(held).where(P.of_item(item)).drop("item")
    return report_provider(rows, P.opened_with_records(held), hierarchy, renames, start_date, as_of,
                           fallback_days, row_limit=row_limit, stage=stage)


def report_provider_from_payloads(report_payloads: DataFrame, hierarchy: DataFrame,
                                  renames: DataFrame | None, start_date, as_of,
                                  item: str | None = None, fallback_days: int = 7,
                                  row_limit: int | None = None, stage=stage) -> DataFrame:
    """``report_provider_from_opened`` over landed (report_date, payload) pages, with a
    column ``page`` or without; each page is parsed once, for rows and for the probe."""
    return report_provider_from_opened(open_payloads("report", report_payloads, stage=stage), hierarchy, renames, start_date,
                                       as_of, item, fallback_days, row_limit, stage)


# ----------------------------------------------------------------------------
# Union
# ----------------------------------------------------------------------------
def build_all(spark, builders: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Build independent provider plans at once.

    Each provider stages its cells with its own Spark job; jobs submitted from
    several threads run side by side on the cluster's free slots instead of
    one after another.  The shared folder is resolved first so that the
    threads do not race to set it.
    """
    ensure_checkpoint_dir(spark)
    if len(builders) <= 1:
        return {k: f() for k, f in builders.items()}
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        futures = {k: pool.submit(f) for k, f in builders.items()}
        return {k: fut.result() for k, fut in futures.items()}


# ----------------------------------------------------------------------------
# Combined
# ----------------------------------------------------------------------------
def combined_vintage(release: DataFrame | None = None, report: DataFrame | None = None,
                     edition: DataFrame | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """Tag each provider's long table with its source name and union them.

    Missing providers are skipped; with none at all this raises.
    """
    names = names or SOURCE_NAMES
    frames = [to_vintage(df, names[key]) for key, df in
              (("release", release), ("report", report), ("edition", edition)) if df is not None]
    return combine(frames)


__all__ = ["build_all", "edition_provider", "release_provider", "report_provider", "report_dates",
           "edition_cells", "release_cells", "report_cells",
           "open_payloads", "release_provider_from_opened", "report_provider_from_opened",
           "release_provider_from_payloads", "report_provider_from_payloads", "combined_vintage", "stage"]
