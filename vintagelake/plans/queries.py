"""Registered queries: one per operator key, each over the whole test tables.

Each builder takes (spark, base_dir) and returns a DataFrame whose columns are
named exactly as in the matching DuckDB oracle (``plans.oracle``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.functions import iso_date_part, label, month_label, parse_iso_date
from vintagelake.operators import aggregate, calendar, combine, horizon, joins, limits, reshape, rollup
from vintagelake.plans import providers
from vintagelake.plans import tpch_shapes as S
from vintagelake.session import shared_path
from vintagelake.sinks import full_refresh_table, read_csv_snapshot, write_csv_snapshot
from vintagelake.sources import payloads as P
from vintagelake.sources.tables import read_table, scan_editions
from vintagelake.streaming import land_keyed, read_landed

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}


def register(name: str):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        return fn
    return deco


def _r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


# ------------------------------------------------------------ edition side --
def _series_scan(spark, base):
    return scan_editions(S.editions(spark, base), S.series_dim(spark, base), "Forecast")


@register("series_scan")
def q_series_scan(spark, base):
    return _series_scan(spark, base)


@register("scale_units")
def q_scale_units(spark, base):
    rows = _series_scan(spark, base)
    return rows.select("series_id", "month", "report_date", (F.col("value") * 1000.0).alias("value"),
                       F.lit("KBD").alias("units"))


def _series_sums(spark, base):
    rows = _series_scan(spark, base).withColumn("value", F.col("value") * 1000.0)
    return aggregate.series_sum(rows, ["report_date", "month", "series_id"])


@register("series_sum")
def q_series_sum(spark, base):
    return _series_sums(spark, base)


@register("location_lookup")
def q_location_lookup(spark, base):
    # A partial dimension: series of nations outside region 4 only; unmatched ids keep NULL.
    n = S.nations(spark, base).filter(F.col("n_regionkey") != 4)
    dim = n.select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("series_id"),
                   F.col("n_name").alias("location"))
    return joins.lookup(_series_sums(spark, base), dim, "series_id", "left")


@register("location_rename")
def q_location_rename(spark, base):
    return joins.rename_locations(S.forecast_view(spark, base), S.renames_df(spark))


@register("edition_provider")
def q_edition_provider(spark, base):
    return providers.edition_provider(S.editions(spark, base), S.series_dim(spark, base))


@register("csv_snapshot")
def q_csv_snapshot(spark, base):
    """Edition provider, wide with Mon-YY labels and sorted location columns,
    written as a dated CSV snapshot and read back."""
    cells = providers.stage(providers.edition_cells(S.editions(spark, base), S.series_dim(spark, base)), "cells")
    locations = reshape.observed_values(S.series_dim(spark, base), "location")
    wide = reshape.wide_view(cells, ["report_date", "month"], locations, fmt="MMM-yy")
    wide = wide.withColumnRenamed("report_date", "reportDate")
    path = shared_path(spark, "snapshots", uuid.uuid4().hex)
    written = write_csv_snapshot(wide, path, run_date="20240101")
    return read_csv_snapshot(spark, written, wide.schema)


# ------------------------------------------------------------ release side --
@register("release_index_status")
def q_release_index_status(spark, base):
    return P.release_index_status(S.release_index_payloads(spark, base))


@register("release_index")
def q_release_index(spark, base):
    parsed = P.parse_release_index(S.release_index_payloads(spark, base))
    return horizon.releases_since(parsed, S.RELEASE_START)


@register("latest_release_per_month")
def q_latest_release(spark, base):
    idx = horizon.releases_since(S.release_index(spark, base), S.RELEASE_START)
    return horizon.latest_release_per_month(idx)


@register("horizon_from_release")
def q_horizon_from_release(spark, base):
    idx = horizon.releases_since(S.release_index(spark, base), S.RELEASE_START)
    chosen = horizon.latest_release_per_month(idx)
    return horizon.cut_from_release(S.release_series(spark, base), chosen).select(
        "dataset_id", "release_raw", "release_date", "release_month", "target_raw", "target_date", "value")


@register("map_explode")
def q_map_explode(spark, base):
    return P.parse_release_series(S.release_series_payloads(spark, base))


@register("payload_quality")
def q_payload_quality(spark, base):
    return P.release_series_status(S.defect_payloads(spark, base))


@register("dimension_limit")
def q_dimension_limit(spark, base):
    dims = limits.first_dims(S.dataset_dim(spark, base), "ord", S.DEBUG_DATASETS)
    v = S.forecast_view(spark, base)
    return v.join(F.broadcast(dims.select("location")), "location").select(
        "report_date", "month", "location", "value")


def _release_long(spark, base):
    return providers.release_provider(S.release_index(spark, base), S.release_series(spark, base),
                                      S.dataset_dim(spark, base), S.RELEASE_START)


@register("release_provider")
def q_release_provider(spark, base):
    return _release_long(spark, base)


@register("release_from_payloads")
def q_release_from_payloads(spark, base):
    return providers.release_provider_from_payloads(
        S.release_index_payloads(spark, base), S.release_series_payloads(spark, base),
        S.dataset_dim(spark, base), S.RELEASE_START)


@register("vintage_wide")
def q_vintage_wide(spark, base):
    # the wide view is a pivot of the cells; densifying first would add nothing
    cells = providers.stage(providers.release_cells(
        S.release_index(spark, base), S.release_series(spark, base), S.dataset_dim(spark, base), S.RELEASE_START), "cells")
    locations = reshape.observed_values(cells, "location")
    return reshape.pivot_wide(cells, ["report_date", "month"], locations)


# ------------------------------------------------------------- report side --
@register("report_payload")
def q_report_payload(spark, base):
    return P.parse_report_payloads(S.report_payloads(spark, base))


@register("report_payload_status")
def q_report_payload_status(spark, base):
    return P.report_status(S.report_payloads_by_order(spark, base), id_col="o_orderkey")


@register("report_calendar")
def q_report_calendar(spark, base):
    o = read_table(spark, base, "orders", ["o_orderdate"])
    bounds = o.agg(F.min("o_orderdate").cast("date").alias("start_date"),
                   F.max("o_orderdate").cast("date").alias("as_of"))
    return calendar.report_calendar(bounds)


@register("report_date_snap")
def q_report_date_snap(spark, base):
    o = read_table(spark, base, "orders", ["o_orderdate"])
    bounds = o.agg(F.min("o_orderdate").cast("date").alias("start_date"),
                   F.max("o_orderdate").cast("date").alias("as_of"))
    cands = calendar.report_calendar(bounds)
    return calendar.snap_report_dates(cands, S.available_reports(spark, base))


@register("horizon_one_year")
def q_horizon_one_year(spark, base):
    return horizon.one_year_horizon(horizon.forecasts_only(S.forecast_view(spark, base), "report_date", "month"))


@register("rows_per_report_cap")
def q_rows_per_report_cap(spark, base):
    return limits.cap_rows_per_group(S.forecast_view(spark, base), ["report_date"],
                                     ["month", "location", "value"], S.ROWS_PER_REPORT)


@register("cell_mean")
def q_cell_mean(spark, base):
    cells = aggregate.cell_mean(S.forecast_view(spark, base, with_nulls=True),
                                ["report_date", "month", "location"])
    return cells.select("report_date", "month", "location", _r6("value"))


@register("pivot_mean")
def q_pivot_mean(spark, base):
    cells = providers.stage(aggregate.cell_mean(S.forecast_view(spark, base, with_nulls=True),
                                                ["report_date", "month", "location"]), "cells")
    locations = reshape.observed_values(cells, "location")
    wide = reshape.pivot_wide(cells, ["report_date", "month"], locations)
    return wide.select("report_date", "month", *[_r6(f"`{loc}`").alias(loc) for loc in locations])


def _monthly_sums(spark, base):
    m = S.monthly_view(spark, base)
    return aggregate.series_sum(m, ["report_month", "month", "location"])


def _nation_names(spark, base):
    return reshape.observed_values(S.nations(spark, base), "n_name")


@register("pivot_strict")
def q_pivot_strict(spark, base):
    cells = reshape.unique_cells(_monthly_sums(spark, base), ["report_month", "month"])
    return reshape.pivot_wide(cells, ["report_month", "month"], _nation_names(spark, base))


@register("melt_keep_nulls")
def q_melt_keep_nulls(spark, base):
    wide = q_pivot_strict(spark, base)
    return reshape.melt(wide, ["report_month", "month"])


def _dense_means(spark, base):
    """The dense table of means and its locations; the cells are computed once and staged."""
    m = S.monthly_view(spark, base, with_nulls=True)
    cells = providers.stage(aggregate.cell_mean(m, ["report_month", "month", "location"]), "cells")
    locations = reshape.observed_values(cells, "location")
    return reshape.densify(cells, ["report_month", "month"], locations), locations


@register("densify")
def q_densify(spark, base):
    dense, _ = _dense_means(spark, base)
    return dense.select("report_month", "month", "location", _r6("value"))


def _rollup_only(spark, base, rollups):
    dense, locations = _dense_means(spark, base)
    r = rollup.rollup_values(dense, S.rollups_df(spark, rollups), ["report_month", "month"], locations=locations)
    return r.select("report_month", "month", "location", _r6("value"))


@register("rollup_skipna")
def q_rollup_skipna(spark, base):
    return _rollup_only(spark, base, S.SKIP_ROLLUPS)


@register("rollup_strict")
def q_rollup_strict(spark, base):
    return _rollup_only(spark, base, S.PROPAGATE_ROLLUPS)


@register("rollup_guard")
def q_rollup_guard(spark, base):
    m = S.monthly_view(spark, base, with_nulls=True)
    cells = providers.stage(aggregate.cell_mean(m, ["report_month", "month", "location"]), "cells")
    locations = reshape.observed_values(cells, "location")
    out = rollup.dense_with_rollups(cells, S.rollups_df(spark, S.TEST_ROLLUPS), ["report_month", "month"], locations)
    return out.select("report_month", "month", "location", _r6("value"))


def _report_long(spark, base):
    return providers.report_provider(S.report_rows(spark, base), S.available_reports(spark, base),
                                     S.rollups_df(spark, S.TEST_ROLLUPS), S.renames_df(spark),
                                     S.CALENDAR_START, S.CALENDAR_AS_OF)


@register("report_provider")
def q_report_provider(spark, base):
    return _report_long(spark, base).select("report_date", "issue_date", "month", "location", _r6("value"))


@register("report_from_payloads")
def q_report_from_payloads(spark, base):
    out = providers.report_provider_from_payloads(
        S.report_payloads(spark, base), S.rollups_df(spark, S.TEST_ROLLUPS), S.renames_df(spark),
        S.CALENDAR_START, S.CALENDAR_AS_OF, item="main")
    return out.select("report_date", "issue_date", "month", "location", _r6("value"))


def _landed_twice(spark, base, kind, payloads, spoiled):
    """Rows of a keyed landing: a third of the payloads first land in another form, then all as they are."""
    payloads = providers.stage(payloads, "payloads")  # made once, landed twice
    folder = shared_path(spark, "landed", uuid.uuid4().hex)
    source, target = f"{folder}/in", f"{folder}/{kind}"
    first = payloads.where(F.pmod(F.xxhash64(*[c for c in payloads.columns if c != "payload"]), F.lit(3)) == 0)
    for at, df in (("2024-01-01", first.withColumn("payload", spoiled)), ("2024-01-02", payloads)):
        df.withColumn("landed_at", F.lit(at).cast("timestamp")).write.mode("append").parquet(source)
        land_keyed(spark, source, target, kind, fmt="parquet").awaitTermination()
    return read_landed(spark, target, kind, stage=providers.stage)


@register("report_from_landed")
def q_report_from_landed(spark, base):
    """Report provider over rows landed by the stream, pages of all items, some landed twice."""
    pages = S.report_payloads_by_order(spark, base).select(
        "report_date", "payload", F.col("o_orderkey").cast("string").alias("page"))
    rows = _landed_twice(spark, base, "report", pages, F.regexp_replace("payload", '"item":"[a-z]+"', '"item":"main"'))
    out = providers.report_provider(
        rows.where(P.of_item("main")).drop("item"), rows.select("report_date"), S.rollups_df(spark, S.TEST_ROLLUPS),
        S.renames_df(spark), S.CALENDAR_START, S.CALENDAR_AS_OF)
    return out.select("report_date", "issue_date", "month", "location", _r6("value"))


@register("release_from_landed")
def q_release_from_landed(spark, base):
    """Release provider over series landed by the stream, some landed twice."""
    series = _landed_twice(spark, base, "release_series", S.release_series_payloads(spark, base), F.lit("[]"))
    return providers.release_provider(S.release_index(spark, base), series, S.dataset_dim(spark, base), S.RELEASE_START)


# ----------------------------------------------------------------- scalars --
@register("iso_date_part")
def q_iso_date_part(spark, base):
    e = read_table(spark, base, "events", ["event_id", "ts"])
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select("event_id", text.alias("ts_text"), iso_date_part(text).alias("day_text"),
                    parse_iso_date(text).alias("day"))


@register("month_labels")
def q_month_labels(spark, base):
    o = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate"])
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", d.alias("report_date"), label(d).alias("label_ym"),
                    month_label(d).alias("label_mon"))


# ----------------------------------------------------------------- combine --
def _three_sources(spark, base):
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])
    o = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    c = read_table(spark, base, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    p = read_table(spark, base, "part", ["p_partkey", "p_type"])
    n = S.nations(spark, base).select("n_nationkey", "n_name")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(p, li.l_partkey == p.p_partkey, "left").join(n, c.c_nationkey == n.n_nationkey))
    rows = j.select(F.col("o_orderdate").cast("date").alias("report_date"),
                    F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month"), "c_mktsegment", "p_type", "n_name",
                    F.col("p_partkey").isNotNull().alias("has_part"), "l_quantity")
    return combine.grouped_by_source(
        rows, ["report_date", "month"], {"by_segment": "c_mktsegment", "by_type": "p_type", "by_nation": "n_name"},
        [F.sum("l_quantity").alias("value")], present={"by_type": "has_part"})


@register("combine_sources")
def q_combine_sources(spark, base):
    """The union of three sources with each row's place in the sink's order."""
    return combine.with_place(combine.sink_order(_three_sources(spark, base)), providers.stage)


@register("rows_per_source")
def q_rows_per_source(spark, base):
    return aggregate.rows_per_source(_three_sources(spark, base))


def _combined(spark, base):
    parts = providers.build_all(spark, {
        "release": lambda: _release_long(spark, base),
        "report": lambda: _report_long(spark, base).withColumn("value", F.round("value", 6)),
        "edition": lambda: providers.edition_provider(S.editions(spark, base), S.series_dim(spark, base)),
    })
    return providers.combined_vintage(**parts)


@register("combined_vintage")
def q_combined_vintage(spark, base):
    return _combined(spark, base)


@register("run_summary")
def q_run_summary(spark, base):
    """Rows per source of the combined vintage, and in total (the run summary)."""
    return aggregate.rows_per_source(_combined(spark, base))


@register("full_refresh_sink")
def q_full_refresh_sink(spark, base):
    """Combined vintage as sink rows, refreshed in full into a table and read
    back (repeated refreshes leaving exactly the input rows is a unit test)."""
    rows = combine.sink_rows(_combined(spark, base))
    path = shared_path(spark, "tables", uuid.uuid4().hex)
    full_refresh_table(rows, path)
    return spark.read.parquet(path)


def queries() -> dict[str, Builder]:
    return dict(QUERIES)
