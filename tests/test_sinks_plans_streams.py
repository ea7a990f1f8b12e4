"""Sinks, plan shapes and the streaming landing."""

import datetime as dt
import json
import os
import tempfile

import pytest

from tests.conftest import SF_SMALL, rows
from vintagelake import schemas
from vintagelake.operators import calendar, combine, limits
from vintagelake.plans import tpch_shapes as S
from vintagelake.sinks import full_refresh_table, read_csv_snapshot, write_csv_snapshot
from vintagelake.sources import payloads as P
from vintagelake.sources.tables import scan_editions
from vintagelake.streaming import land


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tmp():
    return tempfile.mkdtemp(prefix="vintagelake-test-")


# -------------------------------------------------------------------- sinks
def test_full_refresh_three_times_leaves_the_input_rows(spark):
    df = spark.createDataFrame([("2024-01", "2024-02", "x", 1.0, "s"), ("2024-01", "2024-03", "y", None, "s")],
                               "reportDate string, month string, location string, value double, source string")
    path = os.path.join(_tmp(), "t")
    for _ in range(3):
        full_refresh_table(df, path)
    back = spark.read.parquet(path)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_full_refresh_refuses_empty_input_and_keeps_target(spark):
    df = spark.createDataFrame([("a", 1.0)], "location string, value double")
    path = os.path.join(_tmp(), "t")
    full_refresh_table(df, path)
    with pytest.raises(ValueError):
        full_refresh_table(df.limit(0), path)
    assert spark.read.parquet(path).count() == 1


def test_csv_snapshot_round_trip_sorted(spark):
    df = spark.createDataFrame([("b", 2.0), (None, 3.0), ("a", None)], "location string, value double")
    path = write_csv_snapshot(df, _tmp(), run_date="20240501", sort_by=["location"])
    assert path.endswith("run_date=20240501")
    back = read_csv_snapshot(spark, path, df.schema)
    assert [r.location for r in back.collect()] == ["a", "b", None]


def test_sink_rows_have_label_columns(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 3, 5), None, dt.date(2024, 4, 1), "x", 1.0)], schemas.VINTAGE)
    out = combine.sink_rows(df)
    assert out.columns == schemas.SINK_COLUMNS
    assert out.first()[:2] == ("2024-03", "2024-04")
    assert combine.sink_rows(df, "MMM-yy").first()[:2] == ("Mar-24", "Apr-24")


# -------------------------------------------------------------------- plans
def test_edition_filters_reach_the_parquet_scan(spark):
    path = os.path.join(_tmp(), "editions")
    S.editions(spark, SF_SMALL).write.parquet(path)
    scan = scan_editions(spark.read.parquet(path), ["S1", "S2"], "Forecast")
    plan = _plan(scan)
    assert "PushedFilters" in plan and "EqualTo(is_forecast,Forecast)" in plan
    assert "In(series_id" in plan


def test_row_cap_plans_partial_group_limit_before_shuffle(spark):
    v = S.forecast_view(spark, SF_SMALL)
    capped = limits.cap_rows_per_group(v, ["report_date"], ["month", "location", "value"], 5)
    plan = capped._jdf.queryExecution().optimizedPlan().toString() + _plan(capped)
    assert "WindowGroupLimit" in plan


def test_snap_probes_feed_against_broadcast_calendar(spark):
    b = spark.createDataFrame([(dt.date(1995, 1, 1), dt.date(2001, 8, 1))], "start_date date, as_of date")
    snap = calendar.snap_report_dates(calendar.report_calendar(b), S.available_reports(spark, SF_SMALL))
    plan = _plan(snap)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_scan_reads_only_needed_columns(spark):
    v = S.forecast_view(spark, SF_SMALL)
    plan = _plan(v)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


# ---------------------------------------------------------------- streaming
def test_landing_stream_equals_batch_parse(spark):
    src, out = _tmp(), _tmp()
    payloads = [
        {"dataset_id": "a", "release_raw": "2024-01-05", "payload": json.dumps([{"data": {"2024-02-01": 1.0}}])},
        {"dataset_id": "b", "release_raw": "2024-01-06", "payload": "[]"},
    ]
    with open(os.path.join(src, "p1.json"), "w") as f:
        f.write("\n".join(json.dumps(p) for p in payloads))
    q = land(spark, src, os.path.join(out, "rows"), "release_series", checkpoint_dir=os.path.join(out, "ckpt"))
    q.awaitTermination(120)
    landed = spark.read.schema(schemas.RELEASE_SERIES).parquet(os.path.join(out, "rows"))
    assert os.path.isdir(os.path.join(out, "rows", "dataset_id=a"))  # landed by dataset
    batch = P.parse_release_series(spark.read.schema(schemas.RELEASE_SERIES_PAYLOADS).json(src))
    assert rows(landed) == rows(batch) == [("a", "2024-01-05", "2024-02-01", 1.0)]
    # a second file lands on restart; the first is not landed twice
    with open(os.path.join(src, "p2.json"), "w") as f:
        f.write(json.dumps({"dataset_id": "c", "release_raw": "2024-02-05",
                            "payload": json.dumps([{"data": {"2024-03-01": 2.0}}])}))
    q = land(spark, src, os.path.join(out, "rows"), "release_series", checkpoint_dir=os.path.join(out, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(out, "rows")).count() == 2


def test_vintage_table_is_partitioned_and_pruned(spark):
    from vintagelake.sinks import write_vintage_table
    data = [("s1", dt.date(2024, 3, 5), None, dt.date(2024, 4, 1), "x", 1.0),
            ("s2", dt.date(2024, 4, 5), None, dt.date(2024, 5, 1), "y", 2.0)]
    path = write_vintage_table(spark.createDataFrame(data, schemas.VINTAGE), os.path.join(_tmp(), "v"))
    assert [f for f in sorted(os.listdir(path)) if f.startswith("source=")] == ["source=s1", "source=s2"]
    q = spark.read.parquet(path).filter("source = 's2' AND report_month = '2024-04'")
    assert "PartitionFilters" in _plan(q) and q.count() == 1


def test_series_landed_by_dataset_is_pruned_at_run_time(spark):
    from pyspark.sql import functions as F
    from vintagelake.operators import horizon
    path = os.path.join(_tmp(), "series")
    S.release_series(spark, SF_SMALL).write.partitionBy("dataset_id").parquet(path)
    series = spark.read.schema(schemas.RELEASE_SERIES).parquet(path)
    idx = horizon.releases_since(S.release_index(spark, SF_SMALL), "1996-01-01").filter(
        F.col("dataset_id").isin("1", "2"))
    out = horizon.cut_from_release(series, horizon.latest_release_per_month(idx))
    assert "dynamicpruningexpression" in _plan(out)
    assert out.select("dataset_id").distinct().count() <= 2


@pytest.mark.parametrize("key", ["edition_provider", "release_provider", "report_provider"])
def test_provider_plans_never_shuffle_on_location_alone(spark, key):
    import re
    from vintagelake.plans.queries import queries
    plan = _plan(queries()[key](spark, SF_SMALL))
    # a handful of locations would make a handful of hot partitions
    assert not re.search(r"hashpartitioning\(location#\d+, ", plan)
    # joins against dimensions, hierarchies and location lists are broadcast
    assert "SortMergeJoin" not in plan
    # every shuffle moves pre-aggregated rows only (densify and rollups fold map-side)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[i + 1] or "SortAggregate" in lines[i + 1], (line, lines[i + 1])


def test_landed_report_rows_feed_the_provider_like_the_batch_path(spark):
    from vintagelake.plans import providers
    src, out = os.path.join(_tmp(), "payloads"), _tmp()
    S.report_payloads(spark, SF_SMALL).write.json(src)
    q = land(spark, src, os.path.join(out, "rows"), "report", checkpoint_dir=os.path.join(out, "ckpt"))
    q.awaitTermination(180)
    landed = spark.read.schema(schemas.REPORT_ROWS).parquet(os.path.join(out, "rows"))
    hierarchy = S.rollups_df(spark, S.TEST_ROLLUPS)
    streamed = providers.report_provider(landed, landed.select("report_date"), hierarchy, S.renames_df(spark),
                                         S.CALENDAR_START, S.CALENDAR_AS_OF)
    batch = providers.report_provider_from_payloads(S.report_payloads(spark, SF_SMALL), hierarchy,
                                                    S.renames_df(spark), S.CALENDAR_START, S.CALENDAR_AS_OF)
    assert streamed.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_jdbc_refresh_refuses_empty_input_before_connecting(spark):
    from vintagelake.sinks import full_refresh_jdbc
    empty = spark.createDataFrame([], "location string, value double")
    # the URL names no reachable database: reaching the writer would fail differently
    with pytest.raises(ValueError, match="refusing to refresh"):
        full_refresh_jdbc(empty, "jdbc:unreachable://nowhere/db", "t", {})
    one = spark.createDataFrame([("a", 1.0)], empty.schema)
    with pytest.raises(Exception) as err:
        full_refresh_jdbc(one, "jdbc:unreachable://nowhere/db", "t", {})
    assert not isinstance(err.value, ValueError)


def test_landing_status_table(spark):
    src, out = _tmp(), _tmp()
    body = json.dumps({"data": [{"reportDate": "2024-04-29", "month": "2024-06-01", "subRegion": "p", "value": 1.0}]})
    with open(os.path.join(src, "r.json"), "w") as f:
        f.write("\n".join(json.dumps(p) for p in [{"report_date": "2024-04-29", "payload": body},
                                                   {"report_date": "2024-05-27", "payload": "oops"}]))
    q = land(spark, src, os.path.join(out, "status"), "report", status=True,
             checkpoint_dir=os.path.join(out, "ckpt"))
    q.awaitTermination(120)
    got = {r.payload_id: (r.outcome, r.n_rows) for r in spark.read.parquet(os.path.join(out, "status")).collect()}
    assert got == {"2024-04-29": ("ok", 1), "2024-05-27": ("unparseable", 0)}


def test_cell_plans_shuffle_only_pre_aggregated_rows(spark):
    from vintagelake.plans import providers
    cells = {
        "edition": providers.edition_cells(S.editions(spark, SF_SMALL), S.series_dim(spark, SF_SMALL)),
        "release": providers.release_cells(S.release_index(spark, SF_SMALL), S.release_series(spark, SF_SMALL),
                                           S.dataset_dim(spark, SF_SMALL), S.RELEASE_START),
        "report": providers.report_cells(S.report_rows(spark, SF_SMALL), S.available_reports(spark, SF_SMALL),
                                         S.CALENDAR_START, S.CALENDAR_AS_OF),
    }
    for name, df in cells.items():
        lines = _plan(df).splitlines()
        assert any("Exchange hashpartitioning" in line for line in lines), name
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                # an aggregate, or (the chosen releases) a projection of one
                child = " ".join(lines[i + 1: i + 4])
                assert "HashAggregate" in child or "SortAggregate" in child, (name, line, child)


def test_path_helpers(spark):
    from vintagelake.session import delete_path, path_exists
    path = os.path.join(_tmp(), "t")
    assert not path_exists(spark, path)
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    assert delete_path(spark, path) and not path_exists(spark, path)


def test_jdbc_reader_needs_exactly_one_of_table_or_query(spark):
    from vintagelake.sources.tables import read_editions_jdbc
    with pytest.raises(ValueError):
        read_editions_jdbc(spark, "jdbc:unreachable://nowhere/db")
    with pytest.raises(ValueError):
        read_editions_jdbc(spark, "jdbc:unreachable://nowhere/db", table="t", query="select 1")


def test_payloads_are_parsed_once(spark):
    from vintagelake.sources import payloads as P
    series, index, pages = (S.release_series_payloads(spark, SF_SMALL), S.release_index_payloads(spark, SF_SMALL),
                            S.report_payloads(spark, SF_SMALL))
    for df in (P.parse_release_series(series), P.parse_release_series(series, "drop_row"), P.release_series_status(series),
               P.parse_release_index(index), P.release_index_status(index), P.parse_report_payloads(pages), P.report_status(pages)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_location_filter_reaches_the_cells(spark, tmp_path):
    from vintagelake.operators.reshape import densify
    cells = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "k int, location string, value double")
    cells.write.parquet(str(tmp_path / "cells"))
    dense = densify(spark.read.parquet(str(tmp_path / "cells")), ["k"], ["a", "b"]).where("location = 'a'")
    assert "EqualTo(location,a)" in _plan(dense)
    assert [tuple(r) for r in dense.collect()] == [(1, "a", 1.0)]


def test_final_sort_order_of_what_is_written(spark):
    from vintagelake.operators.combine import sink_order
    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "location string")
    assert [r[0] for r in sink_order(df, ["location"]).collect()] == ["a", "b", "c", None]


LAND = """
import sys
sys.path.insert(0, {repo!r})
from vintagelake.session import get_spark
from vintagelake.streaming.landing import land
spark = get_spark("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {shared!r}}})
land(spark, {source!r}, {target!r}, "release_series").awaitTermination()
print("LANDED", spark.read.parquet({target!r}).count())
"""


def test_landing_goes_on_in_a_new_application(spark, tmp_path):
    """Three applications, one new file each, with the default checkpoint."""
    import json
    import subprocess
    import sys

    from vintagelake.streaming.landing import land
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    code = LAND.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), shared=str(tmp_path / "shared"),
                       source=str(source), target=str(target))
    for i in range(3):
        body = json.dumps([{"data": {"2024-02-01": i}}])
        (source / f"{i}.json").write_text(json.dumps({"dataset_id": str(i), "release_raw": "2024-01-05", "payload": body}))
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        assert f"LANDED {i + 1}" in done.stdout, done.stderr[-2000:]
    (tmp_path / "elsewhere").mkdir()
    with pytest.raises(ValueError, match="another source"):
        land(spark, str(tmp_path / "elsewhere"), str(target), "release_series")
