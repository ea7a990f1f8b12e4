"""The whole job over landings derived from the test tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vintagelake.job import JobConfig, run
from vintagelake.operators.combine import sink_rows
from vintagelake.plans import providers
from vintagelake.session import shared_path
from vintagelake.sinks import full_refresh_table
from vintagelake.plans import tpch_shapes as S
from vintagelake.plans.queries import queries


def staged(spark):
    folder = shared_path(spark, "stage").removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_job_equals_flagship_query(spark):
    root = tempfile.mkdtemp(prefix="vintagelake-job-")
    landing, dims_folder = os.path.join(root, "landing"), os.path.join(root, "dims")
    S.release_index_payloads(spark, SF_SMALL).write.parquet(os.path.join(landing, "release_index"))
    S.release_series_payloads(spark, SF_SMALL).write.parquet(os.path.join(landing, "release_series"))
    pages = S.report_payloads(spark, SF_SMALL)
    pages.withColumn("payload", F.regexp_replace("payload", '"item":"[a-z]+"', '"item":null')).write.parquet(os.path.join(landing, "report"))
    S.editions(spark, SF_SMALL).write.parquet(os.path.join(landing, "editions"))
    S.dataset_dim(spark, SF_SMALL).write.parquet(os.path.join(dims_folder, "dataset_dim"))
    S.series_dim(spark, SF_SMALL).write.parquet(os.path.join(dims_folder, "series_dim"))
    S.rollups_df(spark, S.TEST_ROLLUPS).write.parquet(os.path.join(dims_folder, "hierarchy"))
    S.renames_df(spark).write.parquet(os.path.join(dims_folder, "renames"))
    cfg = JobConfig(landing=landing, target=os.path.join(root, "target"), csv_folder=os.path.join(root, "csv"),
                    as_of=S.CALENDAR_AS_OF, run_date="20010801", release_start=S.RELEASE_START,
                    report_start=S.CALENDAR_START, dims_folder=dims_folder,
                    status_folder=os.path.join(root, "status"))
    before = staged(spark)
    summary = {r.source: r.n_rows for r in run(spark, cfg).collect()}
    assert staged(spark) == before  # the run removed the cells it staged
    assert spark.read.parquet(os.path.join(cfg.status_folder, "report")).count() > 0
    assert spark.read.parquet(os.path.join(cfg.status_folder, "report_ranges")).first().n_rows > 0
    got = spark.read.parquet(cfg.target)
    # pages name no item here, so the report provider sees every record
    report = providers.report_provider_from_payloads(
        S.report_payloads(spark, SF_SMALL), S.rollups_df(spark, S.TEST_ROLLUPS), S.renames_df(spark),
        S.CALENDAR_START, S.CALENDAR_AS_OF)
    expected = sink_rows(providers.combined_vintage(
        queries()["release_provider"](spark, SF_SMALL), report, queries()["edition_provider"](spark, SF_SMALL)))
    rounded = [c if c != "value" else "round(value, 6) as value" for c in got.columns]
    got_r, exp_r = got.selectExpr(*rounded), expected.selectExpr(*rounded)
    assert got_r.exceptAll(exp_r).count() == 0 and exp_r.exceptAll(got_r).count() == 0
    assert summary[None] == got.count() and len(summary) == 4
    snap = spark.read.option("header", True).csv(os.path.join(root, "csv", "run_date=20010801"))
    assert "NATION_0" in snap.columns and snap.count() > 0


def test_failed_run_leaves_no_stage_and_keeps_the_target(spark, tmp_path):
    good = spark.createDataFrame([("a", 1)], "source string, n int")
    full_refresh_table(good, str(tmp_path / "t"))
    bad = good.select("source", F.raise_error(F.lit("no")).cast("int").alias("n"))
    with pytest.raises(Exception, match="no"):
        full_refresh_table(bad, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        full_refresh_table(good.limit(0), str(tmp_path / "t"))
    # a table may be refreshed from itself
    full_refresh_table(spark.read.parquet(str(tmp_path / "t")).withColumn("n", F.col("n") + 1), str(tmp_path / "t"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [("a", 2)]
    assert os.listdir(tmp_path) == ["t"]

    before = staged(spark)
    (tmp_path / "landing").mkdir()
    editions = S.editions(spark, SF_SMALL).where("series_id = 'S1'")
    editions.write.parquet(str(tmp_path / "landing" / "editions"))
    with pytest.raises(ValueError, match="never occur"):  # after its cells were staged
        run(spark, JobConfig(landing=str(tmp_path / "landing"), as_of="2001-08-01", target=str(tmp_path / "out")))
    assert staged(spark) == before


def test_landed_rows_and_editions_by_jdbc_options_are_inputs(spark, tmp_path, monkeypatch):
    from vintagelake import job

    landing = tmp_path / "landing"
    S.release_index(spark, SF_SMALL).write.parquet(str(landing / "release_index_rows"))
    S.release_series(spark, SF_SMALL).write.parquet(str(landing / "release_series_rows"))
    S.dataset_dim(spark, SF_SMALL).write.parquet(str(tmp_path / "dims" / "dataset_dim"))
    S.series_dim(spark, SF_SMALL).write.parquet(str(tmp_path / "dims" / "series_dim"))
    asked = {}

    def read(spark, url, table=None, properties=None, query=None):
        asked.update(url=url, table=table, properties=properties)
        return S.editions(spark, SF_SMALL)

    monkeypatch.setattr(job, "read_editions_jdbc", read)
    cfg = JobConfig(landing=str(landing), dims_folder=str(tmp_path / "dims"), release_start=S.RELEASE_START,
                    as_of=S.CALENDAR_AS_OF, editions_jdbc={"url": "jdbc:x", "dbtable": "e", "user": "u"})
    parts, _ = job.build(spark, cfg)
    assert asked == {"url": "jdbc:x", "table": "e", "properties": {"user": "u"}}
    for name, query in (("release", "release_provider"), ("edition", "edition_provider")):
        assert parts[name].exceptAll(queries()[query](spark, SF_SMALL)).count() == 0
