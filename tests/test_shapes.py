"""Inputs made from the test tables: rows and how many of them a task holds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vintagelake.plans import tpch_shapes as S


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Keys that repeat, are null or match nothing."""
    base = tmp_path_factory.mktemp("odd")
    at = dt.datetime(2024, 1, 5)
    for name, schema, rows in (
            ("lineitem", "l_orderkey long, l_quantity double, l_shipdate timestamp",
             [(1, 2.0, at), (1, 2.0, at), (2, 3.0, None), (None, 4.0, at), (3, None, at), (9, 1.0, at)]),
            ("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
             [(1, 1, at, "5-LOW"), (1, 1, at, "5-LOW"), (2, 2, None, None), (3, None, at, "2-HIGH"), (None, 1, at, "5-LOW")]),
            ("customer", "c_custkey long, c_nationkey long", [(1, 1), (1, 2), (2, 1), (None, 1)]),
            ("nation", "n_nationkey long, n_name string, n_regionkey long", [(1, "A", 0), (2, None, 0), (2, "B", 0)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}.parquet")
    return str(base)


def test_lines_by_order_are_the_lines(spark, odd_tables):
    for base in (SF_SMALL, odd_tables):
        a, b = (f(spark, base, order_cols=("o_orderpriority",)) for f in (S.order_lines, S.lines_by_order))
        b = b.select(*a.columns)
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


@pytest.mark.parametrize("made", [S.defect_payloads, S.report_payloads_by_order])
def test_a_task_groups_a_bounded_number_of_lines(spark, monkeypatch, made):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(S, "LINES_PER_TASK", lines // 20)
    payloads = made(spark, SF_SMALL)
    # rows of an order are shuffled once, by order, and never grouped before that
    per_task = [r["count"] for r in payloads.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 15 and max(per_task) < sum(per_task) / 5
