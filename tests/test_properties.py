"""Randomized equivalences: each Spark operator against a plain-Python model."""

import calendar as pycal
import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from vintagelake.operators import calendar, horizon, reshape, rollup
from vintagelake.sources import dims

SEEDS = [1, 2, 3]


def _cells(seed, n_keys=12, locs=("a", "b", "c", "d", "e")):
    rnd = random.Random(seed)
    out = []
    for k in range(n_keys):
        for loc in locs:
            if rnd.random() < 0.6:
                out.append((k, loc, None if rnd.random() < 0.2 else float(rnd.randint(1, 50))))
    return out


@pytest.mark.parametrize("seed", SEEDS)
def test_densify_equals_pivot_then_unpivot(spark, seed):
    df = spark.createDataFrame(_cells(seed), "k int, location string, value double")
    locs = reshape.observed_values(df)
    dense = reshape.densify(df, ["k"], locs)
    melted = reshape.melt(reshape.pivot_wide(df, ["k"], locs), ["k"])
    assert dense.exceptAll(melted).count() == 0 and melted.exceptAll(dense).count() == 0


@pytest.mark.parametrize("seed", SEEDS)
def test_long_rollup_equals_wide_formula(spark, seed):
    data = _cells(seed)
    df = spark.createDataFrame(data, "k int, location string, value double")
    locs = reshape.observed_values(df)
    dense = reshape.densify(df, ["k"], locs)
    spec = [("S", "skip", ["a", "b", "c"]), ("P", "propagate", ["d", "e"]), ("G", "skip", ["a", "zz"])]
    got = rows(rollup.rollup_values(dense, dims.hierarchy(spark, spec), ["k"]))
    # wide formula in pandas: pivot, row sum skipping NaN / plain + ; guard on columns
    pdf = pd.DataFrame(data, columns=["k", "location", "value"])
    wide = pdf.pivot(index="k", columns="location", values="value")
    expected = []
    for target, policy, comps in spec:
        if not all(c in wide.columns for c in comps):
            continue
        if policy == "skip":
            col = wide[comps].sum(axis=1)
        else:
            col = wide[comps[0]]
            for c in comps[1:]:
                col = col + wide[c]
        expected += [(int(k), target, None if pd.isna(v) else float(v)) for k, v in col.items()]
    assert got == sorted(expected, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("seed", SEEDS)
def test_latest_release_aggregate_equals_row_number(spark, seed):
    rnd = random.Random(seed)
    stamps = []
    for _ in range(60):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 90))
        s = day.isoformat() if rnd.random() < 0.4 else f"{day.isoformat()}T{rnd.randint(0, 23):02d}:00:00"
        stamps.append((rnd.choice("xyz"), s))
    idx = spark.createDataFrame(stamps, "dataset_id string, release_raw string")
    agg = horizon.latest_release_per_month(idx).select("dataset_id", "release_month", "release_raw")
    w = Window.partitionBy("dataset_id", "m").orderBy(F.col("release_raw").desc())
    by_rank = (idx.withColumn("m", F.trunc(F.to_date(F.split_part("release_raw", F.lit("T"), F.lit(1))), "MM"))
               .withColumn("rn", F.row_number().over(w)).filter("rn = 1")
               .select("dataset_id", F.col("m").alias("release_month"), "release_raw"))
    assert rows(agg) == rows(by_rank)


def _py_calendar(start, as_of):
    out = []
    y, m = start.year, start.month
    while (y, m) <= (as_of.year, as_of.month):
        if (y, m) < (as_of.year, as_of.month):
            last = dt.date(y, m, pycal.monthrange(y, m)[1])
            out.append(last - dt.timedelta(days=last.weekday()))
        else:
            out.append(as_of - dt.timedelta(days=as_of.weekday()))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return sorted(set(out))


@pytest.mark.parametrize("seed", SEEDS)
def test_calendar_and_snap_equal_python_loop(spark, seed):
    rnd = random.Random(seed)
    start = dt.date(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))
    as_of = start + dt.timedelta(days=rnd.randint(30, 900))
    b = spark.createDataFrame([(start, as_of)], "start_date date, as_of date")
    cands = calendar.report_calendar(b)
    expected = _py_calendar(start, as_of)
    assert [r[0] for r in rows(cands)] == expected
    avail = sorted({c - dt.timedelta(days=rnd.choice([0, 7, 14])) for c in expected if rnd.random() < 0.8})
    av = spark.createDataFrame([(a,) for a in avail], "report_date date")
    snapped = [r[0] for r in rows(calendar.snapped_dates(cands, av))]
    loop = set()
    for c in expected:
        if c in avail:
            loop.add(c)
        elif c - dt.timedelta(days=7) in avail:
            loop.add(c - dt.timedelta(days=7))
    assert snapped == sorted(loop)


@pytest.mark.parametrize("seed", SEEDS)
def test_sum_and_mean_follow_pandas_null_rules(spark, seed):
    from vintagelake.operators import aggregate
    rnd = random.Random(seed)
    data = []
    for _ in range(200):
        k = rnd.choice(["a", "b", "c", None])
        v = rnd.choice([None, float("nan"), float(rnd.randint(1, 9))])
        data.append((k, rnd.choice(["p", "q"]), v))
    pdf = pd.DataFrame(data, columns=["k", "loc", "value"])
    df = spark.createDataFrame(data, "k string, loc string, value double")
    df = df.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    # groupby().sum(): NULL keys dropped, missing skipped, an all-missing group sums to 0
    want_sum = {(k, l): float(v) for (k, l), v in pdf.groupby(["k", "loc"])["value"].sum().items()}
    got_sum = {(r.k, r.loc): r.value for r in aggregate.series_sum(df, ["k", "loc"]).collect()}
    assert got_sum == want_sum
    # pivot_table mean: cells with no value vanish
    wide = pdf.pivot_table(index="k", columns="loc", values="value", aggfunc="mean")
    want_mean = {(k, l): round(float(v), 9) for (k, l), v in wide.stack().items()}
    got_mean = {(r.k, r.loc): round(r.value, 9) for r in aggregate.cell_mean(df, ["k", "loc"]).collect()}
    assert got_mean == want_mean


def test_one_year_bound_equals_pandas_date_offset(spark):
    from vintagelake.functions import add_one_year
    rnd = random.Random(11)
    days = [dt.date(2020, 2, 29), dt.date(2024, 2, 29), dt.date(2023, 12, 31)]
    days += [dt.date(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 2500)) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in days], "d date")
    got = {r.d: r.e for r in df.select("d", add_one_year("d").alias("e")).collect()}
    want = {x: (pd.Timestamp(x) + pd.DateOffset(years=1)).date() for x in days}
    assert got == want


def test_labels_equal_python_strftime(spark):
    from vintagelake.functions import label, month_label
    rnd = random.Random(5)
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 12000)) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in days], "d date")
    got = {r.d: (r.a, r.b) for r in df.select("d", label("d").alias("a"), month_label("d").alias("b")).collect()}
    assert got == {x: (x.strftime("%Y-%m"), x.strftime("%b-%y")) for x in days}


@pytest.mark.parametrize("variant", ["fixed", "as_deployed"])
@pytest.mark.parametrize("seed", SEEDS)
def test_production_rollups_equal_sequential_wide_assignment(spark, seed, variant):
    spec = dims.REPORT_ROLLUPS if variant == "fixed" else dims.REPORT_ROLLUPS_AS_DEPLOYED
    comps = sorted({c for _, _, cs in spec for c in cs})
    rnd = random.Random(seed)
    present = [c for c in comps if rnd.random() < 0.85]
    data = [(k, c, None if rnd.random() < 0.15 else float(rnd.randint(1, 9))) for k in range(6) for c in present]
    df = spark.createDataFrame(data, "k int, location string, value double")
    dense = reshape.densify(df, ["k"], present)
    got = rows(rollup.rollup_values(dense, dims.hierarchy(spark, spec), ["k"]))
    # wide model: columns assigned one rollup after another, later ones overwrite
    wide = pd.DataFrame(data, columns=["k", "location", "value"]).pivot(index="k", columns="location",
                                                                          values="value")
    base_cols = set(wide.columns)
    out = {}
    for target, policy, cs in spec:
        if not all(c in base_cols for c in cs):
            continue
        if policy == "skip":
            col = wide[cs].sum(axis=1)
        else:
            col = wide[cs[0]]
            for c in cs[1:]:
                col = col + wide[c]
        out[target] = col
    expected = [(int(k), t, None if pd.isna(v) else float(v)) for t, col in out.items() for k, v in col.items()]
    assert got == sorted(expected, key=lambda t: tuple((x is None, str(x)) for x in t))
