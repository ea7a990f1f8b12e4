"""Forecast-shaped inputs derived from the TPC-H-like test tables.

Every frame here is a Spark plan over the given parquet tables, so its work
grows with them.  Mapping used throughout:

* report / release / edition date = order date; target month = first day of
  the ship month; location = the customer's nation name; value = quantity.
* release provider: one dataset per nation; a release is an order day of that
  nation (urgent orders stamp a bare date, others a date with a time, so the
  text order of stamps matters); a release's points are its line items summed
  per target month.
* report provider: every order is a page of its day's report; the probe for
  reports sees the feed of urgent, finished orders, so that some candidate
  days have no report; a record's item is "main" or "other".
* edition provider: one series per nation ("S" + nation key); open line items
  are forecasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake import schemas
from vintagelake.session import local_frame
from vintagelake.sources.tables import read_table

# Test parameters of the shapes (shared with the DuckDB oracles).
NULL_LOCATIONS = ["NATION_3", "NATION_4"]
NULL_BELOW = 5.0
RELEASE_START = "1996-01-01"
CALENDAR_START = "1995-01-01"
CALENDAR_AS_OF = "2001-08-01"
FEED_PRIORITY = "1-URGENT"
FEED_STATUS = "F"
OTHER_BELOW = 10.0
DEBUG_DATASETS = 3
ROWS_PER_REPORT = 5
LINES_PER_TASK = 400_000  # line items grouped by order in one task
TEST_RENAMES = [("NATION_0", "NATION_ZERO")]
# (target, null policy, components): overlapping pairs, one propagate target,
# one target whose component never has a value (guarded out), one target that
# overwrites an existing location, and one target written by two rules.
TEST_ROLLUPS = [
    ("GROUP_0_5", "skip", ["NATION_0", "NATION_5"]),
    ("GROUP_5_10", "skip", ["NATION_5", "NATION_10"]),
    ("GROUP_1_2", "propagate", ["NATION_1", "NATION_2"]),
    ("GROUP_3_6", "skip", ["NATION_3", "NATION_6"]),
    ("NATION_24", "skip", ["NATION_20", "NATION_21"]),
    ("GROUP_7", "skip", ["NATION_7", "NATION_8"]),
    ("GROUP_7", "skip", ["NATION_7", "NATION_9", "NATION_11"]),
]
SKIP_ROLLUPS = [r for r in TEST_ROLLUPS[:2]]
PROPAGATE_ROLLUPS = [r for r in TEST_ROLLUPS if r[1] == "propagate"]


def _day(c) -> F.Column:
    return F.col(c).cast("date")


def _month(c) -> F.Column:
    return F.trunc(F.col(c).cast("date"), "MM")


def nations(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "nation", ["n_nationkey", "n_name", "n_regionkey"])


def order_lines(spark: SparkSession, base: str, order_cols=(), line_cols=()) -> DataFrame:
    """lineitem x orders x customer x nation with the columns asked for."""
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_quantity", "l_shipdate", *line_cols])
    o = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderdate", *order_cols])
    c = read_table(spark, base, "customer", ["c_custkey", "c_nationkey"])
    n = nations(spark, base).select("n_nationkey", "n_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    return j.join(n, j.c_nationkey == n.n_nationkey)


def lines_by_order(spark: SparkSession, base: str, order_cols=(), line_cols=()) -> DataFrame:
    """``order_lines`` for what is grouped by order: an order's rows are in one task, so
    that no grouping shuffles again, and a task has about ``LINES_PER_TASK`` line items
    however many there are: what it holds in memory does not grow with the tables."""
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_quantity", "l_shipdate", *line_cols])
    tasks = max(spark.sparkContext.defaultParallelism, -(-li.count() // LINES_PER_TASK))
    # the orders with their nations first: the line items then move once, by order
    o = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderdate", *order_cols])
    c = read_table(spark, base, "customer", ["c_custkey", "c_nationkey"])
    n = nations(spark, base).select("n_nationkey", "n_name")
    of = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return li.repartition(tasks, "l_orderkey").join(
        of.repartition(tasks, "o_orderkey").hint("merge"), li.l_orderkey == of.o_orderkey)


def inject_nulls(value: F.Column, location: F.Column) -> F.Column:
    return F.when(location.isin(NULL_LOCATIONS) | (value < NULL_BELOW), F.lit(None).cast("double")) \
        .otherwise(value)


def forecast_view(spark: SparkSession, base: str, with_nulls: bool = False) -> DataFrame:
    """V: report_date, month, location, value (one row per line item)."""
    j = order_lines(spark, base)
    value = F.col("l_quantity")
    if with_nulls:
        value = inject_nulls(value, F.col("n_name"))
    return j.select(_day("o_orderdate").alias("report_date"), _month("l_shipdate").alias("month"),
                    F.col("n_name").alias("location"), value.alias("value"))


def monthly_view(spark: SparkSession, base: str, with_nulls: bool = False) -> DataFrame:
    """M: V with month >= report_date, keyed on the report month."""
    v = forecast_view(spark, base, with_nulls)
    v = v.filter(F.col("month") >= F.col("report_date"))
    return v.select(F.trunc("report_date", "MM").alias("report_month"), "month", "location", "value")


# ---------------------------------------------------------------- editions --
def editions(spark: SparkSession, base: str) -> DataFrame:
    """Edition table: series_id, Date, data, Edition, is_forecast (values with NULLs)."""
    j = order_lines(spark, base, line_cols=("l_linestatus",))
    return j.select(
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("series_id"),
        _month("l_shipdate").alias("Date"),
        inject_nulls(F.col("l_quantity"), F.col("n_name")).alias("data"),
        _day("o_orderdate").alias("Edition"),
        F.when(F.col("l_linestatus") == "O", F.lit("Forecast")).otherwise(F.lit("History")).alias("is_forecast"),
    )


def series_dim(spark: SparkSession, base: str) -> DataFrame:
    n = nations(spark, base)
    return n.select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("series_id"),
                    F.col("n_name").alias("location"))


# ---------------------------------------------------------------- releases --
def release_stamp(orderdate: str = "o_orderdate", priority: str = "o_orderpriority") -> F.Column:
    d = F.col(orderdate)
    return F.when(F.col(priority) == FEED_PRIORITY, F.date_format(d, "yyyy-MM-dd")) \
        .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))


def release_index(spark: SparkSession, base: str) -> DataFrame:
    """dataset_id, release_raw (distinct)."""
    o = read_table(spark, base, "orders", ["o_custkey", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, base, "customer", ["c_custkey", "c_nationkey"])
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(F.col("c_nationkey").cast("string").alias("dataset_id"),
                    release_stamp().alias("release_raw")).distinct()


def release_series(spark: SparkSession, base: str) -> DataFrame:
    """dataset_id, release_raw, target_raw, value: one point per target month."""
    j = order_lines(spark, base, order_cols=("o_orderpriority",))
    value = F.when(F.col("l_quantity") < NULL_BELOW, F.lit(None).cast("double")).otherwise(F.col("l_quantity"))
    return (j.groupBy(F.col("c_nationkey").cast("string").alias("dataset_id"),
                      release_stamp().alias("release_raw"),
                      F.date_format(_month("l_shipdate"), "yyyy-MM-dd").alias("target_raw"))
            .agg(F.sum(value).alias("value")))


def dataset_dim(spark: SparkSession, base: str) -> DataFrame:
    n = nations(spark, base)
    return n.select(F.col("n_nationkey").cast("string").alias("dataset_id"),
                    F.col("n_name").alias("location"), F.col("n_nationkey").cast("int").alias("ord"))


def release_index_payloads(spark: SparkSession, base: str) -> DataFrame:
    """One JSON payload per dataset listing its release stamps (distinct days, so
    a payload is bounded by the calendar, not by the data volume)."""
    idx = release_index(spark, base)
    body = F.to_json(F.array(F.struct(F.struct(F.sort_array(F.collect_set("release_raw"))
                                               .alias("release_dates")).alias("metadata"))))
    return idx.groupBy("dataset_id").agg(body.alias("payload"))


def release_series_payloads(spark: SparkSession, base: str) -> DataFrame:
    """One JSON payload per (dataset, release): {target day: value} (at most one
    entry per target month)."""
    pts = release_series(spark, base)
    data = F.map_from_entries(F.collect_list(F.struct("target_raw", "value")))
    return pts.groupBy("dataset_id", "release_raw").agg(
        F.to_json(F.array(F.struct(data.alias("data")))).alias("payload"))


# ----------------------------------------------------------------- reports --
def report_feed_orders(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    return o.filter((F.col("o_orderpriority") == FEED_PRIORITY) & (F.col("o_orderstatus") == FEED_STATUS))


def available_reports(spark: SparkSession, base: str) -> DataFrame:
    """report_date of every feed order (one row per order, not distinct)."""
    return report_feed_orders(spark, base).select(_day("o_orderdate").alias("report_date"))


def report_rows(spark: SparkSession, base: str) -> DataFrame:
    """report_date, reportDate, month, subRegion, value (with NULLs)."""
    j = order_lines(spark, base)
    return j.select(_day("o_orderdate").alias("report_date"), _day("o_orderdate").alias("reportDate"),
                    _month("l_shipdate").alias("month"), F.col("n_name").alias("subRegion"),
                    inject_nulls(F.col("l_quantity"), F.col("n_name")).alias("value"))


def item_of(orderdate: str, quantity: str) -> F.Column:
    """Some days have records of the other item only."""
    other = (F.dayofmonth(orderdate) % 3 == 0) | (F.col(quantity) < OTHER_BELOW)
    return F.when(other, F.lit("other")).otherwise(F.lit("main"))


def report_payloads(spark: SparkSession, base: str) -> DataFrame:
    """One JSON payload per order (a page of its report day)."""
    return report_payloads_by_order(spark, base).select("report_date", "payload")


def report_payloads_by_order(spark: SparkSession, base: str) -> DataFrame:
    """report_date (the order key, naming the page), payload."""
    j = lines_by_order(spark, base)
    rec = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("reportDate"),
                   F.date_format(_month("l_shipdate"), "yyyy-MM-dd").alias("month"),
                   F.col("n_name").alias("subRegion"),
                   inject_nulls(F.col("l_quantity"), F.col("n_name")).alias("value"),
                   item_of("o_orderdate", "l_quantity").alias("item"))
    return (j.groupBy("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("report_date"))
            .agg(F.to_json(F.struct(F.collect_list(rec).alias("data"))).alias("payload")))


def defect_payloads(spark: SparkSession, base: str) -> DataFrame:
    """Series payloads, one per order, with a defect chosen by order priority:
    1 -> [], 2 -> [{}], 3 -> not JSON, 4 -> one key that is not a date; 5 is
    intact for orders with key % 4 = 0, else the values are quoted (1), a point
    with a one-digit date and no number is added (2), or two texts of one day (3)."""
    j = lines_by_order(spark, base, order_cols=("o_orderpriority",))
    pts = (j.groupBy("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
                     F.date_format(_month("l_shipdate"), "yyyy-MM-dd").alias("target_raw"))
           .agg(F.sum("l_quantity").alias("value")))
    good = F.to_json(F.array(F.struct(F.map_from_entries(F.collect_list(F.struct("target_raw", "value")))
                                      .alias("data"))))
    per = pts.groupBy("o_orderkey", "o_orderpriority", "day").agg(good.alias("good"))
    pr, kind = F.col("o_orderpriority"), F.col("o_orderkey") % 4

    def added(points: str) -> F.Column:
        return F.regexp_replace("good", r'^\[\{"data":\{', '[{"data":{' + points + ",")

    payload = (F.when(pr == "1-URGENT", F.lit("[]"))
               .when(pr == "2-HIGH", F.lit("[{}]"))
               .when(pr == "3-MEDIUM", F.lit("not json"))
               .when(pr == "4-NOT SPECIFIED", added('"2024-13-01":1.0'))
               .when(kind == 1, F.regexp_replace("good", r":(\d+\.\d+)", ':"$1"'))
               .when(kind == 2, added('"2030-2-1":"n/a"'))
               .when(kind == 3, added('"2030-02-01":1.0,"2030-02-01T00:00:00":2.0'))
               .otherwise(F.col("good")))
    return per.select(F.col("o_orderkey").cast("string").alias("dataset_id"),
                      F.col("day").alias("release_raw"), payload.alias("payload"))


def rollups_df(spark: SparkSession, rollups) -> DataFrame:
    rows = [(t, c, p, i) for i, (t, p, comps) in enumerate(rollups) for c in comps]
    return local_frame(spark, rows, schemas.HIERARCHY)


def renames_df(spark: SparkSession) -> DataFrame:
    return local_frame(spark, TEST_RENAMES, schemas.RENAME_DIM)
