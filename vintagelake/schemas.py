"""Fixed schemas.  Nothing is inferred: every scan is given one of these."""

from pyspark.sql import types as T

# Landed payload tables: one row per payload, the payload kept as JSON text.
RELEASE_INDEX_PAYLOADS = "dataset_id string, payload string"
RELEASE_SERIES_PAYLOADS = "dataset_id string, release_raw string, payload string"
REPORT_PAYLOADS = "report_date string, payload string"
# Columns that a landing may also have: the page of a report, and when the payload was landed.
LANDED = {"release_index": "landed_at timestamp", "release_series": "landed_at timestamp",
          "report": "page string, landed_at timestamp"}
# What tells one payload from another; a later one with the same key replaces it.
PAYLOAD_KEYS = {"release_index": ["dataset_id"], "release_series": ["dataset_id", "release_raw"],
                "report": ["report_date", "page"]}

# JSON payload bodies.
RELEASE_INDEX_BODY = "array<struct<metadata:struct<release_dates:array<string>>>>"
# values are read as text and cast one by one: one that is no number costs itself only
RELEASE_SERIES_BODY = "array<struct<data:map<string,string>>>"
REPORT_BODY = ("struct<data:array<struct<reportDate:string,month:string,"
               "subRegion:string,value:string,item:string>>>")

# Long tables after the payloads are parsed.
RELEASE_INDEX = T.StructType([
    T.StructField("dataset_id", T.StringType(), False),
    T.StructField("release_raw", T.StringType(), False),
])
RELEASE_SERIES = T.StructType([
    T.StructField("dataset_id", T.StringType(), False),
    T.StructField("release_raw", T.StringType(), False),
    T.StructField("target_raw", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
])
REPORT_ROWS = T.StructType([
    T.StructField("report_date", T.DateType(), False),
    T.StructField("reportDate", T.DateType(), True),
    T.StructField("month", T.DateType(), True),
    T.StructField("subRegion", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])
# The same as landed, with columns that older landings may lack.
LANDED_RELEASE_SERIES = T.StructType([*RELEASE_SERIES.fields, T.StructField("landed_at", T.TimestampType(), True)])
LANDED_REPORT_ROWS = T.StructType([*REPORT_ROWS.fields, T.StructField("item", T.StringType(), True)])
EDITIONS = T.StructType([
    T.StructField("series_id", T.StringType(), True),
    T.StructField("Date", T.DateType(), True),
    T.StructField("data", T.DoubleType(), True),
    T.StructField("Edition", T.DateType(), True),
    T.StructField("is_forecast", T.StringType(), True),
])

# Dimensions.
DATASET_DIM = "dataset_id string, location string, ord int"
SERIES_DIM = "series_id string, location string"
HIERARCHY = "target string, component string, null_policy string, rule int"
RENAME_DIM = "from_location string, to_location string"

# Canonical long table.
VINTAGE = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("report_date", T.DateType(), False),
    T.StructField("issue_date", T.DateType(), True),
    T.StructField("month", T.DateType(), False),
    T.StructField("location", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
])
VINTAGE_COLUMNS = [f.name for f in VINTAGE.fields]

# What the SQL sink receives: labels instead of dates.
SINK_COLUMNS = ["reportDate", "month", "location", "value", "source"]
