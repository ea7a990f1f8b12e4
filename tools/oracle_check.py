"""Run each registered query in Spark and its oracle SQL in DuckDB; compare
row count, column names and the multiset of normalised rows."""
import datetime as dt
import math
import sys
import time

sys.path.insert(0, ".")
import duckdb

from vintagelake.plans.oracle import oracle_sql
from vintagelake.plans.queries import queries
from vintagelake.session import get_spark

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


SPARK_TO_DUCK = {"string": "VARCHAR", "date": "DATE", "double": "DOUBLE", "bigint": "BIGINT",
                 "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


EXACT = "--exact" in sys.argv


def rows_of(cols, records):
    """Rows with columns in name order; values normalised (doubles to 6 places)
    or, with --exact, compared by their exact Python repr."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    if EXACT:
        return sorted(repr(tuple(r[i] for i in order)) for r in records)
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def main():
    args = [a for a in sys.argv[1:] if a not in ("--vanilla", "--exact")]
    base = args[0] if args else "/root/testdata/sf0.01"
    only = args[1:] or None
    if "--vanilla" in sys.argv:
        # the session a caller builds without this package's settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    sql = oracle_sql()
    ok = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        if name not in sql:
            print(f"{name:28s} NO ORACLE")
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, base)
            s_cols = sdf.columns
            s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
            t1 = time.time()
            cur = con.execute(sql[name])
            d_cols = [d[0] for d in cur.description]
            d_rows = rows_of(d_cols, cur.fetchall())
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:600]}")
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in sdf.schema.fields}
        duck_types = {d[0]: str(d[1]) for d in cur.description}
        type_diff = {c: (spark_types[c], duck_types.get(c)) for c in spark_types
                     if c in duck_types and spark_types[c] != duck_types[c]}
        if type_diff:
            print(f"   types differ: {type_diff}")
        same = same_cols and s_rows == d_rows
        ok += same
        msg = "OK " if same else "DIFF"
        print(f"{name:28s} {msg} spark={len(s_rows)} duck={len(d_rows)} cols={'=' if same_cols else (sorted(s_cols), sorted(d_cols))} {t1-t0:.1f}s")
        if not same and same_cols:
            a, b = set(s_rows), set(d_rows)
            print("   only spark:", sorted(a - b)[:3])
            print("   only duck :", sorted(b - a)[:3])
    print("matched", ok)


if __name__ == "__main__":
    main()
