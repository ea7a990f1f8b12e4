"""Run every registered query once and print rows, columns and seconds."""
import sys, time
sys.path.insert(0, ".")
from vintagelake.session import get_spark
from vintagelake.plans.queries import queries

base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
only = sys.argv[2:] or None
spark = get_spark("local[8]", shuffle_partitions=8)
for name, fn in queries().items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, base)
        n = df.count()
        print(f"{name:28s} rows={n:8d} {time.time()-t:6.2f}s cols={[(f.name, f.dataType.simpleString()) for f in df.schema.fields][:8]}")
    except Exception as e:
        print(f"{name:28s} FAILED {type(e).__name__}: {str(e)[:400]}")
