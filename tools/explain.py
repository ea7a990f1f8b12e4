"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py [sf_dir] key [key ...]
"""
import sys

sys.path.insert(0, ".")
from vintagelake.plans.queries import queries  # noqa: E402
from vintagelake.session import get_spark  # noqa: E402

args = sys.argv[1:]
base = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
spark = get_spark("local[4]", shuffle_partitions=8)
for name in args:
    print(f"===== {name}")
    queries()[name](spark, base).explain("formatted")
