"""Write PLANS.md: physical plan trees of the provider cells, the providers and
key operators at a given scale (default sf0.1).

usage: python tools/plans_doc.py [sf_dir]
"""
import io
import sys
from contextlib import redirect_stdout

sys.path.insert(0, ".")
from vintagelake.plans import providers  # noqa: E402
from vintagelake.plans import tpch_shapes as S  # noqa: E402
from vintagelake.plans.queries import queries  # noqa: E402
from vintagelake.session import get_spark  # noqa: E402

base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = get_spark("local[4]", shuffle_partitions=8)


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0].replace("== Physical Plan ==\n", "").rstrip()


sections = [
    ("edition cells (staged)", lambda: providers.edition_cells(S.editions(spark, base), S.series_dim(spark, base))),
    ("release cells (staged)", lambda: providers.release_cells(S.release_index(spark, base),
                                                               S.release_series(spark, base),
                                                               S.dataset_dim(spark, base), S.RELEASE_START)),
    ("report cells (staged)", lambda: providers.report_cells(S.report_rows(spark, base),
                                                             S.available_reports(spark, base),
                                                             S.CALENDAR_START, S.CALENDAR_AS_OF)),
]
for key in ["edition_provider", "release_provider", "report_provider", "rollup_guard", "rows_per_source", "rows_per_report_cap",
            "report_date_snap", "series_scan", "map_explode"]:
    sections.append((f"query `{key}`", lambda key=key: queries()[key](spark, base)))

out = ["# PLANS", "",
       f"Physical plans (before AQE re-planning) at `{base}`, local mode, written by",
       "`tools/plans_doc.py`.  Provider cells are lazy plans that each provider",
       "stages once; the provider plans then start from the staged parquet.", ""]
for title, build in sections:
    out += [f"## {title}", "", "```", tree(build()), "```", ""]
open("PLANS.md", "w").write("\n".join(out))
print("wrote PLANS.md")
