"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and executed in full through Spark's ``noop`` sink (all
rows computed, nothing collected to the driver).  Prints one JSON line.
Optional: BENCH_QUERIES=comma,separated,keys to run a subset.

After the engine's queries, whose total is the metric, the corpus queries run one
by one; none is begun after BENCH_CORPUS_SECONDS (240) of them.  Their seconds stand
apart, under ``corpus``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vintagelake.plans.queries import queries  # noqa: E402
from vintagelake.session import get_spark  # noqa: E402

HEADLINE = "combined_vintage"


def seconds(build, spark, base: str) -> float:
    """Of one query, planned and executed in full."""
    t0 = time.perf_counter()
    build(spark, base).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def corpus_queries() -> dict:
    try:
        from vintagelake.llm.queries import queries as corpus
    except ImportError:
        return {}
    return corpus()


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(f"local[{cpus}]", app="vintagelake-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "8g"})
    registry, corpus = queries(), corpus_queries()
    names = [q for q in wanted if q not in corpus] if wanted else list(registry)
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    # warm-up: JVM start, class loading and the first parquet footer reads
    registry["month_labels"](spark, base).write.format("noop").mode("overwrite").save()
    for name in names:
        try:
            timings[name] = seconds(registry[name], spark, base)
        except Exception as exc:  # noqa: BLE001 - one failing query must not hide the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    apart: dict[str, float] = {}
    limit = float(os.environ.get("BENCH_CORPUS_SECONDS", "240"))
    for name in [q for q in wanted if q in corpus] if wanted else list(corpus):
        if sum(apart.values()) >= limit:
            break
        try:
            apart[name] = seconds(corpus[name], spark, base)
        except Exception as exc:  # noqa: BLE001
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", base)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "corpus": apart,
        "headline": {HEADLINE: timings.get(HEADLINE)},
        "sf": float(m.group(1)) if m else base,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
