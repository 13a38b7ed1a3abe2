"""Time every registered query; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores (8),
``BENCH_QUERIES`` a comma-separated selection. Results are computed whole and thrown away.
The headline queries, those of earlier rounds, come first and make up ``value``; after them
all others, until ``BENCH_SECONDS`` (900) have passed: what is left then is named.
"""

from __future__ import annotations

import json
import os
import sys
import time

from refinery.plans.catalog import QUERIES
from refinery.session import open_session

HEADLINE = [
    "refine", "dedup_business_key", "clean_text", "parse_dates", "dim_customer",
    "dim_product", "dim_region", "dim_date", "build_fact", "revenue_by_band",
    "orders_by_month", "quality_summary", "layer_counts", "check_orphans",
    "publish_fact", "incremental_upsert", "publish_star", "incremental_upsert_latest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [*HEADLINE, *(q for q in QUERIES if q not in HEADLINE)]
    until = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "900"))
    spark = open_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
        refinery__rawPartitions=cpus,  # the generated order lines are one row group
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["build_fact"](spark, folder))  # class loading and compilation

    seconds = {}
    for name in names:
        start = time.perf_counter()
        if start > until and not (chosen or name in HEADLINE):
            continue
        run(QUERIES[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(s for q, s in seconds.items() if chosen or q in HEADLINE), 3),
                "unit": "sec",
                "queries": seconds,
                "left_out": [name for name in names if name not in seconds],
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


if __name__ == "__main__":
    main()
