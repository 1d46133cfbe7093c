"""Times the headline queries on one machine and prints one line of JSON.

Each query runs once to warm up and then `BENCH_RUNS` times; the best time counts.  Results are
computed in full and thrown away (`noop` sink), so that no time goes into carrying rows to Python.
"""

from __future__ import annotations

import json
import os
import time

from catalogue import QUERIES
from tidemark.session import local_session

HEADLINES = (
    "revenue_by_month_pivot", "mrr_current", "mrr_history", "fct_subscriptions", "seats_by_month", "high_water_mark",
    "adoption_flags", "general_report", "customer_status", "dedup_events", "top_lines_per_order", "forward_fill_events",
    "rank_both_ways", "date_dimension", "fiscal_periods", "check_equality", "check_mutually_exclusive_ranges",
    "check_sequential_values", "pivot_cols_events", "unpivot_part", "heavy_key_join", "surrogate_key_lineitem",
)


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8, app="bench")
    seconds = {}
    for name in HEADLINES:
        timed(spark, name, folder)
        seconds[name] = round(min(timed(spark, name, folder) for _ in range(runs)), 4)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 4), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
