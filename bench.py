"""Time the headline queries, each after one run to warm up, and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tideline.registry import QUERIES
from tideline.session import local_session

HEADLINE = (
    "customer_geography",
    "dim_customer",
    "order_revenue",
    "fact_orders",
    "latest_order",
    "agg_customer_revenue",
    "cdc_sample",
    "cdc_staged",
    "merge_fact_orders",
    "agg_refresh_full",
    "agg_refresh_incremental",
    "row_counts",
    "change_cycle",
    "order_windows_skewed",
    "fare_ranks",
    "fare_ranks_chunked",
    "fare_cumsum",
    "global_percentile",
    "global_percentile_chunked",
    "survival_stats",
    "cohort_analysis",
    "family_patterns",
    "pivot_survival",
    "pivot_fare",
    "cross_pairs",
    "comparable_pairs",
    "correlation_matrix",
    "survival_score",
    "survival_score_udf",
    "passenger_transformed",
    "passenger_marts",
)


def run(spark, name: str, folder: str) -> float:
    """Seconds to compute a query in full; the rows are discarded on the executors."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cores)
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(run(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
