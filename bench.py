"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tendril.plans import load_all
from tendril.plans.registry import QUERIES
from tendril.session import session

HEADLINE = [
    "a62_top_services_per_contractor", "a16_flatten_open_paths", "a16_flatten_declared", "a26_extracted_table", "a38_currency_lookup_on_orders",
    "a56_null_shares_by_type", "a61_redundant_columns", "a68_listed_pairs", "a74_tf_idf", "a76_label_index", "a78_service_recommendations",
    "a83_incremental_ingestion", "a87_redelivery", "b04_asof_backward", "b19_forward_backward_fill", "b22_drop_duplicates_first", "b29_multi_aggregate",
    "b31_group_filter", "b36_whole_table_reducers", "b37_quantiles_by_group", "b42_rank_methods", "b45_whole_table_cumulative", "b46_rolling_rows",
    "b47_rolling_time", "b49_exponentially_weighted", "b51_resample_with_empty_bins", "b57_pivot_table_margins", "b63_quantile_bins",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    QUERIES["b29_multi_aggregate"](spark, root).collect()  # starts the JVM and the first Python workers
    times = {}
    for name in [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds_of_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
