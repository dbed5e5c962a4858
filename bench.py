"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the number of local cores.
Arguments, if any, are the names of the queries to time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gridlark.catalog import QUERIES
from gridlark.session import local_session

HEADLINE = (
    "target_by_class", "target_by_airline", "trend_by_month", "drop_duplicates", "fill_median_mode", "clean_flow",
    "fix_invalid_values", "describe_numeric", "describe_text", "dataset_info", "distribution", "category_frequency",
    "correlation_matrix", "spearman_pairs", "histogram", "box_statistics", "density", "route_features",
    "derive_features", "exact_split", "one_hot_fit", "label_encode", "scale_standard", "scale_robust",
    "model_metrics", "comparison_table", "linear_regression", "cross_validation", "feature_importance", "score_requests",
    "stream_features", "promotion_gate",
)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="gridlark-bench")
    # The first query pays for class loading; it is run once before the clock starts.
    QUERIES["category_frequency"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
