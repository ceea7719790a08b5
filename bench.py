"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry import build_session  # noqa: E402
from workload import load_all  # noqa: E402
from workload.registry import QUERIES, runner  # noqa: E402

HEADLINE = (
    "filter_patterns",
    "agg_client_product_day",
    "agg_daily_client",
    "calendar_features",
    "incremental_sync",
    "explode_details",
    "parse_details",
    "segmentation_features",
    "vip_features",
    "item_cosine",
    "recs_global",
    "recs_by_client",
    "recs_by_cluster",
    "recs_recent_history",
    "binary_metrics",
    "pr_curve",
    "backtest_daily",
    "monthly_evolution",
    "product_penetration",
    "declining_clients",
    "product_cutback",
    "kmeans_vip",
    "train_logistic",
    "gbt_first_tree",
    "elbow_scan",
    "permutation_importance",
    "job_evaluate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    # Start-up of the JVM and of code generation belongs to no query.
    runner(QUERIES["agg_daily_client"])(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        runner(QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
