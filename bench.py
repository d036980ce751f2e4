"""Time the headline queries and print one JSON line.

The session is warmed up by the first query. Each query then runs once to warm up code and file caches and is
timed, as the median of ``BENCH_RUNS`` runs (default 1); writing to the no-op sink computes every row
and column without moving them to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from creditmart.plans.catalog import QUERIES
from creditmart.session import build_session

HEADLINE = (
    "loan_ageing", "label_store", "silver_financials", "silver_clickstream", "gold_financials", "occupation_ohe",
    "asof_multi", "exact_dataset", "key_overlap", "entity_stats", "null_rates_by_month", "financials_quality",
    "profile", "histogram", "corr_matrix", "rolling_windows", "strat_sizes", "scale", "roc_auc", "metric_grid",
    "trend", "trend_joined",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "creditmart-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    run(spark, names[0], folder)
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(median(run(spark, name, folder) for _ in range(int(os.environ.get("BENCH_RUNS", "1")))), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
