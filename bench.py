"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed in full into the no-op sink (nothing is
collected); the reported time per query is the median of $BENCH_RUNS runs
after one warm-up pass. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "b00_raw_admissions",        # binding: join + aggregate + per-patient sequence
    "c21_clean_pipeline",        # cleaning: text, dates, clip, impute (stats passes)
    "k05_condition_flags",       # code translation: explode, dimension joins, pivot
    "w01_days_since_last_admission",
    "x01_feature_pipeline",      # whole feature pipeline
    "a08_quality_report",        # one-pass profile + duplicates
    "a14_rate_by_age_group",     # flagship
    "e05_roc_auc",               # exact AUC, two-level prefix sums
    "e09_detailed_metric_row",
    "g02_group_performance",
    "m03_logistic_regression",   # fit + score
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from wardflow.session import build_session
    from wardflow.plans import registry
    spark = build_session(f"local[{cpus}]", app_name="wardflow-bench", shuffle_partitions=int(cpus) * 2)
    qs = registry.queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    def once(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up: JIT, file listing caches
        once(name)
    times = {}
    for name in names:
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "admissions": rows,
                      "runs": runs, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
