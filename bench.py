"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores.
Every query runs once to warm the JVM and is then timed on a second, complete run: the plan
is built anew, no table is cached, and all rows are produced (into a sink that drops them). The CSV
files that a1_price_csv_scan reads are landed once, in the warm run.
"""

from __future__ import annotations

import json
import os
import time

from voltspan.plans.catalog import QUERIES
from voltspan.session import local_session

HEADLINE = [
    "a1_price_csv_scan",
    "c5_month_trim",
    "d15_surrogate_key",
    "d18_classify_fueltech",
    "f1_region_daily",
    "f2_exact_median",
    "f5_generation_half_hour",
    "f6_generation_daily",
    "f7_region_energy_daily",
    "f14_price_coverage",
    "f15_scada_extent",
    "f22_last_wins",
    "f24_top_fueltechs",
    "j2_rolling_backtest",
    "j6_all_models_forecast",
    "j7_accuracy_all_models",
    "j8_engine_benchmark",
    "j10_price_anomalies",
    "k5_unique_combination",
    "l1_nem_latest",
    "l4_fuel_mix_recent",
    "l5_price_trend",
    "l10_mix_by_region",
    "l12_carbon_latest",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "voltspan-bench")
    times = {}
    for name in HEADLINE:
        run(spark, sf_dir, name)
        times[name] = round(run(spark, sf_dir, name), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
