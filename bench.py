"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times (default 1); its time
is the median, from building the plan until every row is produced.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brinemark.session import build_session  # noqa: E402
from brinemark.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "daily_summary", "daily_summary_observed", "daily_incremental", "unsummarised_days", "parse_quality",
    "quarantine_reasons", "class_share", "coast_kpis", "month_climatology", "monthly_by_year", "recombine_by_month",
    "seastate_matrix", "label_top_n", "group_quantile", "group_quantile_bracket", "extreme_profile", "decluster_peaks",
    "gpd_return_levels", "return_level_ci", "forecast_tidy", "describe_by", "corr_matrix", "fd_histogram", "wind_rose",
    "contingency", "exceedance_curve", "stratified_sample", "classification_metrics", "stream_refine",
    "coast_payload", "forecast_mle", "gmm_gate", "stream_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
