"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

All queries run once to warm up the JVM (JIT, file listings), so the first
query is not penalised for coming first; then each query runs ``BENCH_RUNS``
times in a row and the reported time is the median.  Results are written to Spark's ``noop`` sink, so the whole plan runs
without collecting rows to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfscope.registry import load_all  # noqa: E402
from shelfscope.session import local_session  # noqa: E402

HEADLINE = [
    "q1_campaign_value", "q2_ad_type_overlap", "q3_path_to_purchase", "q4_subscription_sales",
    "q5_vendor_sales_report", "q9_media_plan", "q11_latest_inventory", "r1_sp_campaigns_report",
    "r2_attribution_windows", "r9_market_insight", "r11_repeat_purchase", "r13_item_day_facts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="shelfscope-bench")
    reg = load_all()
    def once(name: str) -> float:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up pass
        once(name)
    times = {n: round(statistics.median(once(n) for _ in range(runs)), 3) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "spark": spark.version, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
