"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once as a warm-up, then three timed runs; the median is
reported. A query is executed in full with Spark's ``noop`` sink (nothing is
collected to the driver). Two ETL stages are timed from scratch every run
(fresh output folders): the warehouse build from the driver tables and the
payload pipeline (ingest -> flatten -> load -> validate). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

ETL_HEADLINE = ["read_orders_payload", "payload_summary", "flatten_orders",
                "flatten_order_items", "flatten_orders_raw", "flatten_rejects",
                "transform_summary", "table_counts", "sample_orders", "sample_order_items"]


#: Whole loads and refreshes: one timed run after the warm-up.
LOADS = ["reconcile_ledger", "load_merge", "dashboard_refresh", "lookup_user_orders"]


def main() -> None:
    from cartscope.plans.insights import INSIGHTS
    from cartscope.plans.metrics import METRICS
    from cartscope.plans.runner import run_etl
    from cartscope.registry import QUERIES
    from cartscope.session import get_spark, scratch_path
    from cartscope.sources.payload_fixture import ensure_landing
    from cartscope.sources.warehouse import build_warehouse, ensure_warehouse

    spark = get_spark(f"local[{CPUS}]", app="cartscope-bench", shuffle_partitions=int(CPUS),
                      extra={"spark.driver.memory": "16g"})
    ensure_warehouse(spark, SF_DIR)
    landing = ensure_landing(spark, SF_DIR)

    def run_query(name):
        return lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    jobs = {}
    jobs["etl_build_warehouse"] = lambda: build_warehouse(
        spark, SF_DIR, scratch_path(spark, "bench-warehouse"))
    jobs["etl_end_to_end"] = lambda: run_etl(
        spark, landing, scratch_path(spark, "bench-etl"))
    for name in list(METRICS) + list(INSIGHTS) + ETL_HEADLINE + LOADS:
        jobs[name] = run_query(name)

    timings, errors = {}, {}
    for name, job in jobs.items():
        try:
            job()  # warm-up
            samples = []
            for _ in range(1 if name in LOADS else RUNS):
                t0 = time.perf_counter()
                job()
                samples.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(samples), 4)
        except Exception as e:  # report the failure, keep measuring the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    m = re.search(r"sf([0-9.]+)", SF_DIR)
    sf = float(m.group(1)) if m else None
    total = round(sum(timings.values()), 3)
    out = {"metric": "sum_of_median_query_sec", "value": total, "unit": "sec",
           "queries": timings, "sf": sf, "cpus": int(CPUS), "runs": RUNS}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
