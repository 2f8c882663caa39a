"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Checks and outcomes (`dq_*`, `fk_audit`, `outcome_*`) read a run built once a session, in their warm-up; `run_build`
times the build itself. Every query is planned and run to completion into the `noop` sink, once to warm up and then
BENCH_RUNS times (default 1); the median of the timed runs counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

from quayside.plans import catalogue

HEADLINE = [
    "stg_shipments", "stg_job_charges", "stg_invoice_lines", "stg_payments",
    "shipments_conformed", "charges_classified", "invoices_matched", "first_original_invoice",
    "invoice_settlement", "ar_aging", "job_cost_pivot", "job_revenue_pivot", "shipment_financials",
    "fact_shipments", "fact_exceptions", "fact_pipeline_runs", "mart_roundtrip",
    "kpi_volume_mix", "kpi_otd_cohort", "kpi_otd_by_carrier", "kpi_margin_share", "kpi_surcharge_capture",
    "orphan_counts", "run_build", "outcome_assertions", "fk_audit", "dq_unique", "dq_expression", "dq_suite",
    "stream_hourly_counts", "stream_batch_dedup", "outage_tagging", "first_seen_commit", "latest_snapshot", "batch_dedup", "quarantine_split", "hourly_run_log", "ar_summary",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalogue.run(name, spark, path).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    found = re.search(r"sf([0-9.]+)/?$", path)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
