"""Headline query timings: one JSON line. One warm-up, then the median of three runs."""

from __future__ import annotations

import json
import os
import statistics
import time

from branchledger.session import SETTINGS
from branchledger.trial import QUERIES

HEADLINE = [
    "ledger_net_by_period", "head_office_ledger", "province_ledger", "control_totals",
    "period_intervals_head_office", "visit_kpis", "account_status", "portfolio",
    "employee_dim", "customer_dim", "product_dim", "inventory_detail", "targets_vs_actual",
    "rfm_segments", "product_yoy", "branch_overview", "upsert_latest", "report_ingest",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
