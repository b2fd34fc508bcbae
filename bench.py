"""Benchmark the headline questions.

Runs each on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line. Each query is materialised
in full through the ``noop`` sink (no collect to the driver); the reported
time per query is the best of ``$BENCH_PASSES`` passes (default 3) after a
JVM warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from billbook.plans.catalog import QUERIES  # noqa: E402
from billbook.session import local_session  # noqa: E402

HEADLINE = [
    "book_by_cohort",
    "book_for_cohort",
    "book_by_client",
    "stage_invoices",
    "trusted_payments",
    "integrity_report",
    "view_integrated",
    "mart_kpis",
    "status_evolution",
    "churn_evolution",
    "churn_diagnosis",
    "inactive_clients",
    "top_risk_clients",
    "client_recent_6",
    "delay_bands",
    "invoice_detail_by_delay_band",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    passes = int(os.environ.get("BENCH_PASSES", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    run(QUERIES["mart_kpis"](spark, sf_dir))  # warm-up: JVM, codegen caches
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(passes):
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "passes": passes,
    }))


if __name__ == "__main__":
    main()
