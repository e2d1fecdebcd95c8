"""Benchmark: the pipeline's actions and the report queries on one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. Landing files are rendered from the test tables first
(not timed), and every job runs once untimed on the smallest tables to warm
the JVM; then each job runs as the reference's jobs do —
stage locations, stage products, stage transactions, enrich, reporting — and
each registered report query is timed on its own (collecting its rows), and
the streaming intake loads the same landing files once more.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.plans import fixtures, jobs  # noqa: E402
from salesmart.plans.registry import QUERIES  # noqa: E402
from salesmart.session import get_session, scratch_path  # noqa: E402
from salesmart.streaming.intake import intake_stream  # noqa: E402

# to last log line, start-up included, 200k transactions, unknown hardware).
REFERENCE_LOG_SEC = {"stage_locations": 45, "stage_products": 52, "enrich": 89,
                     "reporting": 107}

REPORT_QUERIES = ("sales_by_province", "sales_by_store", "sales_by_store_top20",
                  "sales_by_category", "top_stores_by_province",
                  "top_categories_by_department", "sales_by_loyalty_province",
                  "sales_by_loyalty", "metrics_by_year", "metrics_by_loyalty",
                  "report_bundle", "enrich_counts")


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return round(time.perf_counter() - t0, 3), out


def warm_up(spark, sf_dir: str) -> None:
    """Untimed: every job and one query once on the smallest tables, so the
    timed run does not pay one-time JVM class loading and JIT compilation."""
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    small = small if os.path.isdir(small) else sf_dir
    root = scratch_path(spark, "bench-warm-up")
    for write in (fixtures.write_landing, fixtures.write_location_landing,
                  fixtures.write_product_landing):
        write(spark, small, f"{root}/landing")
    for action in jobs.ACTIONS:
        jobs.run(spark, root, action)
    QUERIES["sales_by_loyalty"](spark, small).collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app="salesmart-bench",
                        shuffle_partitions=max(8, 2 * cpus),
                        extra_conf={"spark.driver.memory": "8g"})
    root = scratch_path(spark, "bench")
    landing = f"{root}/landing"
    fixtures.write_landing(spark, sf_dir, landing)
    fixtures.write_location_landing(spark, sf_dir, landing)
    fixtures.write_product_landing(spark, sf_dir, landing)
    warm_up(spark, sf_dir)

    times: dict[str, float] = {}
    for action in jobs.ACTIONS:
        times[action.replace("-", "_")], _ = timed(lambda a=action: jobs.run(spark, root, a))
    jobs_total = round(sum(times.values()), 3)
    # Streaming variant of stage-transactions over the same landing files.
    times["intake_stream"], _ = timed(lambda: intake_stream(
        spark, landing, f"{root}/stream/transactions", f"{root}/stream/_checkpoint"))
    for name in REPORT_QUERIES:
        times[name], _ = timed(lambda n=name: QUERIES[n](spark, sf_dir).collect())
    reports_total = round(sum(times[n] for n in REPORT_QUERIES), 3)
    spark.stop()
    print(json.dumps({
        "metric": "batch_jobs_wall_clock",
        "value": jobs_total,
        "unit": "sec",
        "queries": times,
        "reports_total_sec": reports_total,
        "reference_log_sec": REFERENCE_LOG_SEC,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
