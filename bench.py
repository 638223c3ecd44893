"""Benchmark: land the raw layer, build + test the warehouse, run the reports.

Prints ONE JSON line:
  {"metric": "warehouse_build_test_report_sec", "value": N, "unit": "sec",
   "queries": {...per step seconds...}, "sf": "..."}

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from larchmart.config import FIXTURE_CONFIG
    from larchmart.plans import build as warehouse_build
    from larchmart.plans.warehouse import Warehouse
    from larchmart.session import local_session
    from larchmart.sources import fixtures, landing

    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, int(cpus) * 2))))
    timings: dict[str, float] = {}

    # 1. raw layer: source documents -> raw tables, published as one run
    t = time.time()
    raw_root = landing.new_run_folder(spark, "raw")
    for entity, df in fixtures.raw_tables(spark, sf_dir).items():
        df.write.mode("overwrite").parquet(f"{raw_root}/run_id=bench/{entity}")
    landing.publish(spark, raw_root, "bench")
    timings["land_raw"] = time.time() - t
    raw = landing.raw_tables_from(spark, raw_root)

    # 2. build every model with its checks (gated)
    t = time.time()
    out_root = landing.new_run_folder(spark, "warehouse")
    views = os.environ.get("BENCH_MATERIALIZE_VIEWS", "1") == "1"
    fresh = datetime(2025, 1, 2)  # within a day of the fixture's loads
    result = warehouse_build.build(spark, raw, FIXTURE_CONFIG, out_root, materialize_views=views, as_of=fresh)
    timings["build_and_test"] = time.time() - t
    for k, v in result.timings.items():
        timings[k] = v

    # 3. reports over the materialised marts
    wh = Warehouse.from_tables(spark, result.tables, FIXTURE_CONFIG)
    report_total = 0.0
    for q in ("q1", "q2", "q3", "q4", "q5"):
        t = time.time()
        getattr(wh, q)().collect()
        timings[q] = time.time() - t
        report_total += timings[q]

    total = timings["build_and_test"] + report_total
    print(
        json.dumps(
            {
                "metric": "warehouse_build_test_report_sec",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "failed_models": result.failed,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
