"""Benchmark the report jobs R1-R8 (plus the all-supplier statement).

Production shape: the finance relations are tables. The bench first *lands* them
once - the driver tables of ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) are
staged into parallel parquet files, the finance relations are derived from them and
written as tables bucketed by document id (``statera.sources.landing``) - and
reports that time as ``landing_sec``. Then every headline job runs on the landed
tables with ``local[$BENCH_CPUS]``: plan construction plus execution, every column
computed through the ``noop`` sink, one warm-up and ``$BENCH_RUNS`` timed runs
(default 3), median reported. ``BENCH_MODE=derive`` times the jobs on relations
derived on the fly instead (no landing). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ap_aging_detail",               # R1
    "ap_aging_summary",              # R2
    "supplier_statement",            # R3
    "patient_statement_g1",          # R4
    "patient_statement_g2",          # R5
    "ap_aging_detail_subtotals",     # R6
    "ap_aging_detail_grand_total",   # R7
    "ap_aging_summary_grand_total",  # R8
    "running_balance",               # R3 for all suppliers in one run
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    mode = os.environ.get("BENCH_MODE", "landed")
    from statera.session import build_session, scratch_dir
    from statera.plans.catalog import TABLE_QUERIES
    from statera.sources import derive_tables
    from statera.sources.landing import land_tables, stage_driver_tables

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="statera-bench-wh-")})
    # intermediate tables go next to the session's checkpoint folder (shared on a cluster)
    scratch = scratch_dir(spark, "statera-bench")
    t0 = time.perf_counter()
    if mode == "landed":
        staged = stage_driver_tables(spark, sf_dir, f"{scratch}/driver", files=cpus)
        tables = land_tables(spark, derive_tables(spark, staged), "finance", buckets=cpus,
                             location=f"{scratch}/finance")
    else:
        tables = derive_tables(spark, sf_dir)
    landing = time.perf_counter() - t0

    times: dict[str, float] = {}
    for name in HEADLINE:
        def once() -> float:
            t = time.perf_counter()
            TABLE_QUERIES[name](tables).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        once()
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "report_jobs_total_median", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "mode": mode, "landing_sec": round(landing, 3),
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
