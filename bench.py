"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built from a fresh table set and fully executed with the
``noop`` sink (the whole plan runs, nothing is collected); the reported
time is the median of ``$BENCH_RUNS`` (default 3) runs.  Prints one
JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q13_summary_report",      # detect -> profile 4 tables (flagship)
    "b14_header_totals",       # full basket pricing chain
    "b09_resolve_stack",
    "v16_contract_runner",
    "f05_overlaps",
    "j12_stock_asof",
    "i06_stock_ledger",
    "d01_scd2_lifecycle",
    "k05_transition_matrix",
    "c06_exposure_funnel",
    "x_all_row_checks",
    "q05_numeric_profile",     # quantiles by selection in ranges
    "q06_iqr_outliers",
    "x_st06_stockout_reflected_in_snapshots",
    "x_st09_stockout_forces_inventory_to_zero",
    "j21_name_contains",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from aislekit.plans.registry import QUERIES, _load_all
    from aislekit.session import get_session
    from aislekit.sources.tables import Tables

    spark = get_session(f"local[{cpus}]", int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    _load_all()
    # warm-up outside the timings: JVM start, parquet footers, codegen caches
    Tables(spark, sf_dir).lineitem.groupBy("l_returnflag").count().write.format("noop").mode("overwrite").save()
    names = [n for n in HEADLINE if n in QUERIES]
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times: dict[str, float] = {}
    for n in names:
        samples = []
        for _ in range(runs):
            t0 = time.time()
            df = QUERIES[n].build(Tables(spark, sf_dir))
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.time() - t0)
        times[n] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": int(cpus), "runs": runs,
                      "spark": spark.version}))


if __name__ == "__main__":
    main()
