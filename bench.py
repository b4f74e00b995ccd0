"""Time the headline queries and print one JSON line.

Each query is built and fully computed (no-op sink). The time is the median of BENCH_RUNS warm runs
(default 1) after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from settleflow.catalogue import REGISTRY
from settleflow.session import build_session

HEADLINE = [
    "billing_reconcile", "generate_bills", "validate_import_batch", "import_claim_groups", "apply_results", "result_preview", "intake_candidates",
    "create_payback_details", "create_transfer", "subgroup_by_ceiling", "settle_transfer", "report_noncomp", "report_billing", "list_imported_groups",
    "dq_duplicate_claims", "global_row_number", "batch_amount_ceiling", "join_or_keys", "win_latest_per_key", "agg_basic",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true", "spark.python.sql.dataFrameDebugging.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for run in range(runs + 1):
            begin = time.perf_counter()
            REGISTRY[name].spark(spark, folder).write.format("noop").mode("overwrite").save()
            if run:
                taken.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, median warm run", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
