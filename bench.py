"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. Each query is built and
written to a sink that discards its rows; the best of BENCH_RUNS runs after a first,
uncounted one is reported.
"""

from __future__ import annotations

import json
import os
import time

from checks import registry
from checks.compare import session

HEADLINES = [
    "base_view",
    "base_view_fanout",
    "pred_and_or_nested",
    "exclusive_rules",
    "exclusive_rules_fanout",
    "exclusive_association",
    "rollup_first_open_or_mode",
    "rollup_times",
    "rollup_status_keys",
    "rules_with_excluder",
    "match_existing_groups",
    "change_plan",
    "ungrouped_ids",
    "tenant_runs",
    "consistency_check",
    "run_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        run(name)
        seconds[name] = round(min(run(name) for _ in range(int(os.environ.get("BENCH_RUNS", "2")))), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
