"""One-pass rules against the rule-by-rule loop, for growing rule lists.

    python -m checks.rule_scaling [--sf DIR] [--loop-up-to N] [rules ...]

Prints seconds, shuffles and plan lines of either way over the base findings view, both
ending in the rollup with its lists.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from checks import registry
from checks.compare import session
from checks.rule_loop import loop_rollup
from rulefold.operators.groups import group_findings
from rulefold.sources.rules import Rule

_KEYS = [("package_name",), ("package_name", "cloud_account"), ("rule_id",), ("cloud_provider", "source")]


def rules_of(count: int) -> list[Rule]:
    """Rules that each take a slice of the findings by severity, scope and source."""
    out = []
    for n in range(count):
        filters = {
            "scope_group": 2 + n % 25,
            "filtersjson": registry.both(
                registry.leaf("severity", "in", [n % 5, (n + 2) % 5]),
                registry.leaf("source", "in", [["F"], ["O"], ["P", "O"]][n % 3]),
            ),
        }
        out.append(Rule(n, n, _KEYS[n % len(_KEYS)], filters))
    return out


def measure(spark: SparkSession, make) -> dict[str, float]:
    start = time.perf_counter()
    df: DataFrame = make()
    df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return {
        "seconds": round(seconds, 2),
        "shuffles": sum("Exchange hashpartitioning" in line for line in plan),
        "plan_lines": len(plan),
    }


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.1")
    parser.add_argument("--loop-up-to", type=int, default=4)
    parser.add_argument("rules", nargs="*", type=int, default=[2, 8, 32, 128])
    args = parser.parse_args()
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    registry.base(spark, args.sf, weighted=True).write.format("noop").mode("overwrite").save()
    for count in args.rules:
        rules = rules_of(count)
        one_pass = {
            reuse: measure(
                spark,
                lambda: group_findings(registry.base(spark, args.sf, weighted=True), rules, lists=True, reuse=reuse).rollup,
            )
            for reuse in (True, False)
        }
        print(count, "one pass, stored:", one_pass[True], "recomputed:", one_pass[False], flush=True)
        if count <= args.loop_up_to:
            print(count, "loop:", measure(spark, lambda: loop_rollup(registry.base(spark, args.sf), rules)), flush=True)


if __name__ == "__main__":
    main()
