"""Rules one after the other: what the one-pass assignment is tested and measured against.

Every rule anti-joins the findings earlier rules took, filters, groups and collects.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulefold.functions.predicates import compile_filter
from rulefold.sources.rules import Rule, in_order


def loop_rollup(view: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``group_identifier, group_identifier_readable, finding_ids, cloud_accounts,
    findings_count, rule_number`` of all rules."""
    taken, results = None, []
    for number, rule in enumerate(in_order(rules)):
        if not rule.group_by:
            continue
        rest = view if taken is None else view.join(taken, "finding_id", "left_anti")
        matched = rest.where(compile_filter(rest, rule.filters))
        columns = [c.rsplit(".", 1)[-1] for c in rule.group_by]
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
        rolled = (
            matched.groupBy(*columns)
            .agg(
                F.collect_list("finding_id").alias("finding_ids"),
                F.collect_list(F.col("cloud_account")).alias("cloud_accounts"),
                F.count("finding_id").alias("findings_count"),
            )
            .select(
                F.md5(F.concat_ws("-", F.lit(str(number)), *parts)).alias("group_identifier"),
                F.concat_ws("_", *parts).alias("group_identifier_readable"),
                "finding_ids",
                "cloud_accounts",
                "findings_count",
                F.lit(number).alias("rule_number"),
            )
        )
        results.append(rolled)
        ids = matched.select("finding_id").distinct()
        taken = ids if taken is None else taken.union(ids).distinct()
    return reduce(DataFrame.unionByName, results)
