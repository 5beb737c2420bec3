"""Findings that individual rules must not take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXCLUDED = "__excluded_rules"


def exclude_findings(
    df: DataFrame, excluder: DataFrame, rule_id: int, tenant: str | None = None
) -> DataFrame:
    """Rows of ``df`` whose finding is not excluded from the rule.

    A NULL in the list excludes nothing, unlike in SQL's ``NOT IN``.
    """
    finding = [tenant, "finding_id"] if tenant else ["finding_id"]
    listed = excluder.where(F.col("aggregation_rule_id") == rule_id).select(*finding).distinct()
    return df.join(listed, finding, "left_anti")


def excluded_rules(excluder: DataFrame, rule_ids: list[int], tenant: str | None = None) -> DataFrame:
    """One row per finding with the rules it is excluded from.

    Only rules of the run are listed, so a set is never longer than the rule list.
    """
    finding = [tenant, "finding_id"] if tenant else ["finding_id"]
    return (
        excluder.where(F.col("aggregation_rule_id").isin(rule_ids) & F.col("finding_id").isNotNull())
        .groupBy(*finding)
        .agg(F.collect_set("aggregation_rule_id").alias(EXCLUDED))
    )


def with_excluded_rules(df: DataFrame, excluded: DataFrame, tenant: str | None = None) -> DataFrame:
    return df.join(excluded, [tenant, "finding_id"] if tenant else ["finding_id"], "left")


def is_excluded(rule_id: int) -> Column:
    return F.coalesce(F.array_contains(F.col(EXCLUDED), rule_id), F.lit(False))
