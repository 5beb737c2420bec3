"""Checks and reports over grouping results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulefold.operators.assign import GROUP_KEY, RULE_NUMBER
from rulefold.operators.skew import copies_of


def schema_differences(df: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """Columns ``df`` lacks, has beyond the schema, or has with another type."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in schema}
    return {
        "missing": sorted(set(want) - set(have)),
        "unexpected": sorted(set(have) - set(want)),
        "retyped": sorted(n for n in set(have) & set(want) if have[n] != want[n]),
    }


def count_mismatches(
    rollup: DataFrame, association: DataFrame, tenant: str | None = None
) -> DataFrame:
    """Groups whose ``findings_count`` is not their number of association rows.

    Returns ``[tenant,] group_identifier, expected_count, actual_count``; no rows means
    agreement. Both sides are counted before they meet, so hot groups join as one row.
    """
    group = ([tenant] if tenant else []) + ["group_identifier"]
    expected = rollup.select(*group, F.col("findings_count").alias("expected_count"))
    actual = association.groupBy(*group).agg(F.count("finding_id").alias("actual_count"))
    return (
        expected.join(actual, group, "left")
        .withColumn("actual_count", F.coalesce("actual_count", F.lit(0)))
        .where(F.col("expected_count") != F.col("actual_count"))
    )


def association_difference(expected: DataFrame, actual: DataFrame, distinct: bool = True) -> DataFrame:
    """Rows only one side has, marked ``missing`` or ``unexpected``.

    ``distinct=False`` also tells rows that occur more often on one side.
    """

    def only(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
        rest = left.subtract(right) if distinct else left.exceptAll(right)
        return rest.withColumn("difference", F.lit(label))

    columns = expected.columns
    return only(expected, actual.select(columns), "missing").unionByName(
        only(actual.select(columns), expected, "unexpected")
    )


def run_report(assigned: DataFrame, tenant: str | None = None) -> DataFrame:
    """Groups, distinct findings and rows per rule, from one pass over the assignment."""
    rule = ([tenant] if tenant else []) + [RULE_NUMBER]
    per_group = assigned.groupBy(*rule, GROUP_KEY).agg(
        F.sum(copies_of(assigned)).alias("rows"), F.count_distinct("finding_id").alias("findings")
    )
    return per_group.groupBy(*rule).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("findings").alias("group_findings"),
        F.sum("rows").alias("findings_count"),
    )


def run_totals(rollup: DataFrame) -> DataFrame:
    """Number of groups, and of findings in them."""
    return rollup.agg(
        F.count(F.lit(1)).alias("total_groups"), F.sum("findings_count").alias("total_findings")
    )


def unmatched_findings(tables: dict[str, DataFrame]) -> DataFrame:
    """How many findings with a package the base view drops, by the row they lack.

    One row: findings without a resource, score, user status or status, and those that
    name a group which does not exist.
    """
    findings = tables["findings"].where(F.col("package_name").isNotNull())

    def lacking(key: str, other: DataFrame, other_key: str, name: str) -> DataFrame:
        # counted per key first, so that a hot key meets the other side as one row
        per_key = findings.groupBy(key).agg(F.count(F.lit(1)).alias("findings"))
        if name == "group":
            per_key = per_key.where(F.col(key).isNotNull())
        known = other.select(F.col(other_key).alias(key)).distinct()
        missing = per_key.join(known, key, "left_anti")
        return missing.agg(F.coalesce(F.sum("findings"), F.lit(0)).alias(f"without_{name}"))

    with_status = tables["user_status"].join(
        tables["statuses"].select(F.col("key").alias("actual_status_key")).distinct(),
        "actual_status_key",
        "left_semi",
    )
    parts = [
        lacking("main_resource_id", tables["plain_resources"], "id", "resource"),
        lacking("id", tables["findings_scores"], "finding_id", "score"),
        lacking("id", with_status, "id", "status"),
        lacking("aggregation_group_id", tables["aggregation_groups"], "id", "group"),
    ]
    # one-row frames side by side, as scalar subqueries of the first
    report = parts[0]
    for part in parts[1:]:
        report = report.withColumn(part.columns[0], part.scalar())
    return report
