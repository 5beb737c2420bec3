"""End-to-end runs: findings tables in, two published tables out."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulefold.functions.identity import group_identifier, group_key, run_identifier
from rulefold.operators.assign import Rules
from rulefold.operators.base_view import base_findings
from rulefold.operators.exclusions import exclude_findings
from rulefold.operators.existing import match_existing_groups, ungrouped_findings
from rulefold.operators.groups import Grouping, group_findings
from rulefold.schemas import ASSOCIATION_TABLE, ROLLUP_TABLE
from rulefold.sources.rules import load_rules
from rulefold.sources.sinks import save_files, save_table
from rulefold.sources.tables import catalog_tables
from rulefold.sources.versions import Version, VersionedTables

# The tables candidate groups are formed over.
_CANDIDATE_TABLES = (
    "findings", "finding_sla_rule_connections", "plain_resources", "findings_scores", "user_status",
    "findings_additional_data", "statuses", "aggregation_groups", "findings_info",
)


def aggregate_findings(
    tables: Mapping[str, DataFrame], rules: Rules, tenant: str | None = None, **options: Any
) -> Grouping:
    """Base view, rules, groups. ``options`` are those of ``group_findings``."""
    view = base_findings(tables, weighted=True, tenant=tenant)
    return group_findings(view, rules, tenant=tenant, **options)


def aggregate_catalog(
    spark: SparkSession, prefix: str = "", rules: Rules | None = None, active_only: bool = False,
    **options: Any,
) -> Grouping:
    """As ``aggregate_findings``, over catalog tables and, by default, their rules table."""
    tables = catalog_tables(spark, prefix)
    if rules is None:
        rules = load_rules(tables["aggregation_rules"], active_only)
    return aggregate_findings(tables, rules, **options)


def candidate_groups(
    tables: Mapping[str, DataFrame],
    group_by: str,
    rule_number: int,
    rule_id: int | None = None,
    stamp: str | None = None,
    lists: bool = False,
) -> DataFrame:
    """Groups by one column of all findings with a package, next to the stored groups.

    Returns ``calculated_group_identifier``, ``calculated_finding_id`` (where a run ``stamp``
    is given), ``finding_id``, and ``group_id`` and ``main_finding_id`` of the unlocked stored
    group of that identifier: one row per group and finding that is in no group yet, and one
    with a NULL ``finding_id`` for a group without such findings. With ``lists``, one row per
    group, whose ``finding_ids_without_group`` holds them all in one value. Findings excluded
    from ``rule_id`` are left out.
    """
    column = group_by.rsplit(".", 1)[-1]
    joined = {n: df for n, df in tables.items() if n in _CANDIDATE_TABLES}
    rows = base_findings(joined, main_findings=True)
    excluder = tables.get("aggregation_rules_findings_excluder")
    if rule_id is not None and excluder is not None:
        rows = exclude_findings(rows, excluder, rule_id)
    found = ungrouped_findings(rows, [column], "existing_group_id", lists, every_group=True)
    number, key = F.lit(rule_number), group_key([column])
    stamped = [run_identifier(number, key, [group_by], stamp).alias("calculated_finding_id")] if stamp else []
    groups = found.select(
        group_identifier(number, key).alias("group_identifier"), *stamped,
        "finding_ids_without_group" if lists else "finding_id",
    )
    matched = match_existing_groups(groups, tables["aggregation_groups"])
    return matched.withColumnRenamed("group_identifier", "calculated_group_identifier")


def publish_tables(
    grouping: Grouping, prefix: str = "", file_format: str = "parquet", tenant: str | None = None
) -> None:
    """Replace both published tables. For runs over tenants, use ``publish_files``, which
    leaves the tenants that were not part of the run alone."""
    for name, df in ((ASSOCIATION_TABLE, grouping.association), (ROLLUP_TABLE, grouping.rollup)):
        save_table(df, prefix + name, file_format=file_format, partition_by=[tenant] if tenant else None)


def publish_files(
    grouping: Grouping, folder: str, file_format: str = "parquet", tenant: str | None = None
) -> None:
    """Write both outputs under ``folder``; only partitions of the run's tenants are replaced."""
    for name, df in ((ASSOCIATION_TABLE, grouping.association), (ROLLUP_TABLE, grouping.rollup)):
        save_files(df, f"{folder}/{name}", file_format, partition_by=[tenant] if tenant else None)


def publish_version(store: VersionedTables, grouping: Grouping, facts: Mapping[str, Any] | None = None) -> Version:
    """Publish both outputs as one version: readers see this pair or the one before, whatever
    fails. Raises ``StaleRun`` where another run was published while this one wrote."""
    draft = store.begin()
    for name, df in ((ASSOCIATION_TABLE, grouping.association), (ROLLUP_TABLE, grouping.rollup)):
        draft.write(name, df)
    return store.commit(draft, facts)


def export_updates(plan: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write a change plan, one folder per kind of change."""
    save_files(plan, path, file_format, partition_by=["change"])
