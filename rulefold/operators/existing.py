"""Computed groups against the groups that exist already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulefold.operators.paging import IDS_PER_PAGE, paged_lists
from rulefold.operators.skew import COPIES, expand_copies

# The states of a group in a change plan.
NEW, MATCHED, VANISHED = "new", "matched", "vanished"


def match_existing_groups(
    groups: DataFrame, existing: DataFrame, tenant: str | None = None
) -> DataFrame:
    """Add ``group_id`` and ``main_finding_id`` of the unlocked group of the same identifier.

    Groups without one keep their row, with NULLs.
    """
    key = _identity(tenant)
    unlocked = existing.where(~F.col("is_locked")).select(
        *key, F.col("id").alias("group_id"), "main_finding_id"
    )
    return groups.join(unlocked, key, "left")


def ungrouped_findings(
    df: DataFrame, group_by: list[str], group_id: str = "aggregation_group_id", lists: bool = False,
    every_group: bool = False,
) -> DataFrame:
    """Per group, its findings that are in no existing group yet, from one reading of ``df``.

    With ``lists``, one row per group with ``finding_ids_without_group``, empty where all its
    findings are grouped; the largest group's ids must fit in one value. Without, one row per
    such finding: the same pairs, whatever the size of a group. With ``every_group``, a group
    whose findings are all grouped keeps one row there, with a NULL ``finding_id``.
    """
    ungrouped = F.when(F.col(group_id).isNull(), F.col("finding_id"))
    if not lists and not every_group:
        return df.where(F.col(group_id).isNull()).select(*group_by, "finding_id")
    if not lists:
        # grouped findings combine map-side to one row of their group
        counted = df.groupBy(*group_by, ungrouped.alias("finding_id")).agg(F.count(F.lit(1)).alias(COPIES))
        some = F.sum(F.when(F.col("finding_id").isNotNull(), F.col(COPIES)))
        without = counted.groupBy(*group_by).agg(some.alias(COPIES)).where(F.col(COPIES).isNull())
        rows = expand_copies(counted.where(F.col("finding_id").isNotNull())).select(*group_by, "finding_id")
        none = F.lit(None).cast(df.schema["finding_id"].dataType).alias("finding_id")
        return rows.unionByName(without.select(*group_by, none))
    ids = F.collect_list(ungrouped)
    return df.groupBy(*group_by).agg(ids.alias("finding_ids_without_group"))


def ungrouped_pages(
    df: DataFrame, group_by: list[str], group_id: str = "aggregation_group_id", ids_per_page: int = IDS_PER_PAGE,
    folder: str | None = None,
) -> DataFrame:
    """The lists of ``ungrouped_findings`` in pages of at most ``ids_per_page`` ids, in their order.

    A group whose findings are all grouped has no page.
    """
    rows = df.where(F.col(group_id).isNull() & F.col("finding_id").isNotNull())
    return paged_lists(rows, group_by, {"finding_id": "finding_ids_without_group"}, ids_per_page, folder)


def change_plan(groups: DataFrame, existing: DataFrame, tenant: str | None = None) -> DataFrame:
    """What a run changes: each identifier as new, matched or vanished.

    ``groups`` holds computed groups (``group_identifier, findings_count``), ``existing``
    the stored ones. Locked groups are neither matched nor reported as vanished, since a
    run must not touch them. Computed groups that share an identifier count together, so
    an identifier occurs once per stored group it belongs to.
    """
    key = _identity(tenant)
    computed = groups.groupBy(*key).agg(
        F.count(F.lit(1)).alias("computed_groups"), F.sum("findings_count").alias("findings_count")
    )
    stored = existing.where(~F.col("is_locked")).select(*key, F.col("id").alias("group_id"))
    return computed.join(stored, key, "full").select(
        *key,
        "group_id",
        "computed_groups",
        "findings_count",
        _state().alias("change"),
    )


def _identity(tenant: str | None) -> list[str]:
    return ([tenant] if tenant else []) + ["group_identifier"]


def _state() -> Column:
    return (
        F.when(F.col("group_id").isNull(), NEW)
        .when(F.col("computed_groups").isNull(), VANISHED)
        .otherwise(MATCHED)
    )
