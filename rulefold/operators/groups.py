"""Groups formed by rules: the finding-to-group association and the group rollup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulefold.functions.identity import group_identifier, readable_identifier
from rulefold.operators.assign import GROUP_KEY, RULE_NUMBER, Rules, assign_rules
from rulefold.operators.paging import IDS_PER_PAGE, PAGE, paged_lists
from rulefold.operators.skew import copies_of, expand_copies, materialize
from rulefold.operators.summaries import summarize, summary_inputs
from rulefold.sources.rules import Rule


@dataclass(frozen=True)
class Grouping:
    """``association``: group identifiers and finding id. ``rollup``: one row per group.
    ``assigned``: what both are derived from, rows of ``assign_rules``."""

    association: DataFrame
    rollup: DataFrame
    assigned: DataFrame


def group_findings(
    df: DataFrame,
    rules: Rules,
    *,
    id_style: str = "compat",
    lists: bool = False,
    summaries: Sequence[str] = (),
    reuse: bool = True,
    tenant: str | None = None,
    **options: Any,
) -> Grouping:
    """Run the rules over a findings view.

    ``reuse`` computes the assignment once for both outputs (see
    ``skew.materialize``); ``options`` are those of ``assign_rules``. ``summaries`` names
    group summaries (see ``operators.summaries``) to add to the rollup; ``df`` must have the
    columns they read. Where no finding is taken, both outputs are empty and keep their
    schemas.
    """
    if summaries:
        taken = {*options.get("payload", ("cloud_account",)), "finding_id", *([tenant] if tenant else [])}
        options["payload"] = [*options.get("payload", ("cloud_account",)), *(c for c in summary_inputs(df, summaries) if c not in taken)]
    assigned = assign_rules(df, rules, tenant=tenant, **options)
    if reuse:
        assigned = materialize(assigned)
    return Grouping(
        association(assigned, id_style, tenant),
        rollup(assigned, id_style, lists, tenant, summaries),
        assigned,
    )


def create_groups(
    df: DataFrame, group_by: Sequence[str], rule_number: int = 0, **options: Any
) -> Grouping:
    """Groups of all rows of ``df`` by the given columns, under one rule number."""
    # rules without columns claim nothing; they only hold the positions before this one
    before = [Rule(id=n, order=n) for n in range(rule_number)]
    rule = Rule(id=rule_number, order=rule_number, group_by=tuple(group_by))
    return group_findings(df, [*before, rule], **options)


def _identifiers(id_style: str) -> list[Column]:
    return [
        group_identifier(F.col(RULE_NUMBER), F.col(GROUP_KEY), id_style).alias("group_identifier"),
        readable_identifier(F.col(GROUP_KEY)).alias("group_identifier_readable"),
    ]


def _group(tenant: str | None) -> list[str]:
    return ([tenant] if tenant else []) + [RULE_NUMBER, GROUP_KEY]


def association(assigned: DataFrame, id_style: str = "compat", tenant: str | None = None) -> DataFrame:
    """One row per group and finding, as often as the finding occurs in the group.

    A projection of the assigned rows: no list is collected to be taken apart again.
    """
    rows = expand_copies(assigned)
    return rows.select(*([tenant] if tenant else []), *_identifiers(id_style), "finding_id")


def group_counts(assigned: DataFrame, tenant: str | None = None) -> DataFrame:
    return assigned.groupBy(*_group(tenant)).agg(
        F.sum(copies_of(assigned)).alias("findings_count")
    )


def rollup(
    assigned: DataFrame,
    id_style: str = "compat",
    lists: bool = False,
    tenant: str | None = None,
    summaries: Sequence[str] = (),
) -> DataFrame:
    """One row per group: identifiers, finding ids, cloud accounts, count, rule number, and
    then the summaries asked for.

    The two lists hold a whole group in one value, so they are only filled where the caller
    asks for ``lists``, knowing that the largest group fits; they are NULL otherwise. The same
    pairs of group and finding, however many, are the rows of the association.
    """
    group = _group(tenant)
    lead = [tenant] if tenant else []
    if lists:
        groups = expand_copies(assigned).groupBy(*group).agg(
            F.collect_list("finding_id").alias("finding_ids"),
            F.collect_list("cloud_account").alias("cloud_accounts"),
            F.count("finding_id").alias("findings_count"),
        )
    else:
        groups = group_counts(assigned, tenant).withColumns(
            {
                "finding_ids": F.lit(None).cast("array<long>"),
                "cloud_accounts": F.lit(None).cast("array<string>"),
            }
        )
    columns = []
    if summaries:
        summed = summarize(assigned, group, only=list(summaries))
        columns = list(summaries)
        named = {g: g if g not in columns else f"group_{g}" for g in group}
        summed = summed.select(*[F.col(n).alias(f"__{g}") for g, n in named.items()], *columns)
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
        groups = groups.join(summed, same)
    return groups.select(
        *lead, *_identifiers(id_style), "finding_ids", "cloud_accounts", "findings_count", RULE_NUMBER, *columns
    )


def group_pages(
    assigned: DataFrame,
    ids_per_page: int = IDS_PER_PAGE,
    id_style: str = "compat",
    tenant: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """The rollup's two lists in pages: one row per group and ``ids_per_page`` of its entries.

    Pages are numbered from 0; joined in order they are the group's lists, sorted by finding and
    cloud account. No value or task holds more than a page, whatever the size of the group.
    """
    group = _group(tenant)
    lists = {"finding_id": "finding_ids", "cloud_account": "cloud_accounts"}
    pages = paged_lists(assigned, group, lists, ids_per_page, folder)
    lead = [tenant] if tenant else []
    return pages.select(*lead, *_identifiers(id_style), RULE_NUMBER, PAGE, *lists.values())


def rollup_of_counts(counts: DataFrame, id_style: str = "compat") -> DataFrame:
    """The rollup without lists, from counts kept per ``rule_number, group_key``."""
    return counts.select(
        *_identifiers(id_style),
        F.lit(None).cast("array<long>").alias("finding_ids"),
        F.lit(None).cast("array<string>").alias("cloud_accounts"),
        "findings_count",
        RULE_NUMBER,
    )


def united_rollups(rollups: Mapping[Sequence[str], DataFrame]) -> DataFrame:
    """Rollups with different group columns as one: each group's key in columns of their
    names, NULL where a rollup does not group by them.

    ``rollups`` maps group columns to assigned rows (of ``assign_rules``) grouped by them.
    """
    parts = []
    for columns, assigned in rollups.items():
        counts = group_counts(assigned)
        keys = [F.col(GROUP_KEY)[i].alias(c) for i, c in enumerate(columns)]
        parts.append(counts.select(*_identifiers("compat"), "findings_count", RULE_NUMBER, *keys))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return united


def claimed_ids(assigned: DataFrame, tenant: str | None = None) -> DataFrame:
    """The findings some rule took."""
    return assigned.select(*([tenant] if tenant else []), "finding_id").distinct()


def unclaimed(df: DataFrame, claimed: DataFrame, tenant: str | None = None) -> DataFrame:
    """Rows of findings no rule took."""
    return df.join(claimed, ([tenant] if tenant else []) + ["finding_id"], "left_anti")
