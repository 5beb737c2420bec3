"""Aggregation rules: from a rules table, or from JSON files."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the type of the rules that form groups.
GROUPING_TYPE = "AGG"


@dataclass(frozen=True)
class Rule:
    """Findings that pass ``filters`` are grouped by ``group_by``.

    ``sql_filter`` is the older form of the filter, SQL text (see ``functions.sql_text``) over
    ``table.column`` names; it only applies where a run asks for it.
    """

    id: int
    order: int | None = None
    group_by: tuple[str, ...] = ()
    filters: Mapping[str, Any] = field(default_factory=dict)
    rule_type: str = GROUPING_TYPE
    field_calculation: Mapping[str, Any] = field(default_factory=dict)
    sql_filter: str | None = None

    @classmethod
    def parse(
        cls, definition: str | Mapping[str, Any] | None, id: int, order: int | None = None, **more: Any
    ) -> Rule:
        """A rule from its definition, a dictionary or its JSON text."""
        if isinstance(definition, str):
            definition = json.loads(definition) if definition.strip() else {}
        definition = definition or {}
        return cls(
            id=id,
            order=order,
            group_by=tuple(definition.get("group_by") or ()),
            filters=definition.get("filters_config") or {},
            field_calculation=definition.get("field_calculation") or {},
            sql_filter=definition.get("finding_filter"),
            **more,
        )


def in_order(rules: Iterable[Rule]) -> list[Rule]:
    """By order, then id; rules without an order come last."""
    return sorted(rules, key=lambda r: (r.order is None, r.order or 0, r.id))


def load_rules(rules: DataFrame, active_only: bool = False) -> list[Rule]:
    """Read the grouping rules of a rules table, in order.

    Rules are configuration and become part of the query plan, so they are read on the
    driver. ``active_only`` leaves out rules marked disabled or deleted.
    """
    return [rule for _, rule in _loaded(rules, active_only, [])]


def load_rules_by_tenant(
    rules: DataFrame, tenant: str = "tenant", active_only: bool = False
) -> dict[str, list[Rule]]:
    """As ``load_rules``, for a table that holds the rules of several tenants: one reading."""
    by_tenant: dict[str, list[Rule]] = {}
    for name, rule in _loaded(rules, active_only, [tenant]):
        by_tenant.setdefault(name, []).append(rule)
    return by_tenant


def _loaded(rules: DataFrame, active_only: bool, tenant: list[str]) -> list[tuple[Any, Rule]]:
    """``(tenant or None, rule)``, in the order of the rules."""
    wanted = rules.where(F.col("type") == GROUPING_TYPE)
    if active_only:
        for flag in ("disabled", "is_deleted"):
            wanted = wanted.where(~F.coalesce(F.col(flag), F.lit(False)))
    rows = wanted.select("id", "order", "type", "aggregation_query", *tenant).collect()
    parsed = [
        (r[tenant[0]] if tenant else None, Rule.parse(r["aggregation_query"], r["id"], r["order"], rule_type=r["type"]))
        for r in rows
    ]
    return sorted(parsed, key=lambda pair: (pair[1].order is None, pair[1].order or 0, pair[1].id))


def parse_rules(text: str) -> list[Rule]:
    """Rules from JSON text: one rule or an array; their position is their order."""
    parsed = json.loads(text)
    definitions = parsed if isinstance(parsed, list) else [parsed]
    return [Rule.parse(d, id=n, order=n) for n, d in enumerate(definitions)]


def read_rules_file(path: str) -> list[Rule]:
    with open(path, encoding="utf-8") as file:
        return parse_rules(file.read())
