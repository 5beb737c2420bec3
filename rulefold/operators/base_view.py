"""The base findings view: one wide row set joined from the findings tables.

Joins run in an order that shuffles the wide side as little as possible: first the
dimensions, which may be skewed (existing groups, which add little to a row, then
resources with their tags and scopes), then everything keyed by the finding, which
shares one partitioning and leaves it for the rule assignment.

Tables of which the view uses no column, or only the key, can still multiply rows.
They are counted per key before the join (map-side combined) and the product is kept
as ``row_copies``, so ten thousand tickets of one finding cost one number, not ten
thousand wide rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulefold.operators.skew import COPIES, copies_by_key, expand_copies, skew_join
from rulefold.schemas import BASE_VIEW_NAME, schema_of, view_name_of

# The columns of the view, by the table they come from.
VIEW_COLUMNS = {
    "findings": [
        "id", "package_name", "main_resource_id", "aggregation_group_id", "source",
        "rule_family", "rule_id", "finding_type_str", "fix_subtype", "fix_type", "fix_id",
    ],
    "finding_sla_rule_connections": ["finding_id"],
    "plain_resources": [
        "id", "cloud_account", "cloud_account_friendly_name", "r1_resource_type",
        "tags_values", "tags_key_values", "cloud_provider",
    ],
    "findings_scores": ["finding_id", "severity"],
    "user_status": ["id", "actual_status_key"],
    "findings_additional_data": ["finding_id"],
    "statuses": ["key"],
    "aggregation_groups": ["id", "main_finding_id", "group_identifier", "is_locked"],
    "findings_info": ["id"],
}
COMPUTED_COLUMNS = [
    "category", "cve", "scope_ids", "scope_id", "scope_group", "scope_group_name",
]

# Further columns that group summaries read. ``category`` of the view is the status
# category; the finding's own category goes by ``finding_category``.
SUMMARY_COLUMNS = {
    "findings": [
        "sub_category", "fix_vendor_id", "rule_type", "datasource_id",
        "datasource_definition_id", "image_id", "scan_id", "resource_reported_not_exist",
        "last_reported_time", "discovered_time", "created_time", "original_status",
    ],
    "findings_scores": [
        "score", "original_score", "user_score", "normalized_score", "factorized_score",
    ],
    "user_status": ["system_status_key", "user_status_key"],
}
OPTIONAL_FINDING_COLUMNS = [
    "cisa_kev", "vulncheck_kev", "is_fixable", "has_exploit", "vulnerability_reported_date",
]

# The columns of the older forms of the view, by their names there. They
# join no tickets, user SLAs or scopes; ``scope_group`` is the one of the selection rule
# behind the score, ``category`` of the compact form the finding's own.
_OLDER_NAMES = {
    "existing_main_finding_id": "main_finding_id",
    "existing_group_identifier": "group_identifier",
}
_FULL = [
    "finding_id", "package_name", "main_resource_id", "aggregation_group_id", "source",
    "rule_family", "rule_id", "sla_connection_id", "resource_id", "cloud_account",
    "root_cloud_account_friendly_name", "tags_values", "tags_key_values", "score_finding_id",
    "severity", "resource_type", "cloud_provider", "user_status_id", "actual_status_key",
    "additional_data_id", "status_key", "existing_group_id", "is_locked", "findings_info_id",
    "finding_type", "fix_subtype", "category", "fix_id", "cve", "fix_type",
]
_COMPACT = [
    "finding_id", "package_name", "main_resource_id", "aggregation_group_id", "sla_connection_id",
    "resource_id", "root_cloud_account_friendly_name", "score_finding_id", "user_status_id",
    "actual_status_key", "additional_data_id", "status_key", "existing_group_id", "is_locked",
    "findings_info_id", "source", "severity", "rule_id", "rule_family",
]
OLDER_VIEWS: dict[str, dict[str, str]] = {
    "full": {**{c: c for c in _FULL}, **_OLDER_NAMES, "scope_group": "rule_scope_group"},
    "compact": {
        **{c: c for c in _COMPACT}, **_OLDER_NAMES,
        "root_cloud_account": "cloud_account", "category": "finding_category",
    },
}
_NOT_IN_OLDER_VIEWS = (
    "finding_ticket_associations", "tickets", "user_sla", "resource_to_scopes", "scope_groups",
)

_KEY = "__key"
_SCOPE_COPIES = "__scope_copies"
# Fixed value: entries of a list of scopes that travel in one row.
SCOPES_PER_ROW = 64


def view_columns(summary: bool = False) -> list[str]:
    """The view's column names, in order."""
    names = [view_name_of(t, c) for t, columns in VIEW_COLUMNS.items() for c in columns]
    names += COMPUTED_COLUMNS
    if summary:
        names += ["finding_category", "status_category"]
        names += [c for columns in SUMMARY_COLUMNS.values() for c in columns]
    return names


def existing_group_filter(
    finding_id: Column, group_id: Column, main_finding_id: Column
) -> Column:
    """Not the main finding of its group, or in no group at all.

    A finding that names a group which does not exist compares with NULL and is dropped.
    """
    return (finding_id != main_finding_id) | group_id.isNull()


def first_element(array: str) -> Column:
    """The first entry of an array, NULL for an empty or missing one."""
    return F.get(F.col(array), F.lit(0))


def base_findings(
    tables: Mapping[str, DataFrame],
    weighted: bool = False,
    summary: bool = False,
    tenant: str | None = None,
    main_findings: bool = False,
    rule_scope: bool = False,
) -> DataFrame:
    """Join the findings tables into the base view.

    ``weighted`` keeps equal rows as one row with ``row_copies`` (what rule assignment
    wants); otherwise every copy is a row. ``summary`` adds the columns that group
    summaries need. Of the left-joined tables, any may be missing. ``tenant`` is a column
    that tells the rows of several tenants apart, whose ids may collide: rows only meet
    rows of their tenant, and tables without the column serve all. ``main_findings`` keeps
    what ``existing_group_filter`` would drop. ``rule_scope`` adds ``rule_scope_group``, the
    scope group of the selection rule behind the score.
    """
    shared = [tenant] if tenant else []
    findings = _findings(tables["findings"], shared)
    rows = skew_join(
        findings, _groups(tables, findings, shared), "aggregation_group_id", _KEY, "left", "finding_id", shared
    )
    if not main_findings:
        rows = rows.where(
            existing_group_filter(
                F.col("finding_id"), F.col("aggregation_group_id"), F.col("main_finding_id")
            )
        )
    rows = skew_join(
        rows, _resources(tables, shared), "main_resource_id", _KEY, "inner", "finding_id", shared
    )

    factors = [_SCOPE_COPIES]
    per_finding = [
        (_scores(tables, shared, rule_scope), "inner"),
        (_status(tables, shared), "inner"),
        (_presence(tables, "finding_sla_rule_connections", "finding_id", shared), "left"),
        (_additional_data(tables, shared), "left"),
        (_presence(tables, "findings_info", "id", shared), "left"),
        (_ticket_copies(tables, shared), "left"),
        (_user_sla_copies(tables, shared), "left"),
    ]
    for number, (side, how) in enumerate(per_finding):
        if side is None:
            continue
        if COPIES in side.columns:
            factors.append(f"__copies_{number}")
            side = side.withColumnRenamed(COPIES, factors[-1])
        rows = _join_on_key(rows, side, "finding_id", how, shared)
    copies = [F.coalesce(F.col(f), F.lit(1)) for f in factors]
    rows = rows.withColumn(COPIES, reduce(lambda a, b: a * b, copies, F.lit(1).cast("long")))
    rows = rows.withColumn("__scope", F.explode_outer("__scopes")).select("*", "__scope.*").drop("__scopes", "__scope")

    names = view_columns(summary)
    if summary:
        names += [c for c in OPTIONAL_FINDING_COLUMNS if c in rows.columns]
    if rule_scope:
        names.append("rule_scope_group")
    for absent in set(names) - set(rows.columns):
        rows = rows.withColumn(absent, F.lit(None).cast("string" if absent == "cve" else "long"))
    weighted_rows = rows.select(*shared, *names, COPIES)
    if weighted:
        return weighted_rows
    return expand_copies(weighted_rows).select(*shared, *names)


def older_view(tables: Mapping[str, DataFrame], form: str = "full") -> DataFrame:
    """The view in one of its older forms (see ``OLDER_VIEWS``)."""
    joined = {n: df for n, df in tables.items() if n not in _NOT_IN_OLDER_VIEWS}
    view = base_findings(joined, summary=True, rule_scope=form == "full")
    return view.selectExpr(*[f"{column} AS {name}" for name, column in OLDER_VIEWS[form].items()])


def packaged_findings(findings: DataFrame) -> DataFrame:
    """Findings alone, under their names in the view: those that name a package."""
    named = _renamed(findings, "findings", findings.columns)
    return findings.where(F.col("package_name").isNotNull()).selectExpr(*named)


def register_base_view(view: DataFrame, name: str = BASE_VIEW_NAME) -> DataFrame:
    view.createOrReplaceTempView(name)
    return view


def _join_on_key(
    left: DataFrame, side: DataFrame, key: str, how: str, shared: Sequence[str]
) -> DataFrame:
    """Join a side keyed by ``__key`` (and the shared columns it has), and drop its keys."""
    same = F.col(key) == F.col(_KEY)
    for c in shared:
        if c in side.columns:
            side = side.withColumnRenamed(c, f"__side_{c}")
            same = same & (F.col(c) == F.col(f"__side_{c}"))
    return left.join(side, same, how).drop(_KEY, *[f"__side_{c}" for c in shared])


def _in(df: DataFrame, shared: Sequence[str]) -> list[str]:
    return [c for c in shared if c in df.columns]


def _renamed(df: DataFrame, table: str, columns: list[str]) -> list[str]:
    """Projections of the columns ``df`` has, under their names in the view."""
    return [f"{c} AS {view_name_of(table, c)}" for c in columns if c in df.columns]


def _findings(df: DataFrame, shared: Sequence[str]) -> DataFrame:
    columns = VIEW_COLUMNS["findings"] + SUMMARY_COLUMNS["findings"]
    columns += [c for c in OPTIONAL_FINDING_COLUMNS if c in df.columns]
    own_category = ["category AS finding_category"] if "category" in df.columns else []
    return df.where(F.col("package_name").isNotNull()).selectExpr(
        *shared, *_renamed(df, "findings", columns), *own_category
    )


def _resources(tables: Mapping[str, DataFrame], shared: Sequence[str]) -> DataFrame:
    df = tables["plain_resources"]
    resources = df.selectExpr(
        *_in(df, shared),
        "id AS __resource",
        *_renamed(df, "plain_resources", VIEW_COLUMNS["plain_resources"]),
    )
    scopes = _scopes(tables, shared)
    if scopes is None:
        none = F.array(_scope(*(F.lit(None).cast(t) for t in ("long", "long", "string"))))
        ids = F.lit(None).cast("array<long>")
        with_scopes = resources.withColumns({"scope_ids": ids, "__scopes": none, _SCOPE_COPIES: F.lit(1).cast("long")})
    else:
        with_scopes = _join_on_key(resources, scopes, "__resource", "left", _in(df, shared))
    return with_scopes.withColumnRenamed("__resource", _KEY)


def _scope(scope_id: Column, group: Column, name: Column) -> Column:
    return F.struct(scope_id.alias("scope_id"), group.alias("scope_group"), name.alias("scope_group_name"))


def _scopes(tables: Mapping[str, DataFrame], shared: Sequence[str]) -> DataFrame | None:
    """Per resource, its lists of scopes: ``scope_ids`` and, with their names, ``__scopes``.

    A list takes one row per ``SCOPES_PER_ROW`` entries, and equal lists of a resource are
    counted, so no value grows with a resource beyond its own ``scope_ids``.
    Scopes are named here, among resources, so that neither their list nor their names are
    joined to findings: those explode the list when all joins are done.
    """
    scopes, groups = tables.get("resource_to_scopes"), tables.get("scope_groups")
    if scopes is None:
        return None
    lead = _in(scopes, shared)
    lists = scopes.groupBy(*lead, "resource_id", "scope_ids").agg(F.count(F.lit(1)).alias(_SCOPE_COPIES))
    single = lists.select("*", F.posexplode_outer("scope_ids").alias("__at", "scope_id"))
    single = single.withColumn("__at", F.floor(F.col("__at") / SCOPES_PER_ROW))
    if groups is None:
        named = single.withColumns({"scope_group": F.lit(None).cast("long"), "scope_group_name": F.lit(None).cast("string")})
    else:
        names = groups.selectExpr(
            *_in(groups, shared), f"id AS {_KEY}", "id AS scope_group", "name AS scope_group_name"
        )
        named = skew_join(single, names, "scope_id", _KEY, "left", "resource_id", lead)
    scope = _scope(*(F.col(c) for c in ("scope_id", "scope_group", "scope_group_name")))
    listed = named.groupBy(*lead, F.col("resource_id").alias(_KEY), "scope_ids", _SCOPE_COPIES, "__at").agg(
        F.collect_list(scope).alias("__scopes")
    )
    return listed.where(F.col(_KEY).isNotNull()).drop("__at")


def _groups(
    tables: Mapping[str, DataFrame], findings: DataFrame, shared: Sequence[str]
) -> DataFrame:
    df = tables.get("aggregation_groups")
    if df is None:
        df = findings.sparkSession.createDataFrame([], schema_of("aggregation_groups"))
    return df.selectExpr(
        *_in(df, shared),
        f"id AS {_KEY}",
        *_renamed(df, "aggregation_groups", VIEW_COLUMNS["aggregation_groups"]),
    )


def _scores(
    tables: Mapping[str, DataFrame], shared: Sequence[str], rule_scope: bool = False
) -> DataFrame:
    """Scores; rows count once per scoring rule and selection rule behind them."""
    df = tables["findings_scores"]
    columns = VIEW_COLUMNS["findings_scores"] + SUMMARY_COLUMNS["findings_scores"]
    scores = df.selectExpr(
        *_in(df, shared),
        f"finding_id AS {_KEY}",
        *_renamed(df, "findings_scores", columns),
        "scoring_rule_id",
    )
    rules = tables.get("scoring_rules")
    if rules is None:
        return scores.drop("scoring_rule_id")
    lead, scope = _in(rules, shared), ["rule_scope_group"] if rule_scope else []
    selected = tables.get("selection_rules")
    copies = F.lit(1)
    if selected is not None:
        renamed = selected.withColumnRenamed("scope_group", "rule_scope_group")
        by_id = renamed.groupBy(*_in(selected, shared), "id", *scope).agg(F.count(F.lit(1)).alias(COPIES))
        rules = skew_join(
            rules.select(*lead, "id", "selection_rule_id"),
            by_id if rule_scope else _repeated_only(by_id),
            "selection_rule_id", "id", "left", "id", shared=lead,
        )
        copies = F.coalesce(F.col(COPIES), F.lit(1))
    elif rule_scope:
        rules = rules.withColumn("rule_scope_group", F.lit(None).cast("long"))
    per_rule = rules.where(F.col("id").isNotNull()).groupBy(*lead, "id", *scope)
    counted = per_rule.agg(F.sum(copies).cast("long").alias(COPIES))
    return skew_join(
        scores, counted if rule_scope else _repeated_only(counted),
        "scoring_rule_id", "id", "left", _KEY, shared=_in(df, shared),
    ).drop("scoring_rule_id")


def _status(tables: Mapping[str, DataFrame], shared: Sequence[str]) -> DataFrame:
    df, statuses = tables["user_status"], tables["statuses"]
    columns = VIEW_COLUMNS["user_status"] + SUMMARY_COLUMNS["user_status"]
    user_status = df.selectExpr(
        *_in(df, shared), f"id AS {_KEY}", *_renamed(df, "user_status", columns)
    )
    named = statuses.selectExpr(
        *_in(statuses, shared),
        "key AS __status",
        "key AS status_key",
        "category",
        "category AS status_category",
    )
    return skew_join(
        user_status, named, "actual_status_key", "__status", "inner", _KEY, shared=_in(df, shared)
    )


def _presence(
    tables: Mapping[str, DataFrame], table: str, key: str, shared: Sequence[str]
) -> DataFrame | None:
    df = tables.get(table)
    if df is None:
        return None
    counted = copies_by_key(df, key, shared=shared).withColumnRenamed(key, _KEY)
    return counted.withColumn(view_name_of(table, key), F.col(_KEY))


def _additional_data(tables: Mapping[str, DataFrame], shared: Sequence[str]) -> DataFrame | None:
    """First CVE per row; rows of a finding that agree on it are counted together."""
    df = tables.get("findings_additional_data")
    if df is None:
        return None
    return (
        df.where(F.col("finding_id").isNotNull())
        .groupBy(*_in(df, shared), F.col("finding_id").alias(_KEY), first_element("cve").alias("cve"))
        .agg(F.count(F.lit(1)).alias(COPIES))
        .withColumn("additional_data_id", F.col(_KEY))
    )


def _ticket_copies(tables: Mapping[str, DataFrame], shared: Sequence[str]) -> DataFrame | None:
    links, tickets = tables.get("finding_ticket_associations"), tables.get("tickets")
    if links is None:
        return None
    lead = _in(links, shared)
    copies = F.lit(1)
    if tickets is not None:
        repeated = _repeated_only(copies_by_key(tickets, "id", shared=shared))
        links = links.select(*lead, "finding_id", "ticket_id").where(F.col("finding_id").isNotNull())
        links = skew_join(links, repeated, "ticket_id", "id", "left", "finding_id", shared=lead)
        copies = F.coalesce(F.col(COPIES), F.lit(1))
    per_finding = copies_by_key(links, "finding_id", copies, shared)
    return per_finding.withColumnRenamed("finding_id", _KEY)


def _user_sla_copies(tables: Mapping[str, DataFrame], shared: Sequence[str]) -> DataFrame | None:
    df = tables.get("user_sla")
    if df is None:
        return None
    return _repeated_only(copies_by_key(df, "id", shared=shared)).withColumnRenamed("id", _KEY)


def _repeated_only(copies: DataFrame) -> DataFrame:
    """Keys met once leave rows as they are; where no key repeats, nothing is left to join."""
    return copies.where(F.col(COPIES) > 1)
