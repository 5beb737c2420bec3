"""Check queries: every operator of the library over the test tables.

Each takes ``(spark, sf_dir)`` and reads whole tables. ``checks.oracle`` states most of
them in SQL under the same names. Lists leave as sorted, joined text, so that results
compare as values.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from contextlib import suppress
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import (
    excluder,
    finding_tables,
    placed_orders,
    published_groups,
    source,
    with_package_groups,
)
from rulefold.functions.identity import group_key, run_identifier
from rulefold.functions.predicates import compile_filter
from rulefold.operators.assign import GROUP_KEY, assign_rules, with_table_structs
from rulefold.operators.base_view import (
    base_findings,
    existing_group_filter,
    first_element,
    older_view,
    packaged_findings,
)
from rulefold.operators.digests import range_difference
from rulefold.operators.exclusions import exclude_findings
from rulefold.operators.existing import change_plan, match_existing_groups, ungrouped_findings, ungrouped_pages
from rulefold.operators.groups import (
    claimed_ids,
    create_groups,
    group_findings,
    group_pages,
    rollup,
    unclaimed,
    united_rollups,
)
from rulefold.operators.quality import (
    association_difference,
    count_mismatches,
    run_report,
    run_totals,
    schema_differences,
    unmatched_findings,
)
from rulefold.operators.skew import COPIES, materialize, shared_folder, skew_join
from rulefold.operators.summaries import FIRST_OPEN_OR_MODE, summarize
from rulefold.plans.incremental import run_incrementally
from rulefold.plans.runs import candidate_groups, export_updates, publish_files, publish_version
from rulefold.schemas import ASSOCIATION_TABLE, ROLLUP_TABLE, id_column, schema_of
from rulefold.sources.ingest import TableImport, id_ranges, import_findings, import_plan
from rulefold.sources.resume import Ledger, resume_import
from rulefold.sources.rules import Rule, load_rules, parse_rules
from rulefold.sources.tables import FrameSource
from rulefold.sources.versions import StaleRun, VersionedTables

Query = Callable[[SparkSession, str], DataFrame]
IDS = ["group_identifier", "group_identifier_readable"]


def narrow_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings with the few columns simple rules need, one row each."""
    return placed_orders(spark, sf_dir).selectExpr(
        "o_orderkey AS finding_id",
        "nullif(o_orderpriority, '4-NOT SPECIFIED') AS package_name",
        "o_orderstatus AS source",
        "c_mktsegment AS resource_type",
        "n_regionkey AS tenant",
        "CASE WHEN o_custkey % 10 <> 0 THEN n_name END AS cloud_account",
    )


def base(spark: SparkSession, sf_dir: str, weighted: bool = False, summary: bool = False) -> DataFrame:
    return base_findings(finding_tables(spark, sf_dir), weighted=weighted, summary=summary)


def leaf(field: str, condition: str, value) -> dict:
    return {"field": field, "condition": condition, "value": value}


def both(*operands) -> dict:
    return {"operator": "and", "operands": list(operands)}


def either(*operands) -> dict:
    return {"operator": "or", "operands": list(operands)}


# A rule list over ``narrow_findings``; the second rule has no group-by and takes nothing.
RULES = parse_rules(
    json.dumps(
        [
            {
                "group_by": ["findings.package_name"],
                "filters_config": {
                    "filtersid": None,
                    "scope_group": 1,
                    "filtersjson": both(
                        leaf("source", "in", ["F"]), leaf("resource_type", "equals", "BUILDING")
                    ),
                },
            },
            {"filters_config": {"source": "O"}},
            {
                "group_by": ["findings.package_name", "plain_resources.cloud_account"],
                "filters_config": {"source": ["O"]},
            },
            {
                "group_by": ["cloud_account"],
                "filters_config": {"filtersjson": json.dumps(leaf("source", "not_equals", "P"))},
            },
            {"group_by": ["source"], "filters_config": {"resource_type": "NOTHING"}},
            {
                "group_by": ["resource_type"],
                "filters_config": {"scopesjson": leaf("cloud_account", "exists", "False")},
            },
        ]
    )
)

# A rule list over the base view whose rules tell rows of one finding apart.
FANOUT_RULES = [
    Rule(
        1,
        10,
        ("findings.package_name", "scope_group_name"),
        {"scope_group": 3, "filtersjson": leaf("cve", "exists", "True")},
    ),
    Rule(
        2,
        20,
        ("package_name", "cloud_account"),
        {"source": ["O"], "filtersjson": leaf("finding_type", "in", ["Cloud Posture"])},
    ),
    Rule(3, 30, ("rule_family", "findings.rule_id"), {"filtersjson": leaf("scope_id", "exists", "no")}),
    Rule(
        4,
        40,
        ("cloud_provider",),
        {
            "filtersjson": both(
                {"field": "actual_status", "condition": "", "value": leaf("category", "in", ["OPEN", "FIXED"])}
            )
        },
    ),
]


_GROUPINGS = [("package_name",), ("package_name", "cloud_account"), ("rule_id",), ("cloud_provider", "source")]


def many_rules(count: int = 200) -> list[Rule]:
    """Rules of four kinds over the base view, most of which ask for a value; every fortieth
    asks for none, so that no index finds it."""
    rules = []
    for n in range(count):
        severity = [n % 5, (n + 2) % 5]
        if n % 40 == 39:
            filters = {"filtersjson": both(leaf("cve", "contains", f"-{n % 50}"), leaf("fix_type", "exists", "false"))}
        elif n % 4 == 0:
            family = ["Malware", "Exposure", "Misconfiguration"][n % 3]
            filters = {"scope_group": 2 + n % 24, "filtersjson": both(leaf("severity", "in", severity), leaf("rule_family", "equals", family))}
        elif n % 4 == 1:
            one = either(leaf("rule_id", "equals", f"rule-{n % 17}"), leaf("fix_id", "in", [f"KB{n % 29}", f"KB{n % 7}"]))
            filters = {"filtersjson": json.dumps(both(one, leaf("severity", "equals", str(n % 5)), leaf("cve", "exists", "True")))}
        elif n % 4 == 2:
            region = ["asia", "EUROPE", "Africa"][n % 3]
            tagged = leaf("tags_key_values", "overlapilikelist", [f"region:{region}", "segment:none"])
            filters = {"scopesjson": tagged, "filtersjson": both(leaf("fix_id", "in", [f"KB{n % 29}"]), leaf("rule_id", "not_in", ["rule-3"]))}
        else:
            filters = {"severity": severity, "fix_id": f"KB{n % 29}", "filtersjson": leaf("tags_values", "overlap", ["BUILDING", "ASIA"])}
        rules.append(Rule(n, n, _GROUPINGS[n % 4], filters))
    return rules


def listed(rolled: DataFrame) -> DataFrame:
    """A rollup with its lists as sorted text."""
    return rolled.select(
        *IDS,
        F.array_join(F.array_sort(F.col("finding_ids").cast("array<string>")), ",").alias("finding_ids"),
        F.array_join(F.array_sort("cloud_accounts"), ",").alias("cloud_accounts"),
        "findings_count",
        "rule_number",
    )


def counted(rows: DataFrame) -> DataFrame:
    """Findings and scopes with the number of rows of the view they stand for."""
    return rows.groupBy("finding_id", "scope_id").agg(F.sum(COPIES).alias(COPIES))


def predicate(config: Mapping, field_map: Mapping[str, str] | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = base(spark, sf_dir, weighted=True)
        return counted(rows.where(compile_filter(rows, config, field_map)))

    return query


def summary(only: list[str], by: str = "cloud_account") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = base(spark, sf_dir, weighted=True, summary=True)
        result = summarize(rows, [by], only=only).withColumnRenamed(f"group_{by}", by)
        if "vulnerability_reported_date" in only:
            text = F.col("vulnerability_reported_date").cast("string")
            result = result.withColumn("vulnerability_reported_date", text)
        return result

    return query


def grouped(rules: list[Rule], fanout: str = "rows") -> Query:
    """The rollup of a rule run, over the narrow findings or the base view."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return listed(_run(spark, sf_dir, rules, fanout, lists=True).rollup)

    return query


def _run(spark: SparkSession, sf_dir: str, rules: list[Rule], fanout: str = "rows", **options):
    if rules is RULES:
        return group_findings(narrow_findings(spark, sf_dir), rules, fanout=fanout, unique_ids=True, **options)
    return group_findings(base(spark, sf_dir, weighted=True), rules, fanout=fanout, **options)


def _fanout_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_rules(base(spark, sf_dir, weighted=True), FANOUT_RULES)


def base_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted view: distinct rows with the number of copies each stands for."""
    rows = base(spark, sf_dir, weighted=True)
    return rows.select(
        "finding_id", "scope_id", "scope_group_name", "cve", "existing_group_id",
        "sla_connection_id", "findings_info_id", COPIES,
    )


def base_view_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(base(spark, sf_dir))


def as_text(df: DataFrame) -> DataFrame:
    """Arrays as joined text."""
    arrays = [name for name, kind in df.dtypes if kind.startswith("array")]
    return df.withColumns({a: F.array_join(F.col(a).cast("array<string>"), ",") for a in arrays})


def older(form: str) -> Query:
    return lambda spark, sf_dir: as_text(older_view(finding_tables(spark, sf_dir), form))


def findings_only_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = packaged_findings(finding_tables(spark, sf_dir)["findings"])
    return findings.select("finding_id", "package_name", "finding_type", "rule_id", "category", "created_time")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by package with their ungrouped findings, next to the stored groups."""
    tables = finding_tables(spark, sf_dir)
    tables["aggregation_groups"] = with_package_groups(tables["aggregation_groups"], tables["findings"])
    groups = candidate_groups(
        tables, "findings.package_name", 1, rule_id=102, stamp="2031/02/03T04/05/06.789Z", lists=True
    )
    ids = F.array_sort(F.col("finding_ids_without_group").cast("array<string>"))
    return groups.withColumn("finding_ids_without_group", F.array_join(ids, ","))


def first_array_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = finding_tables(spark, sf_dir)["findings_additional_data"]
    return data.select(
        "finding_id", first_element("cve").alias("cve"), F.size("cve").cast("long").alias("cves")
    )


def with_existing_group(tables: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """Findings with the group they name, where it exists."""
    findings = tables["findings"].select(F.col("id").alias("finding_id"), "aggregation_group_id", *columns)
    groups = tables["aggregation_groups"].select(
        F.col("id").alias("group"), F.col("id").alias("existing_group_id"), "main_finding_id"
    )
    return skew_join(findings, groups, "aggregation_group_id", "group", "left", "finding_id")


def existing_groups_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = existing_group_filter(
        F.col("finding_id"), F.col("aggregation_group_id"), F.col("main_finding_id")
    )
    rows = with_existing_group(finding_tables(spark, sf_dir)).where(kept)
    return rows.select("finding_id", "main_finding_id")


def id_range_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows each batch of an import would read, for a sixteenth of the ids per batch."""
    tables = FrameSource({"lineitem": source(spark, sf_dir, "lineitem")})
    low, high = tables.id_bounds(spark, "lineitem", "l_orderkey")
    batches = [
        tables.read_ids(spark, "lineitem", "l_orderkey", ids.low, ids.high, 1)
        .select(
            F.lit(number).alias("batch"),
            F.lit(ids.low).cast("long").alias("low_id"),
            F.lit(ids.high).cast("long").alias("high_id"),
        )
        .groupBy("batch", "low_id", "high_id")
        .agg(F.count(F.lit(1)).alias("table_rows"))
        for number, ids in enumerate(id_ranges((low, high), (high - low) // 16 + 1))
    ]
    union = batches[0]
    for batch in batches[1:]:
        union = union.unionByName(batch)
    return union


def pred_sql_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL form of a rule's filter, over table-qualified names."""
    rows = with_table_structs(base(spark, sf_dir, weighted=True, summary=True))
    text = (
        "findings.source = 'O' and findings.category = 'Cloud Security'"
        " and (not findings.rule_id like '%rule-1%') and findings_additional_data.cve[1] is not null"
        " and statuses.category = 'OPEN'"
    )
    return counted(rows.where(F.expr(text)))


def group_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = narrow_findings(spark, sf_dir).where("package_name IS NOT NULL")
    return listed(create_groups(rows, ["findings.package_name"], unique_ids=True, lists=True).rollup)


def group_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = narrow_findings(spark, sf_dir)
    return listed(create_groups(rows, ["package_name", "cloud_account"], 1, unique_ids=True, lists=True).rollup)


def group_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = narrow_findings(spark, sf_dir)
    groups = create_groups(rows, ["cloud_account"], unique_ids=True, reuse=False)
    return groups.rollup.select(*IDS, "findings_count")


def association(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = narrow_findings(spark, sf_dir)
    groups = create_groups(rows, ["package_name", "cloud_account"], 1, unique_ids=True, reuse=False)
    return groups.association


def exclusive_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, FANOUT_RULES).association


def indexed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hundred rules over the base view, each row tested against those its values lead to."""
    run = group_findings(base(spark, sf_dir, weighted=True), many_rules(), index=True)
    return run.rollup.select(*IDS, "findings_count", "rule_number")


def rule_without_group_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = assign_rules(narrow_findings(spark, sf_dir), RULES, unique_ids=True)
    return assigned.groupBy("rule_number").agg(F.count(F.lit(1)).alias("findings"))


def rollup_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups of rules with different group columns, united by name."""
    rules = [
        Rule(1, 1, ("package_name",), {"source": ["F"]}),
        Rule(2, 2, ("cloud_account",), {"filtersjson": leaf("source", "not_equals", "F")}),
    ]
    assigned = assign_rules(narrow_findings(spark, sf_dir), rules, unique_ids=True)
    return united_rollups(
        {("package_name",): assigned.where("rule_number = 0"), ("cloud_account",): assigned.where("rule_number = 1")}
    )


RULE_SUMMARIES = ["sub_category", "package_name", "max_score", "created_time", "open_user_status_key", "original_status"]


def rollup_rule_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of the groups that rules form."""
    rows = base(spark, sf_dir, weighted=True, summary=True)
    run = group_findings(rows, FANOUT_RULES, summaries=RULE_SUMMARIES)
    return run.rollup.select(*IDS, "findings_count", "rule_number", *RULE_SUMMARIES)


def tenant_rule_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants with rules of their own: two of them share one list, one has none."""
    rules = {0: RULES, 1: RULES, 2: [Rule(7, 1, ("source",))], 3: [Rule(8, 1, ("package_name",), {"source": ["O"]})]}
    assigned = assign_rules(narrow_findings(spark, sf_dir), rules, tenant="tenant")
    counts = rollup(assigned, tenant="tenant")
    return counts.drop("finding_ids", "cloud_accounts")


class RangedSource(FrameSource):
    """Frames read range by range, as a database is."""

    reads_by_range = True


def _imported(
    spark: SparkSession, tables: Mapping[str, DataFrame], plan: list[TableImport], keys: Mapping[str, str],
    max_id: int | None = None, kept: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows and ids by table, read back after an import; ids are NULL where any column differs.

    All columns are compared by a sum of row hashes with the source, or with those of its rows
    that ``kept`` names a condition for.
    """
    prefix = f"imported_{uuid.uuid4().hex}_"
    import_findings(spark, RangedSource(tables), prefix, plan, max_id)

    def totals(df: DataFrame, columns: list[str], *also: Column) -> DataFrame:
        hashes = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        return df.select(F.count(F.lit(1)).alias("table_rows"), F.coalesce(hashes, F.lit(0)).alias("hashes"), *also)

    parts = []
    for name, key in keys.items():
        source_rows = tables[name].where((kept or {}).get(name, "true"))
        back = totals(spark.table(prefix + name), source_rows.columns, F.sum(key).alias("ids"))
        want = totals(source_rows, source_rows.columns)
        same = (back["hashes"] == want["hashes"]) & (back["table_rows"] == want["table_rows"])
        ids = F.when(same, F.col("ids")).alias("ids")
        parts.append(back.crossJoin(want).select(F.lit(name).alias("table_name"), back["table_rows"], ids))
    return reduce(DataFrame.unionByName, parts)


def import_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables imported into the catalog, in ranges and whole, and read back: rows and ids."""
    tables = {n: df for n, df in finding_tables(spark, sf_dir).items() if n in ("findings", "findings_info", "statuses")}
    plan = [TableImport("findings", 4, 3_000), TableImport("findings_info", 4, None, 8), TableImport("statuses")]
    return _imported(spark, tables, plan, {"findings": "id", "findings_info": "id", "statuses": "key"})


def import_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An import capped at id 999: a large table, two that grow, with NULL keys in one, and an empty one."""
    tables = finding_tables(spark, sf_dir)
    tables["tickets"] = tables["tickets"].selectExpr("CASE WHEN id % 10 <> 4 THEN id END AS id", "id AS number")
    tables["user_status"] = tables["user_status"].where("id IS NULL")
    keys = {"findings": "id", "resource_to_scopes": "resource_id", "tickets": "number", "user_status": "id"}
    plan = [
        TableImport("findings", 4, 300), TableImport("resource_to_scopes", 4, 20_000, key="resource_id"),
        TableImport("tickets", 4, 10_000), TableImport("user_status", 4, 300, 8),
    ]
    return _imported(spark, {n: tables[n] for n in keys}, plan, keys, 999, {"findings": "id <= 999"})


def own_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def before_changes(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as they may have been before a run: rows added, gone and changed since."""
    old = dict(tables)
    old["findings"] = tables["findings"].where("id % 13 <> 0").withColumn("source", F.expr("IF(id % 17 = 3, 'P', source)"))
    old["findings"] = old["findings"].unionByName(old["findings"].where("id % 19 = 5").withColumn("id", F.expr("-id")))
    old["findings_additional_data"] = tables["findings_additional_data"].where("finding_id % 23 <> 1")
    old["plain_resources"] = tables["plain_resources"].withColumn("cloud_account", F.expr("IF(id % 37 = 2, 'moved', cloud_account)"))
    old["resource_to_scopes"] = tables["resource_to_scopes"].where("resource_id % 41 <> 7")
    old["scope_groups"] = tables["scope_groups"].withColumn("name", F.expr("IF(id = 3, 'old name', name)"))
    old["tickets"] = tables["tickets"].where("id % 43 <> 0")
    old["findings_scores"] = tables["findings_scores"].where("finding_id % 29 <> 4")
    return old


def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run over earlier tables, then a run over what changed: the groups of a full run."""
    tables, folder = finding_tables(spark, sf_dir), own_folder(spark, "incremental")
    run_incrementally(spark, before_changes(tables), FANOUT_RULES, folder)
    run = run_incrementally(spark, tables, FANOUT_RULES, folder)
    assert not run.full
    return run.grouping.rollup.select(*IDS, "findings_count", "rule_number")


def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of both outputs, published around a run that fails halfway and one that is
    refused: groups with their rows in the association of the same version."""
    store = VersionedTables(spark, own_folder(spark, "versions"))
    rows = narrow_findings(spark, sf_dir)
    publish_version(store, group_findings(rows, RULES[:3], unique_ids=True))
    late, failed = store.begin(), store.begin()
    run = group_findings(rows, RULES, unique_ids=True)
    failed.write(ASSOCIATION_TABLE, run.association.limit(0))  # and no more: nothing is committed
    publish_version(store, run)
    with suppress(StaleRun):
        store.commit(late)
        raise AssertionError("a run from an older version was committed")
    parts = []
    for number in (1, 2):
        tables = store.read(ROLLUP_TABLE, ASSOCIATION_TABLE, number=number)
        held = tables[ASSOCIATION_TABLE].groupBy(*IDS).agg(F.count(F.lit(1)).alias("association_rows"))
        parts.append(tables[ROLLUP_TABLE].join(held, IDS).select(F.lit(number).alias("version"), *IDS, "findings_count", "association_rows"))
    return parts[0].unionByName(parts[1])


def import_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole plan of an import: every table it names, in ranges where it says so."""
    tables = finding_tables(spark, sf_dir) | {"aggregation_rules": nation_rules(spark, sf_dir)}
    plan = import_plan(ids_per_batch=40_000_000, connections=4)
    keys = {s.table: s.key or id_column(s.table) for s in plan}
    keys |= {"statuses": "key", "aggregation_rules": "id"}
    return _imported(spark, tables, plan, keys)


class InterruptedSource(RangedSource):
    """A source that breaks off after some reads of ranges."""

    def read_ids(self, spark, table, id_column, low, high, connections):
        self.left[0] -= 1
        if self.left[0] < 0:
            raise ConnectionError("the connection was lost")
        return super().read_ids(spark, table, id_column, low, high, connections)


def import_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An import that stops within its second table and goes on later: rows and ids."""
    tables = {n: df for n, df in finding_tables(spark, sf_dir).items() if n in ("findings", "plain_resources", "statuses")}
    sizes = {}
    for name in ("findings", "plain_resources"):  # four ranges each
        low, high = FrameSource(tables).id_bounds(spark, name, "id")
        sizes[name] = (high - low) // 4 + 1
    plan = [*(TableImport(name, 4, size) for name, size in sizes.items()), TableImport("statuses")]
    folder, source_tables = own_folder(spark, "import"), InterruptedSource(tables)
    object.__setattr__(source_tables, "left", [5])
    with suppress(ConnectionError):
        resume_import(spark, source_tables, plan, folder)
        raise AssertionError("the import was not interrupted")
    resume_import(spark, RangedSource(tables), plan, folder)
    if any(resume_import(spark, RangedSource(tables), plan, folder).values()):
        raise AssertionError("a finished part was read again")
    ledger = Ledger(spark, folder)
    parts = []
    for name, key in (("findings", "id"), ("plain_resources", "id"), ("statuses", "key")):
        back = ledger.read(name).agg(F.count(F.lit(1)).alias("table_rows"), F.sum(key).alias("ids"))
        parts.append(back.select(F.lit(name).alias("table_name"), "table_rows", "ids"))
    return reduce(DataFrame.unionByName, parts)


def import_equal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An import in 16 batches of equal rows, of findings whose ids leave nine tenths of their
    range empty: rows and ids read back, and whether no batch has over 1.5 times the mean."""
    findings = finding_tables(spark, sf_dir)["findings"]
    low, high = FrameSource({"findings": findings}).id_bounds(spark, "findings", "id")
    moved = F.when(F.col("id") > (low + high) // 2, F.col("id") + 9 * (high - low)).otherwise(F.col("id"))
    tables = {"findings": findings.withColumn("id", moved)}
    plan, folder = [TableImport("findings", 4, rows_per_batch=-(-findings.count() // 16))], own_folder(spark, "equal")
    resume_import(spark, RangedSource(tables), plan, folder)
    ledger = Ledger(spark, folder)
    counts = [
        spark.read.parquet(f"{folder}/findings/{part}").agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))
        for part in ledger.planned("findings")
    ]
    parts = reduce(DataFrame.unionByName, counts)
    even = F.max("rows") <= 1.5 * F.avg("rows")
    return parts.agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("table_rows"), F.sum("ids").alias("ids"), even.alias("even"))


def nation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of rules, one per nation; those of one region are of another type."""
    definition = (
        "concat('{\"group_by\": [\"findings.package_name\"], \"filters_config\": {\"cloud_account\": \"', n_name, '\"}}')"
    )
    return source(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS id", "100 - n_nationkey AS `order`", "IF(n_regionkey = 2, 'OTHER', 'AGG') AS type", f"{definition} AS aggregation_query",
        "n_nationkey % 5 = 1 AS disabled", "false AS is_deleted",
    )


def rules_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules read from their table: the grouping ones that are active, in their order."""
    rules = load_rules(nation_rules(spark, sf_dir), active_only=True)
    run = group_findings(narrow_findings(spark, sf_dir), rules, unique_ids=True, reuse=False)
    return run.rollup.select(*IDS, "findings_count", "rule_number")


def exported_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change plan exported to files, one folder per kind of change, and read back."""
    folder = own_folder(spark, "updates")
    export_updates(plan_changes(spark, sf_dir), folder)
    return spark.read.parquet(folder)


def output_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of a run against their declared columns, with their rows."""
    run = _run(spark, sf_dir, FANOUT_RULES)
    parts = []
    for name, df in ((ASSOCIATION_TABLE, run.association), (ROLLUP_TABLE, run.rollup)):
        wrong = schema_differences(df, schema_of(name))
        columns = [F.lit(",".join(v)).alias(k) for k, v in wrong.items()]
        parts.append(df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(name).alias("table_name"), *columns, "table_rows"))
    return parts[0].unionByName(parts[1])


def planted_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose association lost rows, got some twice, or is gone."""
    run = create_groups(narrow_findings(spark, sf_dir), ["package_name", "cloud_account"], unique_ids=True)
    lost = run.association.where("finding_id % 701 <> 3 AND group_identifier_readable <> 'null_null'")
    wrong = lost.unionByName(lost.where("finding_id % 907 = 5"))
    return count_mismatches(run.rollup, wrong)


def publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over tenants, published as files and read back."""
    run = group_findings(narrow_findings(spark, sf_dir), RULES, tenant="tenant")
    folder = own_folder(spark, "published")
    publish_files(run, folder, tenant="tenant")
    back = spark.read.parquet(f"{folder}/{ROLLUP_TABLE}")
    return back.select("tenant", *IDS, "findings_count", "rule_number")


def claimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claimed_ids(assign_rules(narrow_findings(spark, sf_dir), RULES, unique_ids=True))


def unclaimed_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = narrow_findings(spark, sf_dir)
    taken = claimed_ids(assign_rules(rows, RULES, unique_ids=True))
    return unclaimed(rows, taken).select("finding_id", "source")


def association_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = narrow_findings(spark, sf_dir)

    def one(other: str) -> DataFrame:
        kept = rows.where(F.col("source") != other)
        return create_groups(kept, ["package_name"], unique_ids=True, reuse=False).association

    return association_difference(one("P"), one("F"))


def association_diff_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An association against one that lost some rows, has others twice and holds foreign ones:
    compared by digests of ranges, with multiplicities."""
    rows = create_groups(narrow_findings(spark, sf_dir), ["package_name", "cloud_account"], unique_ids=True, reuse=False).association
    kept = rows.where("finding_id % 2003 <> 7")
    foreign = rows.where("finding_id % 1009 = 3").withColumn("finding_id", F.expr("-finding_id"))
    other = kept.unionByName(rows.where("finding_id % 1511 = 2")).unionByName(foreign)
    return range_difference(materialize(rows), materialize(other), distinct=False)


def group_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of each group of a run in pages of 50 ids, as often as they occur."""
    pages = group_pages(_fanout_assigned(spark, sf_dir), 50)
    ids = F.array_join(F.col("finding_ids").cast("array<string>"), ",")
    accounts = F.array_join("cloud_accounts", ",", "null")
    return pages.select(*IDS, "rule_number", "page", ids.alias("finding_ids"), accounts.alias("cloud_accounts"))


def ungrouped_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in no existing group, by rule, in pages of 20 ids."""
    rows = with_existing_group(finding_tables(spark, sf_dir), "rule_id")
    pages = ungrouped_pages(rows, ["rule_id"], "existing_group_id", 20)
    ids = F.array_join(F.col("finding_ids_without_group").cast("array<string>"), ",")
    return pages.select("rule_id", "page", ids.alias("finding_ids_without_group"))


def excluder_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = finding_tables(spark, sf_dir)
    findings = tables["findings"].select(F.col("id").alias("finding_id"), "source")
    return exclude_findings(findings, tables["aggregation_rules_findings_excluder"], 102)


def rules_with_excluder(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [Rule(101, 1, ("source",), {"source": ["F", "O"]}), Rule(102, 2, ("cloud_account",))]
    barred = excluder(source(spark, sf_dir, "orders"))
    assigned = assign_rules(narrow_findings(spark, sf_dir), rules, unique_ids=True, excluder=barred)
    return assigned.groupBy("rule_number", F.col(GROUP_KEY)[0].alias("group_name")).agg(
        F.count(F.lit(1)).alias("findings")
    )


def _computed_and_published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    groups = create_groups(
        narrow_findings(spark, sf_dir), ["source", "cloud_account"], unique_ids=True, reuse=False
    )
    return groups.rollup, published_groups(placed_orders(spark, sf_dir))


def match_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    computed, existing = _computed_and_published(spark, sf_dir)
    matched = match_existing_groups(computed, existing)
    return matched.select("group_identifier", "findings_count", "group_id", "main_finding_id")


def plan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_plan(*_computed_and_published(spark, sf_dir))


def ungrouped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_existing_group(finding_tables(spark, sf_dir), "rule_id")
    lists = ungrouped_findings(rows, ["rule_id"], "existing_group_id", lists=True)
    ids = F.array_sort(F.col("finding_ids_without_group").cast("array<string>"))
    return lists.select("rule_id", F.array_join(ids, ",").alias("finding_ids_without_group"))


def ungrouped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as rows: a group's findings that are in no group, or one NULL."""
    rows = with_existing_group(finding_tables(spark, sf_dir), "rule_id")
    return ungrouped_findings(rows, ["rule_id"], "existing_group_id", every_group=True)


def run_stamped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = group_key(["package_name"])
    number = F.lit(1)
    stamped = run_identifier(number, key, ["findings.package_name"], "2031/02/03T04/05/06.789Z")
    rows = narrow_findings(spark, sf_dir).where("package_name IS NOT NULL").select("package_name").distinct()
    return rows.select(
        F.md5(F.concat_ws("-", number.cast("string"), "package_name")).alias("calculated_group_identifier"),
        stamped.alias("calculated_finding_id"),
    )


def consistency_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups per rule, and how many of them disagree with the association."""
    run = _run(spark, sf_dir, FANOUT_RULES)
    wrong = count_mismatches(run.rollup, run.association).select(
        "group_identifier", "expected_count", F.lit(1).alias("wrong")
    )
    checked = run.rollup.join(
        wrong.distinct(),
        (run.rollup["group_identifier"] == wrong["group_identifier"])
        & (F.col("findings_count") == F.col("expected_count")),
        "left",
    )
    return checked.groupBy("rule_number").agg(
        F.count(F.lit(1)).alias("groups_checked"), F.count("wrong").alias("groups_mismatched")
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(_fanout_assigned(spark, sf_dir))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(rollup(_fanout_assigned(spark, sf_dir)))


def tenant_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = group_findings(
        narrow_findings(spark, sf_dir), RULES, tenant="tenant", reuse=False
    )
    return groups.rollup.drop("finding_ids", "cloud_accounts")


def exact_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = create_groups(
        narrow_findings(spark, sf_dir), ["package_name", "cloud_account"],
        unique_ids=True, reuse=False, id_style="exact",
    )
    return groups.rollup.select("group_identifier", "findings_count")


def empty_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [Rule(1, 1, ("package_name",), {"source": ["none"]})]
    return group_findings(narrow_findings(spark, sf_dir), rules, unique_ids=True, reuse=False).association


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest groups."""
    rows = narrow_findings(spark, sf_dir).where("package_name IS NOT NULL")
    groups = create_groups(rows, ["package_name"], unique_ids=True, reuse=False)
    ranked = groups.rollup.orderBy(F.desc("findings_count"), IDS[1]).limit(3)
    return ranked.select(*IDS, "findings_count")


PREDICATES: dict[str, Query] = {
    "pred_in": predicate({"filtersjson": leaf("source", "in", ["F", "O"])}),
    "pred_not_in": predicate({"filtersjson": leaf("rule_family", "not_in", ["Malware", "Exposure"])}),
    "pred_exists": predicate({"filtersjson": leaf("cve", "exists", "True")}),
    "pred_not_exists": predicate({"filtersjson": leaf("cve", "exists", False)}),
    "pred_equals": predicate({"filtersjson": leaf("severity", "equals", "3")}),
    "pred_not_equals": predicate({"filtersjson": leaf("fix_type", "not_equals", "Patch")}),
    "pred_contains": predicate({"filtersjson": leaf("rule_family", "contains", "s_ac")}),
    "pred_not_contains": predicate({"filtersjson": leaf("findings.rule_id", "not_contains", "-1")}),
    "pred_overlap": predicate({"scopesjson": leaf("tags_values", "overlap", ["ASIA", "BUILDING"])}),
    "pred_not_overlap": predicate(
        {"scopesjson": leaf("tags_key_values", "notoverlapping", ["Region:ASIA", "Segment:BUILDING"])}
    ),
    "pred_ioverlap": predicate(
        {"scopesjson": leaf("tags_key_values", "overlapilikelist", ["REGION:asia", "region:europe"])}
    ),
    "pred_not_ioverlap": predicate(
        {"scopesjson": leaf("tags_key_values", "notoverlapilikelist", ["REGION:asia"])}
    ),
    "pred_and_or_nested": predicate(
        both(
            either(
                leaf("source", "equals", "F"),
                both(leaf("severity", "in", [1, 2]), leaf("rule_family", "in", ["Malware"])),
            ),
            leaf("resource_type", "not_equals", "BUILDING"),
        )
    ),
    "pred_nested_value": predicate(
        {
            "filtersjson": both(
                {"field": "actual_status", "condition": "", "value": leaf("category", "in", ["OPEN"])},
                leaf("fix_subtype", "in", ["Security Updates"]),
                leaf("source", "", "ignored"),
            )
        }
    ),
    "pred_json_string_operand": predicate(
        {
            "filtersjson": json.dumps(leaf("source", "equals", "O")),
            "scopesjson": both(json.dumps(leaf("cloud_provider", "in", ["ASIA", "EUROPE"]))),
        }
    ),
    "pred_scalar_and_list_fields": predicate(
        {"scope_group": 7, "source": ["O", "P"], "severity": "2", "rule_family": None, "fix_type": "", "cve": []}
    ),
    "pred_scope_group_default": predicate(
        {"scope_group": 1, "filtersid": 17, "scopesjson": {}, "filtersjson": "None", "source": ["P"]}
    ),
    "pred_custom_sql": predicate({"custom_sql": "severity * 2 > 5", "source": "O"}),
    "pred_sql_filter": pred_sql_filter,
    "pred_checked_sql": predicate(
        {"custom_sql": "CASE WHEN severity BETWEEN 2 AND 3 THEN lower(source) IN ('o', 'p') ELSE NOT (rule_id LIKE '%-1%' OR coalesce(fix_type, '') = 'Patch') END"}
    ),
    "pred_dropped_conditions": predicate(
        {"filtersjson": both(leaf("source", "in", []), leaf("fix_type", "resembles", "x"), leaf("rule_id", "in", "rule-1"), leaf("severity", "in", [1, 4]))}
    ),
}

SUMMARIES: dict[str, Query] = {
    "rollup_first_open_or_mode": summary(FIRST_OPEN_OR_MODE),
    "rollup_mode": summary(["package_name"]),
    "rollup_max": summary(["fix_id", "max_score", "max_severity"]),
    "rollup_same_or_default": summary(
        ["image_id", "scan_id", "resource_reported_not_exist", "original_finding_id"], "main_resource_id"
    ),
    "rollup_times": summary(["last_reported_time", "discovered_time", "created_time", "main_resource_id"]),
    "rollup_status_keys": summary(
        [f"{p}_{k}_status_key" for p in ("open", "fixed", "ignored") for k in ("system", "user")]
    ),
    "rollup_closed_open_status": summary(
        ["min_closed_user_status", "min_open_user_status"], "main_resource_id"
    ),
    "rollup_open_scores": summary(
        [f"max_open_{f}" for f in ("score", "severity", "user_score", "normalized_score", "factorized_score")]
    ),
    "rollup_originals": summary(["original_score", "original_status"], "main_resource_id"),
    "rollup_flags": summary(
        ["cisa_kev", "vulncheck_kev", "is_fixable", "has_exploit", "vulnerability_reported_date"],
        "main_resource_id",
    ),
}


def queries() -> dict[str, Query]:
    return {
        "base_view": base_view,
        "base_view_fanout": base_view_fanout,
        "base_view_older": older("full"),
        "base_view_compact": older("compact"),
        "findings_only_view": findings_only_view,
        "candidate_groups": candidates,
        "first_array_element": first_array_element,
        "existing_group_filter": existing_groups_kept,
        "id_range_batches": id_range_batches,
        **PREDICATES,
        "group_single_key": group_single_key,
        "group_multi_key": group_multi_key,
        "group_null_key": group_null_key,
        "association": association,
        "exclusive_rules": grouped(RULES),
        "exclusive_rules_fanout": grouped(FANOUT_RULES),
        "exclusive_rules_distinct": grouped(FANOUT_RULES, "distinct"),
        "indexed_rules": indexed_rules,
        "rule_without_group_by": rule_without_group_by,
        "exclusive_association": exclusive_association,
        "rollup_union": rollup_union,
        "rollup_rule_summaries": rollup_rule_summaries,
        "tenant_rule_sets": tenant_rule_sets,
        "import_round_trip": import_round_trip,
        "import_capped": import_capped,
        "import_equal_rows": import_equal_rows,
        "association_diff_ranges": association_diff_ranges,
        "group_id_pages": group_id_pages,
        "ungrouped_id_pages": ungrouped_id_pages,
        "publish_round_trip": publish_round_trip,
        "publish_versions": publish_versions,
        "import_all": import_all,
        "import_resumed": import_resumed,
        "rules_from_table": rules_from_table,
        "exported_updates": exported_updates,
        "output_schemas": output_schemas,
        "planted_mismatches": planted_mismatches,
        "ungrouped_rows": ungrouped_rows,
        "incremental_run": incremental_run,
        "claimed_ids": claimed,
        "unclaimed_findings": unclaimed_findings,
        "association_diff": association_diff,
        **SUMMARIES,
        "excluder_anti_join": excluder_anti_join,
        "rules_with_excluder": rules_with_excluder,
        "match_existing_groups": match_groups,
        "ungrouped_ids": ungrouped_ids,
        "run_stamped_ids": run_stamped_ids,
        "change_plan": plan_changes,
        "consistency_check": consistency_check,
        "run_report": report,
        "run_totals": totals,
        "unmatched_findings": lambda spark, sf_dir: unmatched_findings(finding_tables(spark, sf_dir)),
        "tenant_runs": tenant_runs,
        "exact_identifiers": exact_identifiers,
        "empty_result": empty_result,
        "preview": preview,
    }
