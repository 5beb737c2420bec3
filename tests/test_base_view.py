"""The base view over small tables by hand."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import finding_tables
from rulefold import Rule, aggregate_findings, base_findings, register_base_view
from rulefold.operators.base_view import SCOPES_PER_ROW, _scopes, view_columns
from rulefold.operators.quality import unmatched_findings
from tests.helpers import rows_of, small_tables, table


def test_columns_are_the_stated_ones_without_scope_internals(spark):
    view = base_findings(small_tables(spark))
    assert view.columns == view_columns()
    assert len(view.columns) == 36
    assert not {"id", "name", "editable", "root", "created_by"} & set(view.columns)


def test_one_row_per_finding_where_nothing_multiplies(spark):
    view = base_findings(small_tables(spark))
    assert [r[0] for r in rows_of(view, "finding_id")] == sorted(range(1, 11), key=repr)
    scoped = rows_of(view.where("scope_id IS NOT NULL"), "resource_id", "scope_group_name")
    assert set(scoped) == {(4, "Production")}


def test_rows_multiply_as_the_joins_would(spark):
    tables = small_tables(spark)
    tables["resource_to_scopes"] = table(spark, "resource_to_scopes", [{"resource_id": 4, "scope_ids": [1, 2]}])
    tables["finding_sla_rule_connections"] = table(spark, "finding_sla_rule_connections", [{"finding_id": 1}] * 3)
    tables["finding_ticket_associations"] = table(
        spark,
        "finding_ticket_associations",
        [{"id": n, "finding_id": 1, "ticket_id": t} for n, t in enumerate([8, 8, 9, 77])],
    )
    tables["tickets"] = table(spark, "tickets", [{"id": 8}, {"id": 9}, {"id": 9}])
    tables["user_sla"] = table(spark, "user_sla", [{"id": 1}, {"id": 1}, {"id": 2}])
    tables["findings_scores"] = table(
        spark, "findings_scores", [{"finding_id": n, "scoring_rule_id": 5} for n in (1, 2)]
    )
    tables["scoring_rules"] = table(
        spark, "scoring_rules", [{"id": 5, "selection_rule_id": 6}, {"id": 5, "selection_rule_id": 7}]
    )
    tables["selection_rules"] = table(spark, "selection_rules", [{"id": 6}, {"id": 6}])
    # scopes 2 x sla 3 x tickets (8, 8, 9 twice, 77) 5 x user sla 2 x scoring rules (6 twice, 7) 3
    counts = dict(rows_of(base_findings(tables).groupBy("finding_id").count()))
    assert counts == {1: 2 * 3 * 5 * 2 * 3, 2: 2 * 3}
    weighted = base_findings(tables, weighted=True)
    assert rows_of(weighted, "finding_id", "scope_id", "row_copies") == [
        (1, 1, 90), (1, 2, 90), (2, 1, 3), (2, 2, 3),
    ]


def test_first_cve_and_rows_that_agree_on_it(spark):
    tables = small_tables(spark)
    tables["findings_additional_data"] = table(
        spark,
        "findings_additional_data",
        [
            {"finding_id": 1, "cve": ["CVE-1"]},
            {"finding_id": 2, "cve": ["CVE-2", "CVE-3"]},
            {"finding_id": 2, "cve": ["CVE-2"]},
            {"finding_id": 2, "cve": []},
            {"finding_id": 3, "cve": None},
        ],
    )
    rows = rows_of(base_findings(tables, weighted=True), "finding_id", "cve", "additional_data_id", "row_copies")
    assert [r for r in rows if r[0] <= 4] == [
        (1, "CVE-1", 1, 1), (2, "CVE-2", 2, 2), (2, None, 2, 1), (3, None, 3, 1), (4, None, None, 1),
    ]


def test_existing_groups_hide_their_main_finding_and_dangling_references(spark):
    tables = small_tables(spark)
    tables["findings"] = tables["findings"].withColumn(
        "aggregation_group_id", F.expr("CASE WHEN id <= 3 THEN 70L WHEN id = 4 THEN 71L END")
    )
    tables["aggregation_groups"] = table(
        spark, "aggregation_groups", [{"id": 70, "main_finding_id": 2, "is_locked": False}]
    )
    kept = {r[0] for r in rows_of(base_findings(tables), "finding_id")}
    assert kept == {1, 3, 5, 6, 7, 8, 9, 10}
    assert rows_of(unmatched_findings(tables)) == [(0, 0, 0, 1)]


def test_findings_without_package_resource_score_or_status_are_absent(spark):
    tables = small_tables(spark)
    tables["findings"] = tables["findings"].withColumn(
        "package_name", F.expr("CASE WHEN id <> 1 THEN package_name END")
    )
    tables["plain_resources"] = tables["plain_resources"].where("id = 4")
    tables["findings_scores"] = tables["findings_scores"].where("finding_id <> 2")
    tables["user_status"] = tables["user_status"].withColumn(
        "actual_status_key", F.expr("CASE WHEN id = 3 THEN 5 ELSE actual_status_key END")
    )
    assert rows_of(base_findings(tables), "finding_id") == [(4,), (5,), (6,), (7,)]
    assert rows_of(unmatched_findings(tables)) == [(3, 1, 1, 0)]


def test_scopes_missing_empty_and_unknown(spark):
    tables = small_tables(spark)
    tables["findings"] = tables["findings"].where("id IN (1, 8)")
    tables["resource_to_scopes"] = table(
        spark, "resource_to_scopes", [{"resource_id": 4, "scope_ids": []}, {"resource_id": 5, "scope_ids": [1, 44]}]
    )
    got = rows_of(base_findings(tables), "finding_id", "scope_id", "scope_group", "scope_group_name")
    assert got == [(1, None, None, None), (8, 1, 1, "Production"), (8, 44, None, None)]


def test_left_joined_tables_may_be_missing(spark):
    needed = ("findings", "plain_resources", "findings_scores", "user_status", "statuses")
    tables = {k: v for k, v in small_tables(spark).items() if k in needed}
    view = base_findings(tables, summary=True)
    assert view.count() == 10 and set(view_columns(summary=True)) == set(view.columns)


def test_categories_of_status_and_finding_are_told_apart(spark):
    view = base_findings(small_tables(spark), summary=True)
    assert rows_of(view.select("category", "status_category", "finding_category").distinct()) == [
        ("OPEN", "OPEN", "own")
    ]


def test_plans_for_large_sides_give_the_same_view(spark, no_broadcast):
    tables = finding_tables(spark, "/root/testdata/sf0.001")
    large = base_findings(tables, summary=True)
    got = large.groupBy().agg(F.count("*"), F.sum(F.xxhash64(*large.columns).cast("decimal(38,0)"))).first()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    small = base_findings(tables, summary=True)
    want = small.groupBy().agg(F.count("*"), F.sum(F.xxhash64(*small.columns).cast("decimal(38,0)"))).first()
    assert got == want and want[0] > 1000


def test_rows_of_a_tenant_only_meet_rows_of_that_tenant(spark):
    first, second = small_tables(spark), small_tables(spark)
    second["plain_resources"] = second["plain_resources"].withColumn("cloud_account", F.lit("other"))
    second["resource_to_scopes"] = table(spark, "resource_to_scopes", [{"resource_id": 4, "scope_ids": [1, 1]}])
    both = {
        name: first[name].withColumn("tenant", F.lit("one")).unionByName(
            second[name].withColumn("tenant", F.lit("two"))
        )
        for name in first
        if name not in ("statuses", "scope_groups")
    }
    both |= {n: first[n] for n in ("statuses", "scope_groups")}
    view = base_findings(both, tenant="tenant")
    assert rows_of(view.where("tenant = 'one'").drop("tenant")) == rows_of(base_findings(first))
    assert rows_of(view.where("tenant = 'two'").drop("tenant")) == rows_of(base_findings(second))
    run = aggregate_findings(both, [Rule(1, 1, ("package_name",))], tenant="tenant")
    assert {r[0]: r[1] for r in rows_of(run.association.groupBy("tenant").count())} == {"one": 10, "two": 17}


def test_the_view_can_be_registered(spark):
    register_base_view(base_findings(small_tables(spark)))
    assert spark.sql("SELECT count(*) FROM base_findings_view").first()[0] == 10


def test_the_earlier_rule_takes_all_ten_findings(spark):
    """Two rules over the ten findings: the first has no filter, so the second gets none."""
    rules = [
        Rule(31, 20, ("package_name",)),
        Rule(8, 50, ("package_name", "cloud_account"), {
            "scope_group": 1, "filtersjson": {"value": ["scanner"], "field": "source", "condition": "in"}}),
    ]
    run = aggregate_findings(small_tables(spark), rules)
    readable = rows_of(run.association, "group_identifier_readable", "finding_id")
    packages = zip([f"lib-{p}" for p in "aaabccccdd"], range(1, 11))
    assert readable == sorted(packages, key=repr)
    assert rows_of(run.rollup, "rule_number", "findings_count") == [(0, 1), (0, 2), (0, 3), (0, 4)]


@pytest.mark.parametrize("prefix", ["", "app_"])
def test_tables_come_from_a_catalog_by_prefix(spark, prefix):
    from rulefold import aggregate_catalog

    for name, df in small_tables(spark).items():
        df.createOrReplaceTempView(prefix + name)
    run = aggregate_catalog(spark, prefix, [Rule(1, 1, ("package_name",))])
    assert run.association.count() == 10


def test_scopes_of_a_resource_travel_in_rows_of_fixed_length(spark):
    tables = small_tables(spark)
    many = list(range(150))
    tables["resource_to_scopes"] = table(
        spark, "resource_to_scopes",
        [{"resource_id": 4, "scope_ids": s} for s in (many, many, [1], [])] + [{"resource_id": None, "scope_ids": [1]}],
    )
    sides = _scopes(tables, [])
    assert sides.agg(F.max(F.size("__scopes"))).first()[0] == SCOPES_PER_ROW == 64
    assert "scope_ids" not in sides.schema["__scopes"].dataType.elementType.names
    seven = base_findings(tables).where("finding_id = 1")
    want = [(n, 150) for n in many * 2] + [(1, 1), (None, 0)]
    assert rows_of(seven.select("scope_id", F.size("scope_ids"))) == sorted(want, key=repr)
    assert seven.where("scope_group_name = 'Production'").count() == 3
