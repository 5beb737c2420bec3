"""Existing groups, change plans, checks and reports."""

import pytest
from pyspark.sql import functions as F

from rulefold import Rule, create_groups, group_findings
from rulefold.operators.exclusions import exclude_findings
from rulefold.operators.existing import change_plan, match_existing_groups, ungrouped_findings
from rulefold.operators.groups import claimed_ids, unclaimed
from rulefold.operators.quality import (
    association_difference,
    count_mismatches,
    run_report,
    run_totals,
    schema_differences,
)
from rulefold.plans.runs import candidate_groups
from rulefold.schemas import ASSOCIATION, ROLLUP, TABLES, id_column, schema_of, view_name_of
from tests.helpers import rows_of, small_tables, table


@pytest.fixture(scope="module")
def existing(spark):
    return spark.createDataFrame(
        [(1, 11, "a", False), (2, 12, "b", True), (3, 13, "gone", False), (4, 14, "locked away", True), (5, 15, "a", False), (6, 16, "c", None)],
        "id long, main_finding_id long, group_identifier string, is_locked boolean",
    )


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        [("a", 2), ("b", 3), ("c", 4), ("d", 5), ("d", 6)], "group_identifier string, findings_count long"
    )


def test_only_unlocked_groups_match(groups, existing):
    got = rows_of(match_existing_groups(groups, existing), "group_identifier", "group_id", "main_finding_id")
    assert got == [("a", 1, 11), ("a", 5, 15), ("b", None, None), ("c", None, None), ("d", None, None), ("d", None, None)]


def test_change_plan_tells_new_matched_and_vanished(groups, existing):
    assert rows_of(change_plan(groups, existing)) == [
        ("a", 1, 1, 2, "matched"), ("a", 5, 1, 2, "matched"), ("b", None, 1, 3, "new"),
        ("c", None, 1, 4, "new"), ("d", None, 2, 11, "new"), ("gone", 3, None, None, "vanished"),
    ]


def test_change_plan_counts_a_group_once(spark, existing):
    df = spark.range(50).selectExpr("id AS finding_id", "'p' AS package_name", "'a' AS cloud_account")
    rollup = create_groups(df, ["package_name"]).rollup
    new = change_plan(rollup, existing).where("change = 'new'")
    assert rows_of(new, "computed_groups", "findings_count") == [(1, 50)]


def test_null_in_an_exclusion_list_excludes_nothing(spark):
    df = spark.range(4).withColumnRenamed("id", "finding_id")
    barred = spark.createDataFrame([(1, 10), (2, 11), (None, 10)], "finding_id long, aggregation_rule_id int")
    assert rows_of(exclude_findings(df, barred, 10)) == [(0,), (2,), (3,)]


def test_ungrouped_lists_are_empty_not_absent(spark):
    df = spark.range(100).selectExpr(
        "id AS finding_id", "CASE WHEN id < 90 THEN 'big' WHEN id < 95 THEN 'done' END AS g",
        "CASE WHEN id >= 90 OR id % 2 = 0 THEN 1 END AS aggregation_group_id",
    )
    got = {r["g"]: r["finding_ids_without_group"] for r in ungrouped_findings(df, ["g"], lists=True).collect()}
    assert sorted(got["big"]) == list(range(1, 90, 2)) and got["done"] == [] and got[None] == []
    rows = ungrouped_findings(df, ["g"])
    assert rows_of(rows) == sorted((("big", n) for n in range(1, 90, 2)), key=repr)


def test_candidate_groups_without_lists_are_rows_of_the_same_pairs(spark):
    tables = small_tables(spark)
    tables["findings"] = tables["findings"].withColumn(
        "aggregation_group_id", F.expr("CASE WHEN package_name = 'lib-b' OR id = 4 THEN 8 END")
    )
    tables["findings_scores"] = tables["findings_scores"].unionByName(tables["findings_scores"].where("finding_id = 1"))
    tables["aggregation_groups"] = table(spark, "aggregation_groups", [{"id": 8, "group_identifier": "x", "is_locked": False}])
    listed = candidate_groups(tables, "findings.package_name", 1, lists=True)
    rows = candidate_groups(tables, "findings.package_name", 1)
    want = listed.select(
        "calculated_group_identifier", F.explode_outer("finding_ids_without_group").alias("finding_id"), "group_id", "main_finding_id"
    )
    assert rows_of(rows) == rows_of(want) and rows.count() == 11
    assert rows.where("finding_id IS NULL").count() == 1 and rows.where("finding_id = 1").count() == 2
    assert "collect_list" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_outputs_have_the_published_schemas(spark):
    df = spark.createDataFrame([(1, "p", "a")], "finding_id long, package_name string, cloud_account string")
    run = create_groups(df, ["package_name"])
    nothing = {"missing": [], "unexpected": [], "retyped": []}
    assert schema_differences(run.association, ASSOCIATION) == nothing
    assert schema_differences(run.rollup, ROLLUP) == nothing
    assert schema_differences(run.rollup.drop("finding_ids").withColumn("rule_number", F.lit("x")), ROLLUP) == {
        "missing": ["finding_ids"], "unexpected": [], "retyped": ["rule_number"],
    }


def test_counts_agree_unless_rows_go_missing_or_hashes_collide(spark):
    df = spark.createDataFrame(
        [(1, "a-b", "c"), (2, "a", "b-c"), (3, "x", "y"), (3, "x", "y")],
        "finding_id long, package_name string, cloud_account string",
    )
    exact = create_groups(df, ["package_name", "cloud_account"], id_style="exact")
    assert count_mismatches(exact.rollup, exact.association).count() == 0
    damaged = exact.association.where("finding_id <> 2")
    assert rows_of(count_mismatches(exact.rollup, damaged), "expected_count", "actual_count") == [(1, 0)]
    compat = create_groups(df, ["package_name", "cloud_account"])
    assert count_mismatches(compat.rollup, compat.association).count() == 2


def test_association_difference_in_both_senses(spark):
    schema = "group_identifier string, finding_id long"
    a = spark.createDataFrame([("g", 1), ("g", 1), ("g", 2)], schema)
    b = spark.createDataFrame([("g", 1), ("g", 3)], schema)
    assert rows_of(association_difference(a, b)) == [("g", 2, "missing"), ("g", 3, "unexpected")]
    assert rows_of(association_difference(a, b, distinct=False)) == [
        ("g", 1, "missing"), ("g", 2, "missing"), ("g", 3, "unexpected"),
    ]


def test_reports_and_claims(spark):
    df = spark.createDataFrame(
        [(1, "p", "a"), (1, "p", "a"), (2, "q", "a"), (3, "r", None)],
        "finding_id long, package_name string, cloud_account string",
    )
    rules = [Rule(1, 1, ("package_name",), {"package_name": ["p", "q"]}), Rule(2, 2, ("package_name",), {"package_name": "z"})]
    run = group_findings(df, rules)
    assert rows_of(run_report(run.assigned)) == [(0, 2, 2, 3)]
    assert rows_of(run_totals(run.rollup)) == [(2, 3)]
    assert rows_of(claimed_ids(run.assigned)) == [(1,), (2,)]
    assert rows_of(unclaimed(df, claimed_ids(run.assigned)), "finding_id") == [(3,)]


def test_schema_registry():
    assert len(TABLES) == 18 and len(TABLES["findings"]) == 32 and len(TABLES["tickets"]) == 22
    assert [id_column(t) for t in ("findings", "findings_scores", "statuses", "resource_to_scopes", "scoring_rules")] == [
        "id", "finding_id", "key", "resource_id", "id",
    ]
    assert view_name_of("plain_resources", "r1_resource_type") == "resource_type"
    assert view_name_of("findings", "title") == "title"
    assert schema_of("finding_group_rollup") is ROLLUP
    with pytest.raises(ValueError):
        schema_of("nowhere")


def test_results_of_tenants_are_told_apart(spark):
    df = spark.createDataFrame(
        [("one", 1, "p", "a"), ("two", 1, "p", "a"), ("two", 2, "p", "a")],
        "tenant string, finding_id long, package_name string, cloud_account string",
    )
    run = group_findings(df, [Rule(1, 1, ("package_name",))], tenant="tenant")
    assert count_mismatches(run.rollup, run.association, "tenant").count() == 0
    assert count_mismatches(run.rollup, run.association).count() == 2
    assert rows_of(run_report(run.assigned, "tenant")) == [("one", 0, 1, 1, 1), ("two", 0, 1, 2, 2)]
    identifier = run.rollup.first()["group_identifier"]
    existing = spark.createDataFrame(
        [("two", 7, 1, identifier, False), ("three", 8, 1, identifier, False)],
        "tenant string, id long, main_finding_id long, group_identifier string, is_locked boolean",
    )
    matched = match_existing_groups(run.rollup, existing, "tenant")
    assert rows_of(matched, "tenant", "group_id") == [("one", None), ("two", 7)]
    plan = change_plan(run.rollup, existing, "tenant")
    assert rows_of(plan, "tenant", "change") == [("one", "new"), ("three", "vanished"), ("two", "matched")]
    barred = spark.createDataFrame([("two", 1, 1)], "tenant string, finding_id long, aggregation_rule_id int")
    assert rows_of(exclude_findings(df, barred, 1, "tenant"), "tenant", "finding_id") == [("one", 1), ("two", 2)]
