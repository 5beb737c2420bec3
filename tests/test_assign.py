"""One-pass rules against the rule-by-rule loop, and the rules' corner cases."""

import random

import pytest
from pyspark.sql import functions as F

from checks.rule_loop import loop_rollup
from rulefold import Rule, assign_rules, create_groups, group_findings
from rulefold.functions.identity import group_identifier
from rulefold.operators.existing import change_plan
from rulefold.operators.quality import count_mismatches, run_totals
from tests.helpers import rows_of

SCHEMA = "finding_id long, package_name string, cloud_account string, source string, severity int"


def random_rows(seed, findings=120):
    rng = random.Random(seed)
    rows = []
    for n in range(findings):
        for _ in range(rng.choice([1, 1, 2, 4])):
            rows.append(
                (
                    n,
                    rng.choice(["a", "a-b", "b", "null", None]),
                    rng.choice(["b-c", "c", None]),
                    rng.choice(["x", "y", "z", None]),
                    rng.choice([1, 2, 3, None]),
                )
            )
    return rows


RULES = [
    Rule(9, 50, ("severity",)),
    Rule(1, 10, ("findings.package_name", "cloud_account"), {"source": ["x"], "severity": 1}),
    Rule(2, 20, (), {"source": ["y"]}),
    Rule(3, 30, ("package_name",), {"filtersjson": {"field": "severity", "condition": "in", "value": [2, 3]}}),
    Rule(4, 30, ("source",), {"source": ["nothing"]}),
    Rule(5, None, ("source",)),
]


def comparable(rollup):
    return rows_of(
        rollup.select(
            "group_identifier",
            "group_identifier_readable",
            F.array_sort("finding_ids"),
            F.array_sort("cloud_accounts"),
            "findings_count",
            "rule_number",
        )
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_loop(spark, seed):
    df = spark.createDataFrame(random_rows(seed), SCHEMA)
    run = group_findings(df, RULES, lists=True)
    assert comparable(run.rollup) == comparable(loop_rollup(df, RULES))
    exploded = loop_rollup(df, RULES).select(
        "group_identifier", "group_identifier_readable", F.explode("finding_ids")
    )
    assert rows_of(run.association) == rows_of(exploded)


def test_weighted_rows_equal_repeated_rows(spark):
    df = spark.createDataFrame(random_rows(3), SCHEMA)
    weighted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("row_copies"))
    assert comparable(group_findings(weighted, RULES, lists=True).rollup) == comparable(group_findings(df, RULES, lists=True).rollup)


def test_distinct_takes_each_finding_once_per_group(spark):
    df = spark.createDataFrame(random_rows(4), SCHEMA)
    plain, distinct = (group_findings(df, RULES, fanout=f, lists=True) for f in ("rows", "distinct"))
    kept = ("finding_id", "rule_number", "group_key")
    assert rows_of(distinct.assigned, *kept) == rows_of(plain.assigned.select(*kept).distinct())
    pairs = distinct.rollup.select("findings_count", F.size("finding_ids")).collect()
    assert all(a == b for a, b in pairs)


def test_a_finding_with_rows_for_two_rules_keeps_only_rows_of_the_first(spark):
    df = spark.createDataFrame([(1, "p", "one", "x", 1), (1, "p", "two", "y", 1)], SCHEMA)
    rules = [Rule(1, 1, ("cloud_account",), {"source": "y"}), Rule(2, 2, ("cloud_account",), {"source": "x"})]
    assert rows_of(assign_rules(df, rules), "finding_id", "rule_number", "cloud_account") == [(1, 0, "two")]


def test_rule_numbers_count_all_rules(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1)], SCHEMA)
    rules = [Rule(7, 1), Rule(8, 2, ("source",), {"source": "none"}), Rule(9, 3, ("source",))]
    assert rows_of(assign_rules(df, rules), "rule_number") == [(2,)]


def test_order_then_id_and_rules_without_order_last(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1)], SCHEMA)
    rules = [Rule(1, None, ("source",)), Rule(5, 2, ("package_name",)), Rule(4, 2, ("cloud_account",))]
    assert rows_of(assign_rules(df, rules), "group_key") == [(["a"],)]


def test_missing_group_columns_are_found_before_anything_runs(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1)], SCHEMA)
    with pytest.raises(ValueError, match=r"rule 2: missing columns \['findings.nowhere'"):
        assign_rules(df, [Rule(1, 1, ("source",)), Rule(2, 2, ("findings.nowhere",))])


def test_findings_id_means_the_finding(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1)], SCHEMA).withColumn("id", F.lit(99))
    assert rows_of(assign_rules(df, [Rule(1, 1, ("findings.id",))]), "group_key") == [(["1"],)]


def test_unique_ids_skips_the_comparison_but_not_the_order(spark):
    rows = [r for n, r in enumerate(random_rows(5)) if r[0] not in {q[0] for q in random_rows(5)[:n]}]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (group_findings(df, RULES, unique_ids=u, lists=True) for u in (True, False))
    assert comparable(a.rollup) == comparable(b.rollup)
    plan = assign_rules(df, RULES, unique_ids=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_no_rules_and_no_matches_give_empty_frames_with_the_output_schema(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1)], SCHEMA)
    for rules in ([], [Rule(1, 1)], [Rule(1, 1, ("source",), {"source": "none"})]):
        run = group_findings(df, rules)
        assert run.association.columns == ["group_identifier", "group_identifier_readable", "finding_id"]
        assert run.association.count() == 0 and run.rollup.count() == 0
        assert "finding_ids" in run.rollup.columns


def test_excluded_pairs_do_not_meet_but_later_rules_may(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1), (2, "p", "a", "x", 1)], SCHEMA)
    rules = [Rule(10, 1, ("source",)), Rule(11, 2, ("package_name",))]
    barred = spark.createDataFrame(
        [(1, 10), (1, 99), (2, 98), (None, 10)], "finding_id long, aggregation_rule_id int"
    )
    got = rows_of(assign_rules(df, rules, excluder=barred), "finding_id", "rule_number")
    assert got == [(1, 1), (2, 0)]


def test_tenants_do_not_claim_each_others_findings(spark):
    df = spark.createDataFrame(
        [("t1", 1, "p", "a", "x", 1), ("t2", 1, "p", "a", "y", 1), ("t3", 1, "p", "a", "x", 1)],
        "tenant string, " + SCHEMA,
    )
    shared = [Rule(1, 1, ("source",), {"source": "x"}), Rule(2, 2, ("package_name",))]
    got = rows_of(assign_rules(df, shared, tenant="tenant"), "tenant", "rule_number")
    assert got == [("t1", 0), ("t2", 1), ("t3", 0)]
    own = {"t1": [Rule(1, 1, ("cloud_account",))], "t2": shared}
    got = rows_of(assign_rules(df, own, tenant="tenant"), "tenant", "rule_number", "group_key")
    assert got == [("t1", 0, ["a"]), ("t2", 1, ["p"])]
    with pytest.raises(ValueError, match="tenant"):
        assign_rules(df, own)


def test_sql_filters_apply_only_on_request(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1), (2, "p", "a", "y", 1)], SCHEMA)
    rule = Rule.parse({"group_by": ["source"], "finding_filter": "findings.source='x' and findings.package_name!=''"}, 1)
    assert rows_of(assign_rules(df, [rule]), "finding_id") == [(1,), (2,)]
    assert rows_of(assign_rules(df, [rule], use_sql_filters=True), "finding_id") == [(1,)]


def test_group_identifier_matches_a_known_hash(spark):
    import hashlib

    df = spark.createDataFrame([(1, "lib1", "prod_account", "x", 1), (2, None, "a", "x", 1)], SCHEMA)
    got = rows_of(create_groups(df, ["package_name", "cloud_account"], 1).association)
    spelled = {"lib1_prod_account": "1-lib1-prod_account", "null_a": "1-null-a"}
    want = [(hashlib.md5(s.encode()).hexdigest(), r) for r, s in spelled.items()]
    assert sorted((i, r) for i, r, _ in got) == sorted(want)


def test_keys_that_share_a_compat_hash_stay_separate_groups(spark):
    df = spark.createDataFrame(
        [(1, "a-b", "c", "x", 1), (2, "a", "b-c", "x", 1), (3, None, "c", "x", 1), (4, "null", "c", "x", 1)], SCHEMA
    )
    compat, exact = (
        create_groups(df, ["package_name", "cloud_account"], id_style=s).rollup for s in ("compat", "exact")
    )
    assert compat.count() == exact.count() == 4
    assert compat.select("group_identifier").distinct().count() == 2
    assert exact.select("group_identifier").distinct().count() == 4
    with pytest.raises(ValueError):
        group_identifier(F.lit(1), F.array(F.lit("a")), "other")


@pytest.mark.parametrize("lists", [False, True])
def test_every_group_is_one_row_whatever_its_size(spark, lists):
    """Forty groups of two, and one that holds most rows."""
    df = spark.range(5000).selectExpr(
        "id AS finding_id", "CASE WHEN id >= 80 THEN 'hot' ELSE concat('p', id % 40) END AS package_name",
        "CASE WHEN id % 2 = 0 THEN 'acc' END AS cloud_account",
    )
    run = create_groups(df, ["package_name"], lists=lists)
    assert run.rollup.columns == [
        "group_identifier", "group_identifier_readable", "finding_ids", "cloud_accounts", "findings_count", "rule_number",
    ]
    assert rows_of(run_totals(run.rollup)) == [(41, 5000)]
    assert count_mismatches(run.rollup, run.association).count() == 0
    existing = run.rollup.selectExpr("monotonically_increasing_id() AS id", "group_identifier", "false AS is_locked")
    assert rows_of(change_plan(run.rollup, existing).select("change").distinct()) == [("matched",)]
    hot = run.rollup.where("group_identifier_readable = 'hot'").first()
    if lists:
        assert sorted(hot["finding_ids"]) == list(range(80, 5000)) and len(hot["cloud_accounts"]) == 2460
    else:
        assert hot["finding_ids"] is None and hot["cloud_accounts"] is None


def test_a_finding_with_very_many_copies_is_written_in_full(spark):
    df = spark.createDataFrame([(1, "p", "a", "x", 1, 250_001), (2, "p", None, "x", 1, 2)], SCHEMA + ", row_copies long")
    run = create_groups(df, ["package_name"], lists=True)
    assert run.association.count() == 250_003
    group = run.rollup.first()
    assert len(group["finding_ids"]) == 250_003 and len(group["cloud_accounts"]) == 250_001


def test_five_hundred_tenants_with_few_rule_lists(spark):
    df = spark.range(2000).selectExpr(
        "id AS finding_id", "concat('t', id % 500) AS tenant", "concat('p', id % 3) AS package_name", "'a' AS cloud_account"
    )
    by_package, none = [Rule(1, 1, ("package_name",))], [Rule(2, 1, ("package_name",), {"package_name": ["none"]})]
    rules = {f"t{n}": by_package if n % 2 else none for n in range(499)}
    assigned = assign_rules(df, rules, tenant="tenant")
    plan = assigned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("none") < 10
    got = rows_of(assigned, "tenant", "finding_id")
    assert got == sorted(((f"t{i % 500}", i) for i in range(2000) if i % 2 and i % 500 != 499), key=repr)


def test_rows_of_one_tenant_are_dealt_to_several_tasks(spark, no_broadcast):
    df = spark.range(400).selectExpr("id AS finding_id", "id % 2 AS tenant", "'p' AS package_name", "'a' AS cloud_account")
    rules = {0: [Rule(1, 1, ("package_name",)), Rule(2, 2, ("cloud_account",))], 1: [Rule(3, 1, ("cloud_account",))]}
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assigned = assign_rules(df, rules, tenant="tenant").withColumn("task", F.spark_partition_id())
        assert rows_of(assigned.select("tenant", "task").distinct().groupBy("tenant").count()) == [(0, 4), (1, 4)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
