"""Incremental runs against full ones, table by table."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import finding_tables
from checks.registry import FANOUT_RULES, before_changes
from rulefold import aggregate_findings
from rulefold.plans import incremental
from rulefold.plans.incremental import affected_findings, changed_keys, run_incrementally, signed_counts, table_digests
from rulefold.sources.versions import StaleRun, VersionedTables
from tests.helpers import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return finding_tables(spark, SF)


def outputs(grouping):
    rollup = grouping.rollup.select("group_identifier", "group_identifier_readable", "findings_count", "rule_number")
    return rows_of(rollup), rows_of(grouping.association)


def test_digests_tell_keys_whose_rows_differ(spark):
    def digests(rows):
        return table_digests(spark.createDataFrame(rows, "id long, a string, b array<int>"), "id")

    before = [(1, "x", [1]), (1, "y", None), (2, "x", []), (3, "z", [3]), (None, "q", None), (5, "e", None), (5, "e", None)]
    after = [(1, "y", None), (1, "x", [1]), (2, "x", None), (4, "z", [3]), (None, "r", None), (5, "e", None)]
    assert [r.key for r in changed_keys(digests(before), digests(after)).orderBy("key").collect()] == [2, 3, 4, 5]
    assert changed_keys(digests(before), digests(before[::-1])).count() == 0


def test_a_finding_has_one_digest_over_all_its_tables(spark):
    def changed(before, after):
        sides = [incremental.finding_digests({t: spark.createDataFrame(rows, kinds[t]) for t, rows in side.items()}, keys) for side in (before, after)]
        assert [d.count() for d in sides] == [len({r[0] for r in side["findings"] if r[0] is not None}) for side in (before, after)]
        return [r.key for r in changed_keys(*sides).orderBy("key").collect()]

    kinds = {"findings": "id long, a string", "user_status": "id long, a string"}
    keys = dict.fromkeys(kinds, "id")
    before = {"findings": [(1, "x"), (2, "x"), (2, "x"), (3, "x"), (4, "x"), (None, "x")], "user_status": [(1, "y"), (3, "y"), (3, "z"), (7, "y")]}
    assert changed(before, {t: rows[::-1] for t, rows in before.items()}) == []
    moved = {"findings": [(1, "y"), (2, "x"), (3, "x"), (4, "x"), (7, "x")], "user_status": [(1, "x"), (3, "z"), (3, "y"), (7, "y"), (8, "y")]}
    assert changed(before, moved) == [1, 2, 7]  # 1: its rows' values change places; 8 is no finding
    assert changed(before, {**before, "user_status": before["user_status"] + [(4, None)]}) == [4]


def test_sums_of_digests_pass_64_bits(spark):
    rows = spark.range(0, 100_000, numPartitions=4).selectExpr("id % 2 AS id", "id AS a")
    hashes = rows.where("id = 1").select(F.xxhash64("a", F.col("a").isNull(), "id", F.col("id").isNull())).collect()
    found = {r.key: r.digest for r in table_digests(rows, "id").collect()}
    assert found.keys() == {0, 1} and (found[1] - sum(h[0] for h in hashes)) % (1 << 64) == 0


def test_stored_steps_leave_no_shuffle_files(spark, tables, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}

    small = {**tables, "findings": tables["findings"].where("id % 50 = 1")}
    before = shuffled()
    run = run_incrementally(spark, small, FANOUT_RULES, f"file://{tmp_path}/runs")
    assert shuffled() <= before
    digests = spark.read.parquet(f"{run.version.data}/digests").where("table = 'findings'")
    assert digests.count() == small["findings"].count()


def test_counts_are_kept_by_additions_and_retractions(spark):
    schema = "finding_id long, rule_number int, group_key array<string>, row_copies long"
    counts = spark.createDataFrame([(0, ["a"], 5), (0, ["b"], 2), (1, [None], 1)], "rule_number int, group_key array<string>, findings_count long")
    gone = spark.createDataFrame([(1, 0, ["a"], 2), (2, 0, ["b"], 2)], schema)
    come = spark.createDataFrame([(1, 1, [None], 3), (3, 2, ["new"], 1)], schema)
    assert rows_of(signed_counts(counts, gone, come)) == sorted([(0, ["a"], 3), (1, [None], 4), (2, ["new"], 1)], key=repr)


CHANGES = {
    "findings": ("source", "IF(id % 5 = 1, 'F', source)"),
    "plain_resources": ("cloud_account", "IF(id % 7 = 1, 'other', cloud_account)"),
    "findings_scores": ("severity", "IF(finding_id % 11 = 2, 4, severity)"),
    "user_status": ("actual_status_key", "IF(id % 13 = 0, 2, actual_status_key)"),
    "statuses": ("category", "IF(key = 3, 'OPEN', category)"),
    "aggregation_groups": ("main_finding_id", "main_finding_id + IF(id % 3 = 1, 1, 0)"),
    "findings_additional_data": ("cve", "IF(finding_id % 3 = 0, array('CVE-new'), cve)"),
    "resource_to_scopes": ("scope_ids", "IF(resource_id % 5 = 1, array(3), scope_ids)"),
    "scope_groups": ("name", "IF(id % 6 = 3, 'renamed', name)"),
    "finding_sla_rule_connections": ("finding_id", "IF(finding_id % 6 = 0, -1, finding_id)"),
    "findings_info": ("id", "IF(id % 4 = 0, -5, id)"),
    "finding_ticket_associations": ("ticket_id", "IF(id % 7 = 0, -1, ticket_id)"),
    "tickets": ("id", "IF(id % 3 = 0, id + 1, id)"),
    "user_sla": ("id", "IF(id % 20 = 0, -9, id)"),
    "scoring_rules": ("selection_rule_id", "IF(id % 2 = 0, 1, selection_rule_id)"),
    "selection_rules": ("id", "IF(id % 5 = 0, 4, id)"),
}


@pytest.mark.parametrize("changed", [["scope_groups", "selection_rules"], list(CHANGES)])
def test_every_change_is_followed_to_its_findings(spark, tables, changed):
    """The view's rows of all findings that are not affected are the same before and after."""
    from rulefold.operators.base_view import base_findings

    after = {t: df.withColumn(CHANGES[t][0], F.expr(CHANGES[t][1]).cast(df.schema[CHANGES[t][0]].dataType)) if t in changed else df for t, df in tables.items()}
    keys = {t: changed_keys(table_digests(tables[t], k), table_digests(after[t], k)) for t, k in (
        ("findings", "id"), ("plain_resources", "id"), ("findings_scores", "finding_id"), ("user_status", "id"), ("statuses", "key"),
        ("aggregation_groups", "id"), ("findings_additional_data", "finding_id"), ("resource_to_scopes", "resource_id"), ("scope_groups", "id"),
        ("finding_sla_rule_connections", "finding_id"), ("findings_info", "id"), ("finding_ticket_associations", "finding_id"),
        ("tickets", "id"), ("user_sla", "id"), ("scoring_rules", "id"), ("selection_rules", "id"),
    ) if t in changed}
    affected = affected_findings(after, keys)
    rows = [
        base_findings(t, weighted=True).join(affected, "finding_id", "left_anti").select("finding_id", "scope_id", "scope_group_name", "cloud_account", "row_copies")
        for t in (tables, after)
    ]
    assert 0 < affected.count()
    assert rows[0].exceptAll(rows[1]).count() == rows[1].exceptAll(rows[0]).count() == 0


def test_runs_over_changes_equal_full_runs(spark, tables, tmp_path):
    folder, rules = f"file://{tmp_path}/runs", FANOUT_RULES
    first = run_incrementally(spark, before_changes(tables), rules, folder)
    assert first.full and first.version.number == 1
    second = run_incrementally(spark, tables, rules, folder)
    assert not second.full and 0 < second.affected.count() < tables["findings"].count() * 0.6
    assert outputs(second.grouping) == outputs(aggregate_findings(tables, rules))
    third = run_incrementally(spark, tables, rules, folder)  # nothing changed
    assert third.affected.count() == 0 and outputs(third.grouping) == outputs(second.grouping)
    assert run_incrementally(spark, {**tables, "findings": tables["findings"].limit(50)}, rules[:2], folder).full


def test_a_run_that_fails_changes_nothing(spark, tables, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/runs"
    small = {t: df for t, df in tables.items()}
    small["findings"] = tables["findings"].where("id % 50 = 1")
    run_incrementally(spark, small, FANOUT_RULES, folder)
    store = VersionedTables(spark, folder)
    real = store.commit

    def late(self, draft, facts=None):
        real(store.begin(), {"rules": "another run"})  # commits first
        return real(draft, facts)

    monkeypatch.setattr(VersionedTables, "commit", late)
    with pytest.raises(StaleRun):
        run_incrementally(spark, small, FANOUT_RULES, folder)
    assert store.current().facts == {"rules": "another run"}


def test_digests_are_compared_without_a_sorted_join(spark, no_broadcast):
    rows = spark.range(50).selectExpr("id % 20 AS id", "id AS a")
    digests = table_digests(rows, "id")
    assert {f.dataType.simpleString() for f in digests.schema} == {"bigint"}
    changed = changed_keys(digests, table_digests(rows.where("a <> 45"), "id"))
    assert [r.key for r in changed.collect()] == [5]
    assert "Join" not in changed._jdf.queryExecution().executedPlan().toString()
