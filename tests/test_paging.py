"""Lists in pages, against lists of whole groups."""

from __future__ import annotations

from collections import defaultdict

import pytest

from rulefold.operators.existing import ungrouped_findings, ungrouped_pages
from rulefold.operators.groups import group_findings, group_pages
from rulefold.operators.paging import paged_lists
from rulefold.operators.skew import COPIES
from rulefold.sources.rules import Rule

SCHEMA = f"g string, h int, finding_id long, account string, {COPIES} long"


def brute(rows, per_page):
    groups = defaultdict(list)
    for g, h, finding, account, copies in rows:
        groups[g, h] += [(finding, account)] * copies
    pages = {}
    for key, entries in groups.items():
        entries.sort(key=lambda e: (e[0], e[1] is not None, e[1] or ""))
        for start in range(0, len(entries), per_page):
            part = entries[start : start + per_page]
            pages[(*key, start // per_page)] = ([e[0] for e in part], [e[1] for e in part])
    return pages


@pytest.mark.parametrize("per_page", [1, 7, 1000])
def test_pages_equal_the_sorted_list(spark, per_page):
    rows = [("hot", 1, n % 211, None if n % 3 else "acc", 1 + n % 4) for n in range(600)]
    rows += [(None, 1, 5, "a", 2500), (None, None, 5, None, 3), ("one", None, 9, "b", 1), ("hot", None, 1, "z", 2)]
    got = paged_lists(spark.createDataFrame(rows, SCHEMA), ["g", "h"], {"finding_id": "ids", "account": "accounts"}, per_page)
    pages = {(r.g, r.h, r.page): (r.ids, r.accounts) for r in got.collect()}
    assert pages == brute(rows, per_page)


def test_an_empty_table_has_no_pages_and_pages_have_entries(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert paged_lists(empty, ["g", "h"], {"finding_id": "ids"}).collect() == []
    with pytest.raises(ValueError, match="at least one"):
        paged_lists(empty, ["g"], {"finding_id": "ids"}, 0)


def test_a_group_of_a_third_of_all_rows_is_dealt_to_many_tasks(spark):
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id % 500 AS STRING)) AS package_name", "id AS finding_id", "'a' AS cloud_account")
    run = group_findings(rows, [Rule(1, 1, ("package_name",))], unique_ids=True)
    pages = group_pages(run.assigned, 100)
    sizes = pages.selectExpr("size(finding_ids) AS n", "group_identifier_readable AS name", "page").collect()
    assert max(r.n for r in sizes) == 100 and sum(r.n for r in sizes) == 30_000
    assert sorted(r.page for r in sizes if r.name == "hot") == list(range(100))


def test_ungrouped_pages_join_to_the_lists(spark):
    rows = [("r", n, None if n % 3 else 7) for n in range(50)] + [("full", 99, 7), (None, 100, None)]
    df = spark.createDataFrame(rows, "rule_id string, finding_id long, aggregation_group_id long")
    joined = defaultdict(list)
    for r in sorted(ungrouped_pages(df, ["rule_id"], ids_per_page=8).collect(), key=lambda r: r.page):
        joined[r.rule_id] += r.finding_ids_without_group
    lists = {r.rule_id: sorted(r.finding_ids_without_group) for r in ungrouped_findings(df, ["rule_id"], lists=True).collect()}
    assert dict(joined) == {k: v for k, v in lists.items() if v}
