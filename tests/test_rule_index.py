"""Rules found through the index against the CASE over all rules."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from checks.registry import many_rules
from rulefold import Rule, assign_rules
from rulefold.functions.predicates import Fields
from rulefold.operators.rule_index import (
    ENTRY,
    LOWERED,
    VALUE,
    Anchor,
    all_anchors,
    anchors_of,
    candidate_rules,
    measured_shares,
)
from tests.helpers import rows_of

SCHEMA = "finding_id long, name string, kind string, level int, flag boolean, score double, tags array<string>, marks array<int>, cloud_account string"
NAMES = ["a", "A", "b-c", "é", "K", "k", "", "%", "null"]


def rows(seed, n=300):
    r = random.Random(seed)
    some = lambda values: r.choice([*values, None])
    return [
        (
            r.randrange(n // 2), some(NAMES), some(NAMES[:4]), some([0, 1, 2, 300, -7]), some([True, False]), some([0.5, 1.0]),
            some([[], [some(NAMES) for _ in range(r.randrange(4))]]), some([[], [some([1, 2, 3]) for _ in range(3)]]), some(["x", "y"]),
        )
        for _ in range(n)
    ]


def random_filter(r, depth=0):
    kind = r.randrange(9 if depth < 3 else 6)
    leaf = lambda f, c, v: {"field": f, "condition": c, "value": v}
    if kind == 0:
        return leaf(r.choice(["name", "kind"]), r.choice(["in", "not_in"]), r.sample(NAMES, r.randrange(1, 3)))
    if kind == 1:
        return leaf("level", r.choice(["equals", "not_equals"]), r.choice([0, "1", 300, "-7"]))
    if kind == 2:
        return leaf(r.choice(["flag"]), "equals", r.choice(["true", "FALSE", True]))
    if kind == 3:
        return leaf("tags", r.choice(["overlap", "notoverlapping", "overlapilikelist", "notoverlapilikelist"]), r.sample(NAMES, 2))
    if kind == 4:
        return leaf("marks", r.choice(["overlap", "notoverlapping"]), [r.choice([1, "2", 9])])
    if kind == 5:
        return r.choice([leaf("score", "equals", 1), leaf("name", "contains", "c"), leaf("kind", "exists", "true"), leaf("name", "", "x"), leaf("name", "in", [])])
    return {"operator": r.choice(["and", "or", "AND"]), "operands": [random_filter(r, depth + 1) for _ in range(r.randrange(4))]}


def random_rules(seed, count=40):
    r = random.Random(seed)
    rules = []
    for n in range(count):
        config = {"filtersjson": random_filter(r)}
        if r.random() < 0.3:
            config["level"] = r.choice([0, [1, 2]])
        if r.random() < 0.1:
            config["custom_sql"] = "level % 2 = 0"
        if r.random() < 0.1:
            config = {"operator": "or", "operands": [random_filter(r), random_filter(r)]}
        rules.append(Rule(n, n, r.choice([("name",), ("kind", "level"), ()]), config))
    return rules


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("measured", [False, True])
def test_same_rule_as_the_case(spark, seed, measured):
    df = spark.createDataFrame(rows(seed), SCHEMA).repartition(2)
    rules = random_rules(seed)
    barred = spark.createDataFrame([(i, i % 40) for i in range(0, 150, 3)], "finding_id long, aggregation_rule_id int")
    shares = measured_shares(df, all_anchors([r.filters for r in rules], Fields(df))) if measured else None
    got, want = (
        rows_of(assign_rules(df, rules, index=index, shares=shares, excluder=barred)) for index in (True, False)
    )
    assert got == want and got


def test_lists_of_tenants(spark):
    df = spark.createDataFrame(rows(9), SCHEMA).withColumn("tenant", F.col("level"))
    rules = {0: random_rules(1, 20), 1: random_rules(2, 20), 300: [Rule(1, 1, ("name",), {"name": "a"})]}
    got, want = (rows_of(assign_rules(df, rules, tenant="tenant", index=index)) for index in (True, False))
    assert got == want and got


def test_the_rarest_demand_is_chosen(spark):
    df = spark.createDataFrame([], SCHEMA)
    both = {"operator": "and", "operands": [
        {"field": "level", "condition": "in", "value": [1, 2]}, {"field": "name", "condition": "equals", "value": "b"},
    ]}
    other = {"name": "c", "tags": None}
    chosen = anchors_of([both, other, {"name": ["q"], "level": 3}], Fields(df))
    assert chosen[0] == {Anchor("name", VALUE, "b")}
    measured = {Anchor("name", VALUE, "b"): 0.9, Anchor("level", VALUE, "1"): 0.1, Anchor("level", VALUE, "2"): 0.1}
    assert anchors_of([both], Fields(df), measured)[0] == {Anchor("level", VALUE, "1"), Anchor("level", VALUE, "2")}
    tags = [{"filtersjson": {"field": "tags", "condition": c, "value": ["Ab", "c"]}} for c in ("overlap", "overlapilikelist", "notoverlapping")]
    assert anchors_of(tags, Fields(df)) == [
        {Anchor("tags", ENTRY, "Ab"), Anchor("tags", ENTRY, "c")}, {Anchor("tags", LOWERED, "ab"), Anchor("tags", LOWERED, "c")}, None,
    ]


def test_shares_are_counted(spark):
    df = spark.createDataFrame(rows(3), SCHEMA)
    anchors = {Anchor("name", VALUE, "a"), Anchor("level", VALUE, "300"), Anchor("tags", LOWERED, "a"), Anchor("marks", ENTRY, "2")}
    shares = measured_shares(df, anchors)
    plain = rows(3)
    assert shares[Anchor("level", VALUE, "300")] == sum(r[3] == 300 for r in plain) / len(plain)
    assert shares[Anchor("tags", LOWERED, "a")] == sum("a" in [(t or "").lower() for t in r[6] or []] for r in plain) / len(plain)
    assert shares[Anchor("marks", ENTRY, "2")] == sum(2 in (r[7] or []) for r in plain) / len(plain)
    assert measured_shares(df, set()) == {}


def test_a_row_tests_few_of_many_rules(spark):
    rules = many_rules(512)
    df = spark.createDataFrame(
        [(1, "KB3", 2, 5, ["Region:ASIA"])], "finding_id long, fix_id string, severity int, scope_group int, tags_key_values array<string>"
    ).selectExpr("*", "'Malware' rule_family", "'rule-1' rule_id", "'CVE-1' cve", "'Patch' fix_type", "array('ASIA') tags_values")
    demands = anchors_of([r.filters for r in rules], Fields(df))
    found = df.select(candidate_rules(dict(enumerate(demands))).alias("c")).first().c
    assert found == sorted(found) and 0 < len(found) < 80
    unanchored = [n for n, d in enumerate(demands) if d is None]
    assert set(unanchored) <= set(found) and unanchored == list(range(39, 512, 40))


def test_slots_agree_with_spark(spark):
    texts = ["a", "é", "日本", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(F.crc32(F.col("t").cast("binary"))).collect()] == [zlib.crc32(t.encode()) for t in texts]


def test_rules_are_tested_in_code_that_spark_compiles(spark):
    # 200 rules take several words of bits, and the last bit of a word is the number's sign
    rules = [Rule(n, n, ("name",), {"name": NAMES[n % 9], "level": [n % 3]}) for n in range(63)]
    rules += [Rule(n, n, ("kind",), {"name": NAMES[n % 9], "level": 300, "kind": NAMES[n % 4]}) for n in range(63, 200)]
    df = spark.createDataFrame(rows(3, 2_000), SCHEMA).repartition(2)
    indexed = assign_rules(df, rules, index=True)
    assert rows_of(indexed) == rows_of(assign_rules(df, rules, index=False))
    assert {r.rule_number for r in indexed.collect()} > {63, 64}
    # a lambda is interpreted row by row, and so is what a generator holds
    plan = indexed._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "Generate explode(__first_rule" in plan
