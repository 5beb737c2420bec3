"""Each condition against a three-valued evaluation in Python."""

import json
import re

import pytest

from rulefold.functions.predicates import FilterError, compile_filter, filter_rows
from tests.helpers import rows_of

ROWS = [
    # id, source, severity, score, flag, tags
    (1, "Nimbus", 1, 1.5, True, ["Prod", "china"]),
    (2, "nimbus's", 2, None, False, ["PROD"]),
    (3, None, None, 2.0, None, None),
    (4, "a%b", 3, 0.5, True, []),
    (5, "a_b", 2, 7.0, False, ["x", None]),
    (6, "axb", 1, 7.0, True, [None, "prod"]),
    (7, "null", 5, 7.0, True, ["it's"]),
]
SCHEMA = "finding_id long, source string, severity int, score double, flag boolean, tags array<string>"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def leaf(field, condition, value):
    return {"field": field, "condition": condition, "value": value}


def kept(df, config, **options):
    return [r[0] for r in rows_of(filter_rows(df, config, **options), "finding_id")]


def expected(column, test):
    """Ids whose value passes; NULL never does."""
    place = ["finding_id", "source", "severity", "score", "flag", "tags"].index(column)
    return [r[0] for r in ROWS if r[place] is not None and test(r[place])]


def like(value):
    pattern = "".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in f"%{value}%")
    return re.compile(pattern, re.S).fullmatch


def overlap(values, fold=lambda s: s):
    """True, False or None (NULL) per array."""

    def test(array):
        items = [fold(i) if i is not None else None for i in array]
        if any(fold(v) in items for v in values):
            return True
        return None if None in items else False

    return test


@pytest.mark.parametrize(
    ("node", "column", "test"),
    [
        (leaf("source", "in", ["Nimbus", "nimbus's"]), "source", lambda v: v in ("Nimbus", "nimbus's")),
        (leaf("source", "not_in", ["Nimbus"]), "source", lambda v: v != "Nimbus"),
        (leaf("severity", "in", ["1", "2"]), "severity", lambda v: v in (1, 2)),
        (leaf("severity", "not_in", [1]), "severity", lambda v: v != 1),
        (leaf("source", "exists", "True"), "source", lambda v: True),
        (leaf("source", "equals", "nimbus's"), "source", lambda v: v == "nimbus's"),
        (leaf("severity", "equals", "2"), "severity", lambda v: v == 2),
        (leaf("score", "equals", "7"), "score", lambda v: v == 7.0),
        (leaf("flag", "equals", "true"), "flag", lambda v: v),
        (leaf("flag", "not_equals", True), "flag", lambda v: not v),
        (leaf("source", "not_equals", "Nimbus"), "source", lambda v: v != "Nimbus"),
        (leaf("source", "contains", "a%b"), "source", like("a%b")),
        (leaf("source", "contains", "a_b"), "source", like("a_b")),
        (leaf("source", "not_contains", "imb"), "source", lambda v: not like("imb")(v)),
        (leaf("severity", "contains", "2"), "severity", lambda v: "2" in str(v)),
        (leaf("tags", "overlap", ["Prod", "it's"]), "tags", overlap(["Prod", "it's"])),
        (leaf("tags", "notoverlapping", ["Prod", "x"]), "tags", lambda a: overlap(["Prod", "x"])(a) is False),
        (leaf("tags", "overlapilikelist", ["PROD"]), "tags", overlap(["PROD"], str.lower)),
        (
            leaf("tags", "notoverlapilikelist", ["PROD", "y"]),
            "tags",
            lambda a: overlap(["PROD", "y"], str.lower)(a) is False,
        ),
    ],
    ids=lambda v: v.get("condition") if isinstance(v, dict) else None,
)
def test_condition(df, node, column, test):
    assert kept(df, {"filtersjson": node}) == expected(column, test)


@pytest.mark.parametrize("value", ["False", "no", None, False])
def test_exists_with_any_other_value_means_missing(df, value):
    assert kept(df, {"filtersjson": leaf("source", "exists", value)}) == [3]


def test_and_or_nesting_in_any_case(df):
    tree = {
        "operator": "OR",
        "operands": [
            {"operator": "And", "operands": [leaf("severity", "equals", 1), leaf("flag", "equals", True)]},
            leaf("source", "equals", "a_b"),
        ],
    }
    assert kept(df, tree) == [1, 5, 6]


def test_operands_may_be_json_text(df):
    tree = {"operator": "and", "operands": [json.dumps(leaf("severity", "equals", 2)), leaf("flag", "exists", "True")]}
    assert kept(df, {"filtersjson": json.dumps(tree)}) == [2, 5]


def test_text_that_is_not_json_is_left_out(df):
    tree = {"operator": "and", "operands": ["not json", leaf("severity", "equals", 2)]}
    with pytest.warns(UserWarning, match="not valid JSON"):
        assert kept(df, tree) == [2, 5]
    with pytest.raises(FilterError):
        compile_filter(df, tree, strict=True)


def test_configuration_that_is_a_tree_ignores_other_keys(df):
    config = {"operator": "and", "operands": [leaf("severity", "equals", 1)], "source": "Nimbus"}
    assert kept(df, config) == [1, 6]


@pytest.mark.parametrize(
    "config",
    [
        None,
        {},
        {"scope_group": 1},
        {"filtersid": 5, "scopesid": 7, "filters_fields_to_exclude": ["x"], "scopes_fields_to_override": "None"},
        {"filtersjson": {}, "scopesjson": "", "source": None},
        {"filtersjson": "None", "scope_group": "None"},
        {"source": "", "tags": []},
        {"operator": "and", "operands": []},
        {"filtersjson": leaf("source", "", "x")},
    ],
)
def test_configurations_that_filter_nothing(df, config):
    assert len(kept(df, config)) == len(ROWS)


def test_flat_fields_are_combined(df):
    assert kept(df, {"severity": "2", "source": ["a_b", "Nimbus"], "scope_group": 1}) == [5]


def test_scope_group_other_than_one_is_a_filter(df):
    scoped = df.withColumnRenamed("severity", "scope_group")
    assert kept(scoped, {"scope_group": 2}) == [2, 5]


def test_custom_sql_is_one_part_of_the_conjunction(df):
    assert kept(df, {"custom_sql": "severity = 1 OR severity = 2", "flag": "true"}) == [1, 6]


def test_nested_value_replaces_its_leaf(df):
    node = {"field": "actual_status", "condition": "", "value": leaf("source", "in", ["Nimbus"])}
    assert kept(df, {"filtersjson": node}) == [1]


@pytest.mark.parametrize("node", [leaf("source", "in", []), leaf("source", "in", "Nimbus"), leaf("source", "near", "x")])
def test_leaves_without_meaning_are_left_out_or_refused(df, node):
    with pytest.warns(UserWarning):
        assert len(kept(df, {"filtersjson": node})) == len(ROWS)
    with pytest.raises(FilterError):
        compile_filter(df, {"filtersjson": node}, strict=True)


@pytest.mark.parametrize(
    "config",
    [
        {"operator": "xor", "operands": [leaf("source", "in", ["x"])]},
        {"nowhere": "x"},
        {"severity": "high"},
        {"flag": "maybe"},
        {"filtersjson": leaf("source", "overlap", ["x"])},
        {"source": {"a": 1}},
    ],
)
def test_filters_that_cannot_be_meant_are_errors(df, config):
    with pytest.raises(FilterError):
        compile_filter(df, config)


def test_quotes_in_values_are_data(df):
    assert kept(df, {"source": "x' OR '1'='1"}) == []


def test_qualified_names_and_field_map(spark):
    df = spark.createDataFrame(
        [(1, "OPEN", "Cloud", "VM", "t"), (2, "FIXED", "Code", "DB", "u")],
        "finding_id long, category string, finding_category string, resource_type string, finding_type string",
    )
    assert kept(df, {"plain_resources.r1_resource_type": "VM"}) == [1]
    assert kept(df, {"findings.finding_type_str": "u"}) == [2]
    assert kept(df, {"findings.category": "OPEN"}) == [1]
    assert kept(df, {"category": "Code"}, field_map={"category": "finding_category"}) == [2]
    assert kept(df, {"findings.id": [2]}) == [2]
