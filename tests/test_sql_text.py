"""What SQL texts of rules may hold."""

from __future__ import annotations

import pytest

from rulefold.functions.predicates import FilterError, compile_filter
from rulefold.functions.sql_text import SqlTextError, check_sql_text
from rulefold.operators.assign import assign_rules
from rulefold.sources.rules import Rule


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "a", 3, ["x"]), (2, None, 5, ["y"])]
    return spark.createDataFrame(data, "finding_id long, source string, severity int, tags array<string>").selectExpr("*", "named_struct('source', source) AS findings", "'c' AS cloud_account")


@pytest.mark.parametrize("text", [
    "source = 'a' AND NOT severity > 4", "severity * 2 - 1 BETWEEN 2 AND 7 OR source IS NULL",
    "lower(source) LIKE '%a%' OR source RLIKE '^b'", "tags[0] = 'x'", "array_contains(tags, 'x')",
    "CASE WHEN severity IN (1, 3) THEN true ELSE source <=> 'q' END", "findings.source = 'a'",
    "CAST(severity AS STRING) = '3'", "coalesce(SOURCE, '') != ''", "-severity < 0 AND true", "source ILIKE 'A'",
    "severity % 2 = 1", "concat(source, 'x') = 'ax' OR source || 'y' = 'by'", "severity IS NOT NULL",
])
def test_plain_predicates_pass_and_run(rows, text):
    assert check_sql_text(rows, text) == text
    rows.where(compile_filter(rows, {"custom_sql": text})).collect()


@pytest.mark.parametrize("text", [
    "severity > (SELECT max(severity) FROM other)", "EXISTS (SELECT 1)", "finding_id IN (SELECT id FROM t)",
    "java_method('java.lang.System', 'exit', '1') IS NULL", "reflect('a', 'b')", "input_file_name() = 'x'",
    "exists(tags, t -> t = 'x')", "row_number() OVER (ORDER BY source) = 1", "max(severity) > 1", "rand() < 0.5",
    "other_column = 1", "findings.unknown = 1", "elsewhere.source = 'a'", "count(DISTINCT source) > 1",
    "source = :name", "severity = 1; DROP TABLE x", "source =", "secret('a', 'b') = 'c'", "explode(tags) = 'x'", "*",
    "raise_error('x')", "system.builtin.rand() > 0", "source = 'a' -- x\n OR uuid() = source",
])
def test_anything_else_is_refused_before_it_runs(rows, text):
    with pytest.raises(SqlTextError):
        check_sql_text(rows, text)
    with pytest.raises(FilterError):
        compile_filter(rows, {"custom_sql": text})


def test_sql_filters_of_rules_are_checked_too(rows):
    rule = Rule(1, 1, ("source",), sql_filter="severity > (SELECT 1)")
    with pytest.raises(FilterError):
        assign_rules(rows, [rule], use_sql_filters=True)
