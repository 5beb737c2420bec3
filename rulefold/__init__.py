"""Consolidates findings into groups with ordered, declarative rules, on Spark."""

from rulefold.functions.predicates import FilterError, compile_filter, filter_rows
from rulefold.operators.assign import assign_rules
from rulefold.operators.base_view import base_findings, register_base_view
from rulefold.operators.groups import Grouping, create_groups, group_findings
from rulefold.operators.summaries import summarize
from rulefold.plans.runs import aggregate_catalog, aggregate_findings, publish_files, publish_tables
from rulefold.sources.ingest import import_findings
from rulefold.sources.rules import Rule, load_rules, parse_rules, read_rules_file
from rulefold.sources.tables import JdbcSource, catalog_tables, parquet_tables

__all__ = [
    "FilterError",
    "Grouping",
    "JdbcSource",
    "Rule",
    "aggregate_catalog",
    "aggregate_findings",
    "assign_rules",
    "base_findings",
    "catalog_tables",
    "compile_filter",
    "create_groups",
    "filter_rows",
    "group_findings",
    "import_findings",
    "load_rules",
    "parquet_tables",
    "parse_rules",
    "publish_files",
    "publish_tables",
    "read_rules_file",
    "register_base_view",
    "summarize",
]
