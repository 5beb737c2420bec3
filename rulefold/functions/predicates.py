"""Rule filters, given as JSON-like dictionaries, compiled to Spark columns.

Two shapes are understood, and may be nested as JSON text at any level:

* a tree of ``{"operator": "and" | "or", "operands": [...]}`` nodes over
  ``{"field", "condition", "value"}`` leaves;
* a flat configuration, whose keys are column names or one of ``filtersjson``,
  ``scopesjson`` (trees) and ``custom_sql`` (SQL text, see ``functions.sql_text``); all are
  AND-ed.

Values reach the plan as literals of the column's own type, never as SQL text.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulefold.functions.sql_text import SqlTextError, check_sql_text
from rulefold.schemas import TABLES, view_name_of

# Configuration keys with a meaning of their own, keys that only
# describe where a filter came from, and the text that stands for "not set".
TREE_KEYS = ("filtersjson", "scopesjson")
SQL_KEY = "custom_sql"
DESCRIPTIVE_KEYS = (
    "filtersid",
    "filters_fields_to_exclude",
    "filters_fields_to_include",
    "filters_fields_to_override",
    "scopesid",
    "scopes_fields_to_exclude",
    "scopes_fields_to_include",
    "scopes_fields_to_override",
)
NOT_SET_TEXT = "None"
ALL_FINDINGS_SCOPE = ("scope_group", 1)


class FilterError(ValueError):
    """A filter that cannot be turned into a predicate."""


class Fields:
    """Resolves the field names of rules against the columns of a DataFrame.

    ``table.column`` names resolve to the column's name in the joined view;
    ``field_map`` overrides any name, e.g. ``{"category": "finding_category"}``.
    """

    def __init__(self, df: DataFrame, field_map: Mapping[str, str] | None = None):
        self._types = {f.name: f.dataType for f in df.schema}
        self._map = dict(field_map or {})

    def resolve(self, name: str) -> str:
        table, _, bare = name.rpartition(".")
        candidates = [self._map.get(name), self._map.get(bare), name]
        if table in TABLES:
            candidates.append(view_name_of(table, bare))
        candidates += [view_name_of("findings", bare) if bare == "finding_type_str" else None, bare]
        for candidate in candidates:
            if candidate in self._types:
                return candidate
        raise FilterError(f"unknown field {name!r}; known: {sorted(self._types)}")

    def column(self, name: str) -> Column:
        return F.col(f"`{self.resolve(name)}`")

    def type_of(self, name: str) -> T.DataType:
        return self._types[self.resolve(name)]


def _literal(value: Any, kind: T.DataType, field: str) -> Column:
    """A literal of the column's type; text that does not fit it is an error now."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(value, (dict, list)):
        raise FilterError(f"field {field!r} cannot be compared with {value!r}")
    text = str(value)
    try:
        if isinstance(kind, T.IntegralType):
            return F.lit(int(text)).cast(kind)
        if isinstance(kind, T.FractionalType):
            return F.lit(float(text)).cast(kind)
    except ValueError:
        raise FilterError(f"field {field!r} is {kind.simpleString()}, got {value!r}") from None
    if isinstance(kind, T.BooleanType):
        if text.lower() not in ("true", "false"):
            raise FilterError(f"field {field!r} is boolean, got {value!r}")
        return F.lit(text.lower() == "true")
    return F.lit(text) if isinstance(kind, T.StringType) else F.lit(text).cast(kind)


class _Leaf:
    """One field under test."""

    def __init__(self, fields: Fields, name: str):
        self.name = name
        self.column = fields.column(name)
        self.kind = fields.type_of(name)

    def literal(self, value: Any) -> Column:
        return _literal(value, self.kind, self.name)

    def is_one_of(self, values: Sequence[Any]) -> Column:
        return self.column.isin([self.literal(v) for v in values])

    def matches(self, text: Any) -> Column:
        # % and _ inside the value keep their wildcard meaning
        return self.column.cast("string").like(f"%{text}%")

    def overlaps(self, values: Sequence[Any], ignore_case: bool = False) -> Column:
        if not isinstance(self.kind, T.ArrayType):
            raise FilterError(f"field {self.name!r} is {self.kind.simpleString()}, not an array")
        wanted = [_literal(v, self.kind.elementType, self.name) for v in values]
        if not ignore_case:
            return F.arrays_overlap(self.column, F.array(*wanted))
        lowered = F.transform(self.column, lambda item: F.lower(item))
        return F.arrays_overlap(lowered, F.array(*[F.lower(v) for v in wanted]))


# The names of the conditions. Those in the first table take a list.
_LIST_CONDITIONS: dict[str, Callable[[_Leaf, Sequence[Any]], Column]] = {
    "in": lambda leaf, values: leaf.is_one_of(values),
    "not_in": lambda leaf, values: ~leaf.is_one_of(values),
    "overlap": lambda leaf, values: leaf.overlaps(values),
    "notoverlapping": lambda leaf, values: ~leaf.overlaps(values),
    "overlapilikelist": lambda leaf, values: leaf.overlaps(values, ignore_case=True),
    "notoverlapilikelist": lambda leaf, values: ~leaf.overlaps(values, ignore_case=True),
}
_VALUE_CONDITIONS: dict[str, Callable[[_Leaf, Any], Column]] = {
    "exists": lambda leaf, value: (
        leaf.column.isNotNull() if str(value).lower() == "true" else leaf.column.isNull()
    ),
    "equals": lambda leaf, value: leaf.column == leaf.literal(value),
    "not_equals": lambda leaf, value: leaf.column != leaf.literal(value),
    "contains": lambda leaf, value: leaf.matches(value),
    "not_contains": lambda leaf, value: ~leaf.matches(value),
}
_OPERATORS = {"and": lambda a, b: a & b, "or": lambda a, b: a | b}


class FilterCompiler:
    """Compiles filters over one DataFrame.

    Leaves that say nothing (an empty condition, an empty list, an unknown
    condition) are left out with a warning; ``strict=True`` raises instead.
    """

    def __init__(
        self, df: DataFrame, field_map: Mapping[str, str] | None = None, strict: bool = False
    ):
        self.fields = Fields(df, field_map)
        self.strict = strict
        self._df = df

    def compile(self, config: Mapping[str, Any] | None) -> Column | None:
        """The predicate, or None where the configuration filters nothing."""
        if not config:
            return None
        if is_tree(config):
            return self._tree(config)
        parts = [self._entry(key, value) for key, value in config.items()]
        return _combine("and", parts)

    def _entry(self, key: str, value: Any) -> Column | None:
        if key in DESCRIPTIVE_KEYS or key in ("operator", "operands") or is_not_set(value):
            return None
        if key == ALL_FINDINGS_SCOPE[0] and value == ALL_FINDINGS_SCOPE[1]:
            return None
        if key in TREE_KEYS:
            return self._tree(value)
        if key == SQL_KEY:
            return self.sql(value)
        leaf = _Leaf(self.fields, key)
        return leaf.is_one_of(value) if isinstance(value, list) else leaf.column == leaf.literal(value)

    def sql(self, text: str) -> Column:
        """An SQL text as a predicate, if it holds nothing but what is allowed in rules."""
        try:
            return F.expr(check_sql_text(self._df, text))
        except SqlTextError as error:
            raise FilterError(str(error)) from error

    def _tree(self, node: Any) -> Column | None:
        if isinstance(node, str):
            try:
                node = json.loads(node)
            except json.JSONDecodeError:
                return self._drop(f"not valid JSON: {node!r}")
        if not isinstance(node, Mapping):
            return self._drop(f"not a filter: {node!r}")
        if is_tree(node):
            operator = str(node["operator"]).lower()
            if operator not in _OPERATORS:
                raise FilterError(f"unknown operator {node['operator']!r}")
            return _combine(operator, [self._tree(o) for o in node["operands"] or []])
        if "field" not in node:
            return self._drop(f"neither an operator nor a field: {node!r}")
        return self._leaf(node)

    def _leaf(self, node: Mapping[str, Any]) -> Column | None:
        value, condition = node.get("value"), node.get("condition")
        if isinstance(value, Mapping) and "field" in value:
            return self._tree(value)
        if not condition:
            return None
        if condition in _LIST_CONDITIONS:
            if not (isinstance(value, list) and value):
                return self._drop(f"condition {condition!r} needs a non-empty list: {node!r}")
            return _LIST_CONDITIONS[condition](_Leaf(self.fields, node["field"]), value)
        if condition in _VALUE_CONDITIONS:
            return _VALUE_CONDITIONS[condition](_Leaf(self.fields, node["field"]), value)
        return self._drop(f"unknown condition {condition!r}")

    def _drop(self, reason: str) -> None:
        if self.strict:
            raise FilterError(reason)
        warnings.warn(f"filter part left out: {reason}", stacklevel=2)


def is_known_condition(condition: Any, value: Any) -> bool:
    """Whether a leaf with this condition and value says anything."""
    if condition in _LIST_CONDITIONS:
        return isinstance(value, list) and bool(value)
    return condition in _VALUE_CONDITIONS


def is_tree(node: Mapping[str, Any]) -> bool:
    return "operator" in node and "operands" in node


def is_not_set(value: Any) -> bool:
    return value is None or value == NOT_SET_TEXT or (
        isinstance(value, (str, list, dict)) and not value
    )


def _combine(operator: str, parts: Sequence[Column | None]) -> Column | None:
    stated = [p for p in parts if p is not None]
    return reduce(_OPERATORS[operator], stated) if stated else None


def compile_filter(
    df: DataFrame,
    config: Mapping[str, Any] | None,
    field_map: Mapping[str, str] | None = None,
    strict: bool = False,
) -> Column:
    """The predicate of ``config`` over ``df``; constant true where it filters nothing."""
    predicate = FilterCompiler(df, field_map, strict).compile(config)
    return F.lit(True) if predicate is None else predicate


def filter_rows(df: DataFrame, config: Mapping[str, Any] | None, **options: Any) -> DataFrame:
    return df.filter(compile_filter(df, config, **options))
