"""SQL texts of rules, checked before they run.

A text is parsed by Spark and its tree walked: only literals, columns of the view, operators and
the functions named below may occur. Subqueries, windows, lambdas, parameters, stars, other
functions and columns the view does not have are refused, before anything runs.
"""

from __future__ import annotations

from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Node kinds of parsed expressions, and functions, that a rule's text may hold.
ALLOWED_NODES = frozenset((
    "Concat", "Literal", "UnresolvedAttribute", "UnresolvedFunction", "UnresolvedExtractValue",
    "And", "Or", "Not", "EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual", "GreaterThan",
    "GreaterThanOrEqual", "In", "Between", "IsNull", "IsNotNull", "IsTrue", "IsFalse", "IsUnknown",
    "IsNotUnknown", "Like", "ILike", "LikeAll", "LikeAny", "NotLikeAll", "NotLikeAny", "RLike",
    "Add", "Subtract", "Multiply", "Divide", "IntegralDivide", "Remainder", "UnaryMinus",
    "UnaryPositive", "Cast", "CaseWhen", "If", "BitwiseAnd", "BitwiseOr", "BitwiseXor", "BitwiseNot",
))
ALLOWED_FUNCTIONS = frozenset((
    "abs", "array", "array_contains", "arrays_overlap", "between", "ceil", "coalesce", "concat",
    "concat_ws",
    "contains", "date_add", "date_sub", "datediff", "endswith", "floor", "greatest", "if", "ifnull",
    "isnotnull", "isnull", "least", "length", "lower", "ltrim", "nullif", "nvl", "regexp_like",
    "replace", "round", "rtrim", "size", "split", "startswith", "substr", "substring", "to_date",
    "to_timestamp", "trim", "upper",
))


class SqlTextError(ValueError):
    """A rule's SQL text that may not run."""


def _items(sequence: Any) -> list[Any]:
    return [sequence.apply(i) for i in range(sequence.size())]


def _known(parts: list[str], schema: T.StructType) -> bool:
    """Whether the parts name a column, or a field within struct columns; case is ignored."""
    kind: T.DataType = schema
    for part in parts:
        if not isinstance(kind, T.StructType):
            return False
        found = [f.dataType for f in kind if f.name.lower() == part.lower()]
        if not found:
            return False
        kind = found[0]
    return True


def check_sql_text(df: DataFrame, text: str) -> str:
    """``text`` itself, if all it holds is allowed over the columns of ``df``.

    Raises ``SqlTextError`` for what is not: text that cannot be parsed, a kind of expression or a
    function that is not listed, or a column ``df`` does not have.
    """
    try:
        parser = df.sparkSession._jsparkSession.sessionState().sqlParser()
        waiting = [parser.parseExpression(text)]
    except ParseException as error:
        raise SqlTextError(f"not an SQL expression: {text!r}") from error
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName().rstrip("$")
        if kind not in ALLOWED_NODES:
            raise SqlTextError(f"{kind} is not allowed in {text!r}")
        if kind == "UnresolvedFunction":
            parts = _items(node.nameParts())
            if len(parts) > 1 or parts[0].lower() not in ALLOWED_FUNCTIONS:
                raise SqlTextError(f"function {'.'.join(parts)!r} is not allowed in {text!r}")
            if node.isDistinct() or node.filter().isDefined():
                raise SqlTextError(f"aggregates are not allowed in {text!r}")
        if kind == "UnresolvedAttribute":
            parts = _items(node.nameParts())
            if not _known(parts, df.schema):
                raise SqlTextError(f"unknown column {'.'.join(parts)!r} in {text!r}")
        waiting += _items(node.children())
    return text
