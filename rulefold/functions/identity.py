"""Identifiers of groups, computed from the rule's position and the group's key.

A key is an array with the text of each group-by column, NULL where the column is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How keys are spelled inside identifiers.
ID_SEPARATOR = "-"
READABLE_SEPARATOR = "_"
NULL_TEXT = "null"

ID_STYLES = ("compat", "exact")


def group_key(columns: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("string") for c in columns])


def group_identifier(rule_number: Column, key: Column, style: str = "compat") -> Column:
    """The group's hash.

    ``compat`` is md5 over the parts joined by ``-``: keys holding ``-`` or the text
    ``null`` may share it. ``exact`` writes each part's length first, so that no two
    keys share their text, and takes sha-256.
    """
    number = rule_number.cast("string")
    if style == "compat":
        return F.md5(F.concat_ws(ID_SEPARATOR, number, spelled(key)))
    if style == "exact":
        parts = F.transform(
            key, lambda p: F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("!"))
        )
        return F.sha2(F.concat_ws("", F.concat(number, F.lit("/")), parts), 256)
    raise ValueError(f"unknown id style {style!r}; known: {ID_STYLES}")


def readable_identifier(key: Column) -> Column:
    return F.array_join(key, READABLE_SEPARATOR, NULL_TEXT)


def spelled(key: Column) -> Column:
    return F.array_join(key, ID_SEPARATOR, NULL_TEXT)


def run_identifier(rule_number: Column, key: Column, key_names: list[str], stamp: str) -> Column:
    """An identifier of the group within one run: rule, key, key columns and run time.

    The two empty parts between the column names and the stamp belong to the format.
    """
    return F.concat_ws(
        ID_SEPARATOR,
        rule_number.cast("string"),
        spelled(key),
        *[F.lit(name) for name in key_names],
        F.lit(""),
        F.lit(""),
        F.lit(stamp),
    )
