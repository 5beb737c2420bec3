"""Runs that only look again at the findings that changed.

A run keeps one digest per finding, of its rows in all tables that have the finding's id, and one
per key of the other tables: the sum of the rows' hashes. The next run compares digests by key and
follows the keys that differ to the findings whose rows of the view they can change. Only those are joined, tested against
the rules and assigned again; the rest of the assignment is carried over. Group counts are not
counted again: the rows that the affected findings had are taken off, those they have now
are added, and groups without any row left are gone. What a step shuffles is removed when its table
is written (``skew.shuffles_removed``).

Digests, assignment and counts of a run are one version of a folder (``VersionedTables``): a run
that fails leaves the last version as it was, and the next run starts from there. Other rules or
options than those of the last version make a full run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulefold.operators.assign import GROUP_KEY, RULE_NUMBER, assign_rules
from rulefold.operators.base_view import base_findings
from rulefold.operators.groups import Grouping, association, group_counts, rollup_of_counts
from rulefold.operators.skew import copies_of, shuffles_removed
from rulefold.sources.rules import Rule, in_order
from rulefold.sources.versions import Version, VersionedTables

# The tables of the view: by the finding's id, and by other keys.
BY_FINDING = {
    "findings": "id", "findings_scores": "finding_id", "user_status": "id", "findings_additional_data": "finding_id",
    "finding_sla_rule_connections": "finding_id", "findings_info": "id", "finding_ticket_associations": "finding_id",
    "user_sla": "id",
}
BY_OTHER_KEY = {
    "plain_resources": "id", "resource_to_scopes": "resource_id", "aggregation_groups": "id", "statuses": "key",
    "scoring_rules": "id", "selection_rules": "id", "tickets": "id", "scope_groups": "id",
}

# Named with every version: a run compares with digests of its own form only.
DIGESTS = "sums modulo 2**64, one per finding over its tables"


def _hashed_rows(df: DataFrame, key: str, seed: str = "") -> DataFrame:
    """``key`` and a hash of every row that has one; rows without a key join nothing. Equal rows
    with another ``seed`` have another hash."""
    parts = [F.lit(seed)] if seed else []
    for name in sorted(df.columns):
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType)):
            parts.append(F.to_json(F.struct(column), {"ignoreNullFields": "false"}))
        else:  # a hash passes over nulls
            parts += [column, column.isNull()]
    return df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.xxhash64(*parts).alias("__row"))


def _summed(rows: DataFrame, *also: Column) -> DataFrame:
    """``key, digest``: the sum of the hashes, modulo 2**64. Halves are summed, each exactly, in
    64 bits, and then put together without what is carried out."""
    high, low = F.sum(F.shiftright("__row", 32)), F.sum(F.col("__row").bitwiseAND(0xFFFFFFFF))
    summed = rows.groupBy("key").agg(high.alias("__high"), low.alias("__low"), *also)
    whole = F.shiftleft(F.col("__high") + F.shiftright("__low", 32), 32).bitwiseOR(F.col("__low").bitwiseAND(0xFFFFFFFF))
    return summed.withColumn("digest", whole).drop("__high", "__low")


def table_digests(df: DataFrame, key: str) -> DataFrame:
    """``key, digest``: what the rows of each key are, whatever their order, and how many."""
    return _summed(_hashed_rows(df, key))


def finding_digests(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """``key, digest`` of the findings, over their rows in all tables of ``keys``. Rows of ids that
    are no finding's change nothing, and are left out: should the finding come, it is new."""
    parts = [_hashed_rows(tables[t], k, t).withColumn("__own", F.lit(t == "findings")) for t, k in keys.items()]
    summed = _summed(reduce(DataFrame.unionByName, parts), F.bool_or("__own").alias("__own"))
    return summed.where("__own").drop("__own")


def all_digests(tables: Mapping[str, DataFrame], by_finding: Mapping[str, str], by_other_key: Mapping[str, str]) -> DataFrame:
    """``table, key, digest``: of findings over all their tables, as those of ``findings``, and of
    each other table by its own key."""
    digests = {"findings": finding_digests(tables, by_finding)} | {t: table_digests(tables[t], k) for t, k in by_other_key.items()}
    return reduce(DataFrame.unionByName, [d.select(F.lit(t).alias("table"), "*") for t, d in digests.items()])


def changed_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """The keys (with their ``table``, if they have one) whose digests differ, or that only one
    side has. Needs no sorted join."""
    by = [c for c in ("table", "key") if c in before.columns]
    both = before.select(*by, "digest").unionByName(after.select(*by, "digest")).groupBy(*by)
    sides = both.agg(F.count(F.lit(1)).alias("sides"), F.bit_xor("digest").alias("digest"))
    return sides.where("sides <> 2 OR digest <> 0").select(*by)


def affected_findings(tables: Mapping[str, DataFrame], changed: Mapping[str, DataFrame]) -> DataFrame:
    """``finding_id`` of all findings whose rows of the view the changed keys can change."""

    def pointing(table: str, column: str, keys: DataFrame | None, found: str) -> DataFrame | None:
        if keys is None or table not in tables:
            return None
        rows = tables[table].select(F.col(column).cast("long").alias("key"), F.col(found).cast("long").alias("found"))
        return rows.join(keys, "key", "left_semi").select(F.col("found").alias("key"))

    def united(*parts: DataFrame | None) -> DataFrame | None:
        stated = [p for p in parts if p is not None]
        return reduce(DataFrame.unionByName, stated) if stated else None

    scoped = None
    if "scope_groups" in changed and "resource_to_scopes" in tables:
        listed = tables["resource_to_scopes"].select("resource_id", F.explode(F.col("scope_ids").cast("array<long>")).alias("key"))
        scoped = listed.join(changed["scope_groups"], "key", "left_semi").select(F.col("resource_id").cast("long").alias("key"))
    resources = united(changed.get("plain_resources"), changed.get("resource_to_scopes"), scoped)
    scoring = united(changed.get("scoring_rules"), pointing("scoring_rules", "selection_rule_id", changed.get("selection_rules"), "id"))
    ids = united(
        *(changed.get(table) for table in BY_FINDING),
        pointing("findings", "main_resource_id", resources, "id"),
        pointing("findings", "aggregation_group_id", changed.get("aggregation_groups"), "id"),
        pointing("user_status", "actual_status_key", changed.get("statuses"), "id"),
        pointing("findings_scores", "scoring_rule_id", scoring, "finding_id"),
        pointing("finding_ticket_associations", "ticket_id", changed.get("tickets"), "finding_id"),
    )
    return ids.select(F.col("key").alias("finding_id")).distinct()


def signed_counts(counts: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """Group counts after the rows ``gone`` are taken off and the rows ``come`` added."""
    group = [RULE_NUMBER, GROUP_KEY]
    parts = [counts.select(*group, "findings_count")]
    for rows, sign in ((gone, -1), (come, 1)):
        parts.append(rows.select(*group, (sign * copies_of(rows)).alias("findings_count")))
    summed = reduce(DataFrame.unionByName, parts).groupBy(*group).agg(F.sum("findings_count").alias("findings_count"))
    return summed.where("findings_count > 0")


@dataclass(frozen=True)
class IncrementalRun:
    """The version a run wrote, whether it was a full run, and its outputs."""

    version: Version
    full: bool
    grouping: Grouping
    affected: DataFrame | None


def run_incrementally(
    spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule], folder: str, **options: Any
) -> IncrementalRun:
    """The groups of ``tables``, as a full run gives them; ``options`` are those of
    ``assign_rules``. Raises ``StaleRun`` where another run was committed meanwhile."""
    store = VersionedTables(spark, folder)
    draft, last = store.begin(), store.current()
    excluder = options.get("excluder")
    plain = {k: v for k, v in options.items() if k not in ("excluder", "shares", "index")}
    facts = {"digests": DIGESTS, "rules": hashlib.md5(repr((in_order(rules), sorted(plain.items()), sorted(tables))).encode()).hexdigest()}
    by_finding, by_other_key = ({t: k for t, k in keys.items() if t in tables} for keys in (BY_FINDING, BY_OTHER_KEY))
    now = dict(tables)
    if excluder is not None:
        by_finding["excluder"], now["excluder"] = "finding_id", excluder

    def write(name: str, df: DataFrame) -> DataFrame:
        with shuffles_removed(spark):
            draft.write(name, df)
        return spark.read.schema(df.schema).parquet(f"{draft.data}/{name}")

    digests = write("digests", all_digests(now, by_finding, by_other_key))
    full = last is None or last.facts != facts
    affected = None
    if full:
        assigned = write("assigned", assign_rules(base_findings(tables, weighted=True), rules, **options))
        write("counts", group_counts(assigned))
    else:
        before = store.read("digests", "assigned", "counts", number=last.number)
        found = write("changed", changed_keys(before["digests"], digests))
        changed = {t: found.where(F.col("table") == t).select("key") for t in ("findings", *by_other_key)}
        affected = write("affected", affected_findings(tables, changed))
        narrowed = {
            name: df.join(affected.withColumnRenamed("finding_id", BY_FINDING[name]), BY_FINDING[name], "left_semi") if name in BY_FINDING else df
            for name, df in tables.items()
        }
        come = write("reassigned", assign_rules(base_findings(narrowed, weighted=True), rules, **options))
        kept = before["assigned"].join(affected, "finding_id", "left_anti")
        gone = before["assigned"].join(affected, "finding_id", "left_semi")
        write("assigned", kept.select(*come.columns).unionByName(come))
        write("counts", signed_counts(before["counts"], gone, come))
    version = store.commit(draft, facts)
    done = store.read("assigned", "counts", number=version.number)
    outputs = Grouping(association(done["assigned"]), rollup_of_counts(done["counts"]), done["assigned"])
    return IncrementalRun(version, full, outputs, affected)

