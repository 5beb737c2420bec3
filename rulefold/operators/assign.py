"""Ordered, exclusive rules in one pass.

A finding belongs to the first rule, in order, that any of its rows passes; its rows
that pass that rule form groups by the rule's columns, and later rules do not see it.

Each row gets the number of the first rule it passes (one CASE over all rules), and a
finding keeps the rows with its smallest number. Rows that survive are exactly those
passing the winning rule: passing it means their own first rule is at most the winner,
and none is smaller. Whatever the number of rules, rows are shuffled by finding once
(not at all where they already are, as in the base view), where a loop would anti-join the
whole input again for every rule. The CASE itself grows with the rules, per row; longer lists
are therefore searched through an index (``operators.rule_index``), which gives the same rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulefold.functions.identity import group_key
from rulefold.functions.predicates import FilterCompiler, FilterError
from rulefold.operators.exclusions import excluded_rules, is_excluded, with_excluded_rules
from rulefold.operators.rule_index import Anchor, Demand, anchors_of, candidate_words, first_passing
from rulefold.operators.skew import COPIES, copies_of
from rulefold.schemas import TABLES
from rulefold.sources.rules import Rule, in_order

RULE_NUMBER = "rule_number"
GROUP_KEY = "group_key"
FANOUT_MODES = ("rows", "distinct")
INDEX_FROM = 16
_RULE_SET = "__rule_set"
_FIRST = "__first_rule"

Rules = Sequence[Rule] | Mapping[str, Sequence[Rule]]


@dataclass(frozen=True)
class _Step:
    """A rule ready to run: its position among all rules, predicate and group columns."""

    number: int
    predicate: Column
    columns: tuple[str, ...]
    demand: Demand | None


def group_columns(rule: Rule, df: DataFrame, compiler: FilterCompiler) -> tuple[str, ...]:
    """The rule's group-by columns without table prefix; all must exist."""
    missing, columns = [], []
    for name in rule.group_by:
        try:
            columns.append(compiler.fields.resolve(_finding_key(name)))
        except FilterError:
            missing.append(name)
    if missing:
        raise ValueError(f"rule {rule.id}: missing columns {missing}; known: {df.columns}")
    return tuple(columns)


def _finding_key(name: str) -> str:
    """The bare column name; ``findings.id`` means the finding, not a scope."""
    return "finding_id" if name == "findings.id" else name.rsplit(".", 1)[-1]


def with_table_structs(df: DataFrame) -> DataFrame:
    """Add one struct per source table, so that SQL text may say ``findings.source``.

    Catalyst replaces the field accesses by the plain columns. ``cve`` becomes an array
    whose entry 1 is the first CVE, as in the SQL such texts were written for.
    """
    structs = {}
    for table in TABLES:
        schema = TABLES[table]
        fields = []
        for f in schema:
            name = f.metadata.get("alias", f.name)
            if table == "findings" and f.name == "category" and "finding_category" in df.columns:
                name = "finding_category"
            if name in df.columns:
                value = F.col(name)
                if f.name == "cve":
                    value = F.array(F.lit(None).cast("string"), value)
                fields.append(value.alias(f.name))
        if fields:
            structs[table] = F.struct(*fields)
    return df.withColumns({t: s for t, s in structs.items() if t not in df.columns})


def assign_rules(
    df: DataFrame,
    rules: Rules,
    *,
    payload: Sequence[str] = ("cloud_account",),
    fanout: str = "rows",
    unique_ids: bool = False,
    tenant: str | None = None,
    excluder: DataFrame | None = None,
    field_map: Mapping[str, str] | None = None,
    strict: bool = False,
    use_sql_filters: bool = False,
    index: bool | None = None,
    shares: Mapping[Anchor, float] | None = None,
) -> DataFrame:
    """Give each finding its rule and group key.

    Returns ``[tenant,] finding_id, rule_number, group_key, *payload`` and, unless every
    row stands for itself alone, ``row_copies``: equal rows are counted together.
    ``rule_number`` is the position in the sorted list of all rules. Findings no rule takes
    are absent.

    fanout: ``rows`` keeps a finding as often as it occurs, ``distinct`` once per group
        (with the smallest payload values).
    unique_ids: the input has one row per finding, so no rows have to be compared.
    tenant: a column that is part of the finding's identity. ``rules`` may then map each
        tenant to its own rules.
    excluder: ``(finding_id, aggregation_rule_id)`` pairs that must not meet.
    index: whether rows only test the rules that an index finds for them; by default where
        there are ``INDEX_FROM`` rules or more. The result is the same.
    shares: how often the values that rules ask for occur (``rule_index.measured_shares``), for
        the choice of the conditions in the index.
    """
    if fanout not in FANOUT_MODES:
        raise ValueError(f"unknown fanout {fanout!r}; known: {FANOUT_MODES}")
    if isinstance(rules, Mapping) and tenant is None:
        raise ValueError("rules by tenant need the name of the tenant column")
    finding = ([tenant] if tenant else []) + ["finding_id"]
    df = df.where(F.col("finding_id").isNotNull())
    if excluder is not None:
        all_rules = rules.values() if isinstance(rules, Mapping) else [rules]
        ids = sorted({r.id for some in all_rules for r in some})
        df = with_excluded_rules(df, excluded_rules(excluder, ids, tenant), tenant)
    scope = with_table_structs(df) if _mentions_sql(rules, use_sql_filters) else df
    compiler = FilterCompiler(scope, field_map, strict)

    def steps(ordered: Sequence[Rule]) -> list[_Step]:
        taking = [(n, r) for n, r in enumerate(in_order(ordered)) if r.group_by]
        indexed = len(taking) >= INDEX_FROM if index is None else index
        demands = anchors_of([r.filters for _, r in taking], compiler.fields, shares) if indexed else [None] * len(taking)
        return [
            _Step(n, _predicate(r, compiler, excluder is not None, use_sql_filters), group_columns(r, scope, compiler), demand)
            for (n, r), demand in zip(taking, demands, strict=True)
        ]

    if isinstance(rules, Mapping):
        scope, sets = _with_rule_sets(scope, rules, tenant)
        compiled = [steps(some) for some in sets]
        words = [_words_of(s, n) for n, s in enumerate(compiled)]
        number = _first_of([(F.col(_RULE_SET) == n, _first_rule(s, w)) for n, (s, w) in enumerate(zip(compiled, words, strict=True))])
        key = _first_of([(F.col(_RULE_SET) == n, _key_of(s)) for n, s in enumerate(compiled)])
        several = any(len(s) > 1 for s in compiled)
    else:
        all_steps = steps(rules)
        words = [_words_of(all_steps)]
        number, key, several = _first_rule(all_steps, words[0]), _key_of(all_steps), len(all_steps) > 1

    number = number.cast("int")
    if any(words):
        # the rule is projected, which Spark compiles; behind a generator it is computed once,
        # wherever it is used
        scope = scope.withColumns({name: word for some in words for name, word in some.items()})
        scope = scope.withColumn(_FIRST, F.array(number))
        number = F.explode_outer(_FIRST)
    weights = [COPIES] if COPIES in df.columns and fanout == "rows" else []
    matched = (
        scope.withColumn(RULE_NUMBER, number)
        .where(F.col(RULE_NUMBER).isNotNull())
        .select(*finding, RULE_NUMBER, key.cast("array<string>").alias(GROUP_KEY), *payload, *weights)
    )
    if unique_ids:
        return matched

    # equal rows become one before findings are compared, also on the map side
    by_group = [*finding, RULE_NUMBER, GROUP_KEY]
    if fanout == "rows":
        kept = matched.groupBy(*by_group, *payload).agg(F.sum(copies_of(matched)).alias(COPIES))
    else:
        kept = matched.groupBy(*by_group).agg(*[F.min(c).alias(c) for c in payload])
    if not several:
        return kept
    winner = F.min(RULE_NUMBER).over(Window.partitionBy(*finding))
    return kept.withColumn("__winner", winner).where(F.col(RULE_NUMBER) == F.col("__winner")).drop("__winner")


def _with_rule_sets(
    df: DataFrame, rules: Mapping[str, Sequence[Rule]], tenant: str
) -> tuple[DataFrame, list[list[Rule]]]:
    """``df`` with the number of its tenant's rule list, and the different lists: tenants
    with equal rules share one, so the plan grows with the lists and not with the tenants.
    Rows of tenants without rules drop out."""
    numbers: dict[str, int] = {}
    sets, rows = [], []
    for name, some in rules.items():
        ordered = in_order(some)
        number = numbers.setdefault(repr(ordered), len(sets))
        if number == len(sets):
            sets.append(ordered)
        rows.append((name, number))
    kind = df.schema[tenant].dataType.simpleString()
    table = df.sparkSession.createDataFrame(rows, f"__tenant {kind}, {_RULE_SET} int")
    # it comes from the driver and is sent to all tasks: a shuffle by tenant would leave all rows of
    # a tenant, and all steps that follow, to one task
    return df.join(F.broadcast(table), F.col(tenant) == F.col("__tenant")).drop("__tenant"), sets


def _mentions_sql(rules: Rules, use_sql_filters: bool) -> bool:
    every = [r for some in rules.values() for r in some] if isinstance(rules, Mapping) else rules
    return any((use_sql_filters and r.sql_filter) or r.filters.get("custom_sql") for r in every)


def _predicate(rule: Rule, compiler: FilterCompiler, excluding: bool, use_sql_filters: bool) -> Column:
    parts = [compiler.compile(rule.filters)]
    if use_sql_filters and rule.sql_filter:
        parts.append(compiler.sql(rule.sql_filter))
    if excluding:
        parts.append(~is_excluded(rule.id))
    predicate = F.lit(True)
    for part in parts:
        if part is not None:
            predicate = predicate & part
    return predicate


def _first_of(cases: Sequence[tuple[Column, Column]]) -> Column:
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return F.lit(None) if chain is None else chain


def _words_of(steps: Sequence[_Step], rule_set: int = 0) -> dict[str, Column]:
    """The candidates among the steps, by names of columns for them; empty without an index."""
    if all(s.demand is None for s in steps):
        return {}
    words = candidate_words({s.number: s.demand for s in steps})
    return {f"__candidates_{rule_set}_{n}": word for n, word in enumerate(words)}


def _first_rule(steps: Sequence[_Step], words: Mapping[str, Column]) -> Column:
    if words:
        return first_passing([F.col(name) for name in words], {s.number: s.predicate for s in steps})
    return _first_of([(s.predicate, F.lit(s.number)) for s in steps])


def _key_of(steps: Sequence[_Step]) -> Column:
    """The group key by rule number, one branch per distinct list of columns."""
    numbers: dict[tuple[str, ...], list[int]] = {}
    for step in steps:
        numbers.setdefault(step.columns, []).append(step.number)
    return _first_of([(F.col(RULE_NUMBER).isin(ns), group_key(list(cs))) for cs, ns in numbers.items()])
