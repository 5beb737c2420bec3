"""Many rules over each row: an inverted index from values to the rules that need them.

The filter of most rules asks some column for one of a few values. A row without any of these
cannot pass, whatever else the filter says. Per rule, the rarest such demand becomes its
*anchors*, pairs of a column and a value; the anchors of 64 rules are held in one map per
column, literals of the plan. A row looks up its own values and has a bit for each rule found
there or without anchors. These alone are tested, in order, up to the first that passes; halves
of 64 bits without any are passed over. So the work per row follows the rules that may pass,
besides a look-up per column for every 64 rules of the list.

What a filter demands (``None`` where it filters nothing):

* ``equals``, ``in`` and flat entries: one of their values;
* ``overlap``, ``overlapilikelist``: one of their values among the list's entries;
* ``and``: what any of its operands demands; ``or``: one demand of each of its operands;
* all else (negations, ``contains``, ``exists``, SQL text) demands nothing.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulefold.functions.predicates import (
    ALL_FINDINGS_SCOPE,
    DESCRIPTIVE_KEYS,
    SQL_KEY,
    TREE_KEYS,
    Fields,
    is_known_condition,
    is_not_set,
    is_tree,
)

# How a column's values are looked up: itself, its entries, its entries in lower case.
VALUE, ENTRY, LOWERED = "value", "entry", "lowered"
KEYS_PER_SLOT = 4
RULES_PER_WORD = 64


@dataclass(frozen=True, order=True)
class Anchor:
    """A value that a row must have in a column."""

    column: str
    lookup: str
    text: str


Demand = frozenset[Anchor]  # at least one of these
Cost = Callable[[Demand], float]


@dataclass
class Demands:
    """What filters demand of the rows of one DataFrame."""

    fields: Fields
    seen: dict[tuple[str, str], set[str]] = field(default_factory=dict)

    def of(self, config: Mapping[str, Any] | None, cost: Cost) -> list[Demand] | None:
        """Demands each of which must be met; None where nothing is filtered."""
        if not config:
            return None
        if is_tree(config):
            return self._tree(config, cost)
        return _all_of([self._entry(key, value, cost) for key, value in config.items()])

    def _entry(self, key: str, value: Any, cost: Cost) -> list[Demand] | None:
        if key in DESCRIPTIVE_KEYS or key in ("operator", "operands") or is_not_set(value):
            return None
        if (key, value) == ALL_FINDINGS_SCOPE:
            return None
        if key in TREE_KEYS:
            return self._tree(value, cost)
        if key == SQL_KEY:
            return []
        return self._one_of(key, VALUE, value if isinstance(value, list) else [value])

    def _tree(self, node: Any, cost: Cost) -> list[Demand] | None:
        if isinstance(node, str):
            try:
                node = json.loads(node)
            except json.JSONDecodeError:
                return None
        if not isinstance(node, Mapping):
            return None
        if is_tree(node):
            parts = [self._tree(o, cost) for o in node["operands"] or []]
            return (_all_of if str(node["operator"]).lower() == "and" else _any_of(cost))(parts)
        if "field" not in node:
            return None
        value, condition = node.get("value"), node.get("condition")
        if isinstance(value, Mapping) and "field" in value:
            return self._tree(value, cost)
        if not is_known_condition(condition, value):
            return None
        if condition in ("equals", "in"):
            return self._one_of(node["field"], VALUE, value if condition == "in" else [value])
        if condition in ("overlap", "overlapilikelist"):
            return self._one_of(node["field"], ENTRY if condition == "overlap" else LOWERED, value)
        return []

    def _one_of(self, name: str, lookup: str, values: Sequence[Any]) -> list[Demand]:
        column, kind = self.fields.resolve(name), self.fields.type_of(name)
        if lookup != VALUE:
            kind = kind.elementType if isinstance(kind, T.ArrayType) else None
        texts = [_text(v, kind, lookup) for v in values if v is not None]
        if None in texts:
            return []
        self.seen.setdefault((column, lookup), set()).update(texts)
        return [frozenset(Anchor(column, lookup, t) for t in texts)]

    def rarity(self) -> Cost:
        """The share of rows that meet a demand, if each column had all its values as often."""
        return lambda demand: sum(1 / len(self.seen[a.column, a.lookup]) for a in demand)


def _text(value: Any, kind: T.DataType | None, lookup: str) -> str | None:
    """The value as Spark writes it as text; None where that is not certain."""
    text = str(value)
    if isinstance(kind, T.StringType):
        return text if lookup != LOWERED else text.lower() if text.isascii() else None
    if isinstance(kind, T.IntegralType) and lookup != LOWERED:
        return str(int(text))
    if isinstance(kind, T.BooleanType) and lookup != LOWERED:
        return text.lower()
    return None


def _all_of(parts: Sequence[list[Demand] | None]) -> list[Demand] | None:
    stated = [p for p in parts if p is not None]
    return [demand for part in stated for demand in part] if stated else None


def _any_of(cost: Cost) -> Callable[[Sequence[list[Demand] | None]], list[Demand] | None]:
    def united(parts: Sequence[list[Demand] | None]) -> list[Demand] | None:
        stated = [p for p in parts if p is not None]
        if not stated:
            return None
        if not all(stated):
            return []
        return [frozenset().union(*(min(p, key=cost) for p in stated))]

    return united


def anchors_of(
    filters: Sequence[Mapping[str, Any] | None], fields: Fields, shares: Mapping[Anchor, float] | None = None
) -> list[Demand | None]:
    """For each filter its rarest demand, None where it has none. ``shares`` are the shares of
    rows that have an anchor, as ``measured_shares`` gives them."""
    demands = Demands(fields)
    for config in filters:
        demands.of(config, len)
    cost = demands.rarity() if shares is None else lambda demand: sum(shares.get(a, 0.0) for a in demand)
    chosen = []
    for config in filters:
        known = demands.of(config, cost)
        chosen.append(min(known, key=cost) if known else None)
    return chosen


def all_anchors(filters: Sequence[Mapping[str, Any] | None], fields: Fields) -> set[Anchor]:
    demands = Demands(fields)
    for config in filters:
        demands.of(config, len)
    return {Anchor(column, lookup, text) for (column, lookup), texts in demands.seen.items() for text in texts}


def measured_shares(df: DataFrame, anchors: set[Anchor]) -> dict[Anchor, float]:
    """The share of the rows of ``df`` that have each anchor: one pass, combined map-side, whose
    result has a row per anchor at most."""
    if not anchors:
        return {}
    parts = []
    for column, lookup in sorted({(a.column, a.lookup) for a in anchors}):
        wanted = sorted(a.text for a in anchors if (a.column, a.lookup) == (column, lookup))
        found = F.array_intersect(_texts(column, lookup), F.array(*map(F.lit, wanted)))
        named = F.transform(found, partial(_named, column, lookup))
        parts.append(F.coalesce(named, F.array().cast("array<struct<c:string,k:string,t:string>>")))
    rows = df.select(F.explode(F.concat(F.array(_named("", "", F.lit(""))), *parts)).alias("a"))
    counts = {(r.c, r.k, r.t): r["n"] for r in rows.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select("a.*", "n").collect()}
    total = counts.pop(("", "", ""), 0) or 1
    return {Anchor(*key): n / total for key, n in counts.items()}


def _named(column: str, lookup: str, text: Column) -> Column:
    return F.struct(F.lit(column).alias("c"), F.lit(lookup).alias("k"), text.alias("t"))


def _texts(column: str, lookup: str) -> Column:
    """The values of a row's column as an array of text."""
    own = F.col(f"`{column}`")
    if lookup == VALUE:
        return F.array(own.cast("string"))
    entries = own.cast("array<string>")
    return entries if lookup == ENTRY else F.transform(entries, lambda entry: F.lower(entry))


def _numbers_by_anchor(demands: Mapping[int, Demand | None]) -> dict[tuple[str, str], dict[str, list[int]]]:
    """By column and lookup, the rules of each text, ascending."""
    index: dict[tuple[str, str], dict[str, list[int]]] = {}
    for number, demand in sorted(demands.items()):
        for anchor in demand or ():
            index.setdefault((anchor.column, anchor.lookup), {}).setdefault(anchor.text, []).append(number)
    return dict(sorted(index.items()))


def _held(values: Mapping[str, Any], slots: int, kind: str) -> Column:
    """One literal: a map is searched from its front, so its keys are dealt to small maps."""
    table: list[dict[str, Any]] = [{} for _ in range(slots)]
    for text, value in values.items():
        table[zlib.crc32(text.encode()) % slots][text] = value
    return F.from_json(F.lit(json.dumps(table)), f"array<map<string,{kind}>>")


def candidate_rules(demands: Mapping[int, Demand | None]) -> Column:
    """The numbers of the rules a row may pass, ascending."""
    none = F.array().cast("array<int>")
    parts = [F.array(*(F.lit(n) for n, demand in sorted(demands.items()) if demand is None)).cast("array<int>")]
    for (column, lookup), rules_of in _numbers_by_anchor(demands).items():
        slots = max(1, len(rules_of) // KEYS_PER_SLOT)
        found = partial(_found, _held(rules_of, slots, "array<int>"), slots, none)
        if lookup == VALUE:
            parts.append(found(F.col(f"`{column}`").cast("string")))
        else:
            parts.append(F.coalesce(F.flatten(F.transform(_texts(column, lookup), lambda text: found(text))), none))
    return F.sort_array(F.array_distinct(F.concat(*parts)))


def candidate_words(demands: Mapping[int, Demand | None]) -> list[Column]:
    """The rules a row may pass as bits, ``RULES_PER_WORD`` rules in their order to a word.

    Words are to be columns of their own: ``first_passing`` looks at them many times.
    """
    at = {number: place for place, number in enumerate(sorted(demands))}
    none = F.lit(0).cast("long")
    index = _numbers_by_anchor(demands)
    words = []
    for first in range(0, len(at), RULES_PER_WORD):
        parts = [F.lit(_word(at[n] - first for n, demand in demands.items() if demand is None)).cast("long")]
        for (column, lookup), rules_of in index.items():
            values = {text: _word(at[n] - first for n in numbers) for text, numbers in rules_of.items()}
            values = {text: value for text, value in values.items() if value}
            if not values:
                continue
            slots = max(1, len(values) // KEYS_PER_SLOT)
            found = partial(_found, _held(values, slots, "bigint"), slots, none)
            if lookup == VALUE:
                parts.append(found(F.col(f"`{column}`").cast("string")))
            else:
                united = partial(_united, found)
                parts.append(F.coalesce(F.aggregate(_texts(column, lookup), none, lambda word, text: united(word, text)), none))
        words.append(reduce(Column.bitwiseOR, parts))
    return words


def _united(found: Callable[[Column], Column], word: Column, text: Column) -> Column:
    return word.bitwiseOR(found(text))


def _word(places: Iterable[int]) -> int:
    """Bits as a signed number; places of other words are left out."""
    bits = sum(1 << place for place in set(places) if 0 <= place < RULES_PER_WORD)
    return bits - (1 << RULES_PER_WORD) if bits >> (RULES_PER_WORD - 1) else bits


def _found(held: Column, slots: int, none: Column, text: Column) -> Column:
    slot = F.get(held, (F.crc32(text.cast("binary")) % slots).cast("int"))
    return F.coalesce(F.try_element_at(slot, text), none)


def first_passing(words: Sequence[Column], predicates: Mapping[int, Column]) -> Column:
    """The least number whose predicate holds. Only the candidates before it are tested: halves
    of a word without any are passed over. No lambda, so that Spark compiles all of it."""
    numbers = sorted(predicates)
    if not numbers:
        return F.lit(None)

    def among(word: Column, first: int, low: int, high: int) -> Column:
        if high - low == 1:
            passed = F.when(predicates[numbers[low]], F.lit(numbers[low]))
        else:
            middle = (low + high) // 2
            passed = F.coalesce(among(word, first, low, middle), among(word, first, middle, high))
        mask = F.lit(_word(range(low - first, high - first))).cast("long")
        return F.when(word.bitwiseAND(mask) != 0, passed)

    starts = range(0, len(numbers), RULES_PER_WORD)
    return F.coalesce(
        *(among(w, s, s, min(s + RULES_PER_WORD, len(numbers))) for w, s in zip(words, starts, strict=True))
    )
