"""Group summaries: what a group of findings reports as its own fields.

Every summary is a built-in aggregate that combines map-side, so a group may be of any
size. The most common value, which is not, is counted per (group, field, value) first,
so a hot group's counts spread over the values. Results do not depend on row order:
"first" means the finding with the lowest id, and ties go to the lowest value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulefold.operators.skew import COPIES, copies_of, materialize

# Status categories, and the key that stands for "open, without a status".
OPEN, FIXED, IGNORED = "OPEN", "FIXED", "IGNORED"
OPEN_DUMMY_KEY = -1
STATUS = "status_category"
FINDING = "finding_id"


def is_open() -> Column:
    return F.col(STATUS) == OPEN


def first_open(field: str) -> Column:
    """The value of the lowest open finding that has one."""
    with_value = F.when(is_open() & F.col(field).isNotNull(), F.struct(FINDING, field))
    return F.min(with_value)[field]


def first_open_or_empty(field: str) -> Column:
    return F.coalesce(first_open(field), F.lit(""))


def same_or_default(field: str, default: str = "") -> Column:
    """The value, where all that are set agree, else the default. For text columns."""
    return F.when(F.min(field) == F.max(field), F.min(field)).otherwise(F.lit(default))


def open_else(field: str, pick: Callable[[str | Column], Column]) -> Column:
    """``pick`` (min or max) over open findings; over all where no open one has a value."""
    return F.coalesce(pick(F.when(is_open(), F.col(field))), pick(field))


def min_key_in(category: str, field: str) -> Column:
    return F.min(F.when(F.col(STATUS) == category, F.col(field)))


def min_closed_user_status() -> Column:
    """Smallest user status of closed findings; the dummy key once any finding is not closed
    or has no user status."""
    closed = F.col(STATUS).isin(FIXED, IGNORED) & F.col("user_status_key").isNotNull()
    return F.min(F.when(closed, F.col("user_status_key")).otherwise(F.lit(OPEN_DUMMY_KEY)))


def min_open_user_status() -> Column:
    """Smallest user status of open findings, the dummy key standing in where one has none."""
    key = F.coalesce(F.col("user_status_key"), F.lit(OPEN_DUMMY_KEY))
    return F.min(F.when(is_open(), key))


def max_open(field: str) -> Column:
    return F.max(F.when(is_open(), F.col(field)))


def flag(field: str) -> Column:
    """First open value, else whether any finding has the flag."""
    return F.coalesce(first_open(field), F.bool_or(field))


@dataclass(frozen=True)
class Summary:
    """An output column: a map-side combinable aggregate, a most common value, or both.

    With both, the most common value fills in where the aggregate is NULL. ``reads`` names
    the columns of the aggregate, beyond finding id and status.
    """

    name: str
    aggregate: Callable[[], Column] | None = None
    mode_of: str | None = None
    reads: tuple[str, ...] = ()


# Output columns, the summaries behind them, and their order.
FIRST_OPEN_OR_MODE = [
    "category", "sub_category", "rule_id", "fix_type", "fix_subtype", "fix_vendor_id",
    "rule_family", "rule_type", "finding_type_str", "source", "datasource_id",
    "datasource_definition_id",
]
SAME_OR_DEFAULT = ["image_id", "scan_id", "resource_reported_not_exist"]
OPEN_ELSE_MIN_TIMES = ["discovered_time", "created_time"]
STATUS_KEYS = {OPEN: "open", FIXED: "fixed", IGNORED: "ignored"}
OPEN_MAXIMA = ["score", "severity", "user_score", "normalized_score", "factorized_score"]
OPTIONAL_FLAGS = ["cisa_kev", "vulncheck_kev", "is_fixable", "has_exploit"]
OPTIONAL_DATE = "vulnerability_reported_date"

# View columns that go by another name than the summary's.
_VIEW_NAMES = {"category": "finding_category", "finding_type_str": "finding_type"}


def all_summaries(df: DataFrame) -> list[Summary]:
    """The full set, reading columns ``df`` has. Flags that ``df`` lacks are false, the date NULL."""

    def column(field: str) -> str:
        renamed = _VIEW_NAMES.get(field, field)
        return renamed if renamed in df.columns else field

    def plain(name: str, make: Callable[..., Column], *args) -> Summary:
        reads = tuple(a for a in args if a in df.columns)
        return Summary(name, lambda: make(*args), reads=reads)

    def first_open_or_mode(name: str) -> Summary:
        field = column(name)
        return Summary(name, lambda: first_open(field), field, (field,))

    out = [first_open_or_mode(f) for f in FIRST_OPEN_OR_MODE]
    out += [plain("fix_id", F.max, "fix_id"), Summary("package_name", mode_of="package_name")]
    out += [plain(f, same_or_default, f) for f in SAME_OR_DEFAULT]
    out += [plain("original_finding_id", F.lit, "")]
    out += [plain("last_reported_time", open_else, "last_reported_time", F.max)]
    out += [plain(f, open_else, f, F.min) for f in OPEN_ELSE_MIN_TIMES]
    for category, prefix in STATUS_KEYS.items():
        for kind in ("system", "user"):
            out.append(plain(f"{prefix}_{kind}_status_key", min_key_in, category, f"{kind}_status_key"))
    for make in (min_closed_user_status, min_open_user_status):
        out.append(Summary(make.__name__, make, reads=("user_status_key",)))
    out += [plain(f"max_open_{f}", max_open, f) for f in OPEN_MAXIMA]
    out += [plain("max_score", F.max, "score"), plain("max_severity", F.max, "severity")]
    out += [plain("main_resource_id", open_else, "main_resource_id", F.min)]
    out += [plain("original_score", first_open, "original_score")]
    out += [plain("original_status", first_open_or_empty, "original_status")]
    for name in OPTIONAL_FLAGS:
        out.append(plain(name, flag, name) if name in df.columns else plain(name, F.lit, False))
    if OPTIONAL_DATE in df.columns:
        out.append(plain(OPTIONAL_DATE, F.min, OPTIONAL_DATE))
    else:
        out.append(Summary(OPTIONAL_DATE, lambda: F.lit(None).cast("date")))
    return out


def summary_inputs(df: DataFrame, only: Sequence[str]) -> list[str]:
    """The columns of ``df`` that the summaries named ``only`` read."""
    by_name = {s.name: s for s in all_summaries(df)}
    read = [FINDING, STATUS]
    for name in only:
        read += [*by_name[name].reads, *([by_name[name].mode_of] if by_name[name].mode_of else [])]
    return list(dict.fromkeys(read))


def summarize(
    df: DataFrame,
    group_by: Sequence[str],
    summaries: Iterable[Summary] | None = None,
    only: Sequence[str] | None = None,
    stored: bool = False,
) -> DataFrame:
    """One row per group with its summaries (all of them by default, or those named ``only``).

    Weighted rows (``row_copies``) count as often as they stand for. Aggregates and most
    common values take one pass each; unless ``df`` is ``stored``, and so cheap to read
    twice, the columns both need are computed once and kept (see ``skew.materialize``).
    """
    wanted = list(all_summaries(df) if summaries is None else summaries)
    if only is not None:
        by_name = {s.name: s for s in wanted}
        wanted = [by_name[n] for n in only]
    modes = [s for s in wanted if s.mode_of]
    direct = [s for s in wanted if s.aggregate]

    # group columns under names of their own, as summaries may reuse them
    keys = [f"__group_{n}" for n in range(len(group_by))]
    df = df.withColumns({k: F.col(c) for k, c in zip(keys, group_by)})
    if direct and modes and not stored:
        needed = {FINDING, STATUS, COPIES, *(r for s in wanted for r in s.reads), *(s.mode_of for s in modes)}
        df = materialize(df.select(*keys, *[c for c in df.columns if c in needed]))
    grouped = df.groupBy(*keys)
    parts = grouped.agg(*[s.aggregate().alias(f"__{s.name}") for s in direct]) if direct else None
    if modes:
        counted = most_common(df, keys, {f"__mode_{s.name}": s.mode_of for s in modes})
        parts = counted if parts is None else _same_groups(parts, counted, keys)

    def result(s: Summary) -> Column:
        both = [F.col(f"__{s.name}")] if s.aggregate else []
        both += [F.col(f"__mode_{s.name}")] if s.mode_of else []
        return F.coalesce(*both).alias(s.name) if len(both) > 1 else both[0].alias(s.name)

    group_names = [F.col(k).alias(c if c not in {s.name for s in wanted} else f"group_{c}")
                   for k, c in zip(keys, group_by)]
    return parts.select(*group_names, *[result(s) for s in wanted])


def most_common(df: DataFrame, group_by: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """The most common value of each field per group, the lowest among equals.

    ``fields`` maps output names to columns. Exact, in two steps that both combine
    map-side: count each value of each field, then take the best count. No group's
    values are ever held in one place, as they are in ``mode``.
    """
    types = {f.name: f.dataType for f in df.schema}
    numeric = {out: isinstance(types[c], T.IntegralType) for out, c in fields.items()}
    entries = [
        F.struct(
            F.lit(n).alias("field"),
            (F.col(c) if numeric[out] else F.lit(None)).cast("long").alias("number"),
            (F.lit(None) if numeric[out] else F.col(c)).cast("string").alias("text"),
        )
        for n, (out, c) in enumerate(fields.items())
    ]
    counted = (
        df.select(*group_by, copies_of(df).alias("__n"), F.explode(F.array(*entries)).alias("__entry"))
        .select(*group_by, "__n", "__entry.*")
        .groupBy(*group_by, "field", "number", "text")
        .agg(F.sum("__n").alias("__n"))
    )
    set_values = F.col("number").isNotNull() | F.col("text").isNotNull()
    # NULL only wins where a field has no value at all
    rank = F.struct(~set_values, -F.col("__n"), F.col("number"), F.col("text"))
    best = counted.groupBy(*group_by).agg(
        *[F.min(F.when(F.col("field") == n, rank)).alias(out) for n, out in enumerate(fields)]
    )
    return best.select(
        *group_by,
        *[
            F.col(f"`{out}`.{'number' if numeric[out] else 'text'}").cast(types[c]).alias(out)
            for out, c in fields.items()
        ],
    )


def _same_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two results over the same groups, both already shuffled by group."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"{k}_right")
    same = [F.col(k).eqNullSafe(F.col(f"{k}_right")) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return left.join(renamed, condition).drop(*[f"{k}_right" for k in keys])
