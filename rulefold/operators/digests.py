"""Difference of two large tables that hardly differ, without shuffling what is equal.

Rows are dealt to ranges of a 64-bit hash. Per range, a digest that combines map-side (number of
rows and the sums of two hashes, the other side's taken off) tells whether both sides hold the same
rows there. Ranges that differ are cut into finer ones, level by level, and only rows of the last
level's ranges are compared themselves. Ranges whose digests agree never leave their scan as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = "__range"
#: Each level cuts a range into 2 ** BITS_PER_LEVEL.
BITS_PER_LEVEL = 12
LEVELS = 3
#: A level's differing ranges are broadcast; where there are more, its parents stay the last ones.
MOST_RANGES = 65_536
_SECOND_SEED = 7_919


def row_hash(df: DataFrame, *extra: Column) -> Column:
    """A 64-bit hash of a whole row, in which a NULL has its place.

    Spark's hash passes over NULLs, also those in arrays, so that moving one to another column or
    entry would not change it: their places are hashed too, and nested values as JSON.
    """
    values = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.StructType)):
            column = F.to_json(F.struct(column.alias("value")), {"ignoreNullFields": "false"})
        values += [column, column.isNull()]
    return F.xxhash64(*extra, *values)


def _range_of(hashed: Column, level: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BITS_PER_LEVEL * level)


def differing_ranges(sides: DataFrame, level: int) -> DataFrame:
    """Ranges of a level whose digests differ: ``__range`` and the rows of both sides there.

    ``sides`` holds ``__side`` (1 or -1), ``__hash`` and ``__second`` per row.
    """
    side = F.col("__side")
    signed = {h: F.sum(side * F.col(h).cast("decimal(20,0)")) for h in ("__hash", "__second")}
    digests = sides.groupBy(_range_of(F.col("__hash"), level).alias(RANGE)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(side).alias("__more"),
        *[total.alias(f"{h}_sum") for h, total in signed.items()],
    )
    differs = (F.col("__more") != 0) | (F.col("__hash_sum") != 0) | (F.col("__second_sum") != 0)
    return digests.where(differs).select(RANGE, "rows")


def _hashed(df: DataFrame, side: int) -> DataFrame:
    return df.select(
        F.lit(side).alias("__side"),
        row_hash(df).alias("__hash"),
        row_hash(df, F.lit(_SECOND_SEED)).alias("__second"),
    )


def changed_ranges(left: DataFrame, right: DataFrame, levels: int = LEVELS) -> tuple[int, list[int]]:
    """The finest level reached, and its ranges in which the sides differ; at most ``MOST_RANGES``.

    A finer level is not searched where the ranges left hold few rows each, nor kept where it has
    more ranges than may be broadcast. Level 0 is the whole table, as range 0.
    """
    sides = _hashed(left, 1).unionByName(_hashed(right, -1))
    level, ranges = 0, [0]
    for finer in range(1, levels + 1):
        rest = sides if level == 0 else within_ranges(sides, F.col("__hash"), level, ranges)
        found = differing_ranges(rest, finer).limit(MOST_RANGES + 1).collect()
        if len(found) > MOST_RANGES:
            break
        level, ranges = finer, [row[RANGE] for row in found]
        # ranges about as small as single rows cannot be told apart any further
        if sum(row["rows"] for row in found) <= 2 * len(found):
            break
    return level, ranges


def within_ranges(df: DataFrame, hashed: Column, level: int, ranges: list[int]) -> DataFrame:
    """Rows whose hash lies in one of the ranges, by a broadcast of at most ``MOST_RANGES`` numbers."""
    if level == 0:
        return df
    numbers = df.sparkSession.createDataFrame([(r,) for r in ranges], f"{RANGE} long")
    columns = df.columns
    dealt = df.withColumn(RANGE, _range_of(hashed, level))
    return dealt.join(F.broadcast(numbers), RANGE, "left_semi").select(*columns)


def range_difference(
    expected: DataFrame, actual: DataFrame, distinct: bool = True, levels: int = LEVELS
) -> DataFrame:
    """Rows only one side has, marked ``missing`` or ``unexpected``, as ``association_difference``.

    ``distinct=False`` also tells rows that occur more often on one side, as often as they do.
    Both sides are read once per level and once for the rows, so they should be stored tables.
    Two different ranges pass as equal only where their row counts and both 64-bit sums agree.
    """
    columns = expected.columns
    actual = actual.select(*columns)
    level, ranges = changed_ranges(expected, actual, levels)
    left = within_ranges(expected, row_hash(expected), level, ranges)
    right = within_ranges(actual, row_hash(actual), level, ranges)

    def only(one: DataFrame, other: DataFrame, label: str) -> DataFrame:
        rest = one.subtract(other) if distinct else one.exceptAll(other)
        return rest.withColumn("difference", F.lit(label))

    return only(left, right, "missing").unionByName(only(right, left, "unexpected"))
