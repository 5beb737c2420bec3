"""Lists of groups of any size, one row per page of a fixed number of entries.

A list of all ids of a group holds the group in one value. Here rows are numbered within their
group and every page of numbers is a row of its own. No task holds a group for that: rows are
sorted into ranges of (group, order), a range's rows are numbered from its start, and ranges know
from the counts of those before them where their part of a group starts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulefold.operators.skew import COPIES, COPY_NUMBER, copies_of, expand_copies, materialize

PAGE = "page"
IDS_PER_PAGE = 10_000


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], folder: str | None = None) -> DataFrame:
    """Rows with ``first_number``, their place in their group (from 0) by the order's columns.

    Equal rows become one with ``row_copies``, which takes as many numbers: a row that occurs very
    often would otherwise be one range. The ranges are stored, so that a task that is run again
    finds the same ones.
    """
    counted = rows.groupBy(*group, *order).agg(F.sum(copies_of(rows)).alias(COPIES))
    ranges = counted.repartitionByRange(*group, *order).withColumn("__part", F.spark_partition_id())
    ranges = materialize(ranges, folder)

    inside = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranges.withColumn("__before", F.coalesce(F.sum(COPIES).over(inside), F.lit(0)))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("__part", *group)
        .agg(F.sum(COPIES).alias("__size"))
        .withColumn("__start", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
        .select(*[F.col(c).alias(f"__of_{c}") for c in ("__part", *group)], "__start")
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in group], F.col("__part") == F.col("__of___part"))
    placed = local.join(starts, same)
    return placed.select(*group, *order, COPIES, (F.col("__start") + F.col("__before")).alias("first_number"))


def paged_lists(
    rows: DataFrame, group: Sequence[str], lists: dict[str, str], per_page: int = IDS_PER_PAGE,
    folder: str | None = None,
) -> DataFrame:
    """``*group, page`` (from 0) and a list per entry of ``lists`` (column to list name).

    The pages of a group, joined in order, are the lists of the whole group, sorted by the columns
    of ``lists`` in their order; all but a group's last page have ``per_page`` entries.
    ``row_copies``, where ``rows`` has it, is how often a row occurs. NULLs are entries.
    """
    if per_page < 1:
        raise ValueError(f"a page has at least one entry, not {per_page}")
    order = list(lists)
    first, copies = F.col("first_number"), F.col("__copies")
    last = first + copies - 1
    first_page = F.floor(first / per_page).cast("long")
    placed = numbered(rows, group, order, folder).withColumnRenamed(COPIES, "__copies")
    # a row that occurs often lies on several pages; these are counted as copies and unfolded in pieces
    spread = expand_copies(placed.withColumn(COPIES, F.floor(last / per_page).cast("long") - first_page + 1))
    page = first_page + F.col(COPY_NUMBER)
    low = F.greatest(first, page * per_page)
    high = F.least(last, page * per_page + per_page - 1)
    entry = F.struct(low.alias("low"), (high - low + 1).cast("int").alias("times"), *order)
    pages = spread.groupBy(*group, page.alias(PAGE)).agg(F.array_sort(F.collect_list(entry)).alias("__entries"))

    def entries(column: str) -> Column:
        return F.flatten(F.transform("__entries", lambda e: F.array_repeat(e[column], e["times"])))

    columns = [entries(c).alias(name) for c, name in lists.items()]
    return pages.select(*group, PAGE, *columns)
